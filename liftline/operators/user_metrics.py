"""One row of outcomes per user. Every user of ``dim_users`` appears exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from liftline.functions.numeric import flag
from liftline.functions.timing import hours_between, plus_days, week_label
from liftline.operators.events import first_times, milestones
from liftline.params import TREATMENT, Experiment

# Who the user is, in the order of the user-level tables.
USER_COLUMNS = [
    "user_id",
    "signup_ts",
    "country",
    "device",
    "acquisition_channel",
    "age_bucket",
    "baseline_score",
    "pre_treatment_sessions_30d",
    "assigned_variant",
    "actually_exposed_variant",
]


def activated(days: int) -> Column:
    """Onboarding completed and a session booked, both up to and including signup + days."""
    limit = plus_days(F.col("signup_ts"), days)
    return flag((F.col("onboarding_completed_ts") <= limit) & (F.col("first_booking_ts") <= limit))


def retained(days: int) -> Column:
    """An app open at or after signup + days; the last open decides."""
    return flag(F.col("last_open_ts") >= plus_days(F.col("signup_ts"), days))


def cancelled(days: int) -> Column:
    """Cancelled before signup + days; a cancellation before signup counts too."""
    return flag(F.col("cancelled_ts") < plus_days(F.col("signup_ts"), days))


def hours_to_match() -> Column:
    return hours_between(F.col("signup_ts"), F.col("matched_ts"))


def activation_user_level(users: DataFrame, events: DataFrame, exp: Experiment = Experiment()) -> DataFrame:
    return users.join(first_times(events, exp.names), "user_id", "left").select(
        "user_id",
        "signup_ts",
        "assigned_variant",
        "actually_exposed_variant",
        "acquisition_channel",
        "onboarding_started_ts",
        "onboarding_completed_ts",
        "first_booking_ts",
        activated(exp.windows.activation).alias("activated_within_7d"),
    )


def retention_user_level(users: DataFrame, events: DataFrame, exp: Experiment = Experiment()) -> DataFrame:
    """The last app open per user is compared with the signup after a one-to-one join, so events
    are never widened with user columns."""
    opens = (
        events.where(F.col("event_name") == exp.names.opened)
        .groupBy("user_id")
        .agg(F.max("event_ts").alias("last_open_ts"))
    )
    return users.join(opens, "user_id", "left").select(
        "user_id",
        "assigned_variant",
        "actually_exposed_variant",
        "acquisition_channel",
        retained(exp.windows.retention_short).alias("retained_d7"),
        retained(exp.windows.retention_long).alias("retained_d30"),
    )


def count_after_signup(users: DataFrame, facts: DataFrame, ts: str, days: int, name: str) -> DataFrame:
    """Facts per user with signup <= ts < signup + days; only users with at least one appear.

    One user may own a large share of the facts. The join runs on a copy of the id, so it leaves no
    partitioning the count could reuse: the count gets its own partial step and shuffle, and
    adaptive execution is free to split the heavy user's join partition.
    """
    left = users.select(F.bitwise_not("user_id").alias("_join_id"), "user_id", "signup_ts")
    right = facts.select(F.bitwise_not("user_id").alias("_join_id"), F.col(ts).alias("_ts"))
    inside = (F.col("_ts") >= F.col("signup_ts")) & (F.col("_ts") < plus_days(F.col("signup_ts"), days))
    return (
        right.join(left, "_join_id")
        .where(inside)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias(name))
    )


def support_user_level(users: DataFrame, tickets: DataFrame, exp: Experiment = Experiment()) -> DataFrame:
    counts = count_after_signup(users, tickets, "created_ts", exp.windows.tickets, "_n")
    return users.join(counts, "user_id", "left").select(
        "user_id", F.coalesce("_n", F.lit(0).cast("long")).alias("support_tickets_30d")
    )


def first_per_user(facts: DataFrame, ts: str) -> DataFrame:
    """The earliest time per user, so that a repeated fact neither repeats a user nor skews the join."""
    return facts.groupBy("user_id").agg(F.min(ts).alias(ts))


def cancellation_user_level(
    users: DataFrame, cancellations: DataFrame, exp: Experiment = Experiment()
) -> DataFrame:
    return users.join(first_per_user(cancellations, "cancelled_ts"), "user_id", "left").select(
        "user_id", cancelled(exp.windows.cancellation).alias("cancelled_30d")
    )


def match_latency_user_level(users: DataFrame, matches: DataFrame) -> DataFrame:
    return users.join(first_per_user(matches, "matched_ts"), "user_id", "left").select(
        "user_id", hours_to_match().alias("time_to_first_match_hours")
    )


def _with_guardrails(
    base: DataFrame, users: DataFrame, tickets: DataFrame, cancellations: DataFrame, matches: DataFrame,
    exp: Experiment,
) -> DataFrame:
    """Joins the three per-user guardrail facts; all sides are partitioned by user_id once."""
    counts = count_after_signup(users, tickets, "created_ts", exp.windows.tickets, "_tickets")
    return (
        base.join(first_per_user(cancellations, "cancelled_ts"), "user_id", "left")
        .join(first_per_user(matches, "matched_ts"), "user_id", "left")
        .join(counts, "user_id", "left")
        .withColumns(
            {
                "cancelled_30d": cancelled(exp.windows.cancellation),
                "time_to_first_match_hours": hours_to_match(),
                "support_tickets_30d": F.coalesce("_tickets", F.lit(0).cast("long")),
            }
        )
    )


def guardrails_user_level(
    users: DataFrame, tickets: DataFrame, cancellations: DataFrame, matches: DataFrame,
    exp: Experiment = Experiment(),
) -> DataFrame:
    return _with_guardrails(users, users, tickets, cancellations, matches, exp).select(
        "user_id",
        "assigned_variant",
        "actually_exposed_variant",
        "acquisition_channel",
        "cancelled_30d",
        "time_to_first_match_hours",
        "support_tickets_30d",
    )


def _user_facts(users, events, tickets, cancellations, matches, exp: Experiment) -> DataFrame:
    base = users.join(milestones(events, exp.names), "user_id", "left").withColumns(
        {
            "activated_within_7d": activated(exp.windows.activation),
            "retained_d7": retained(exp.windows.retention_short),
            "retained_d30": retained(exp.windows.retention_long),
        }
    )
    return _with_guardrails(base, users, tickets, cancellations, matches, exp)


# Outcome columns in the order of the user-level tables.
OUTCOME_COLUMNS = [
    "activated_within_7d",
    "retained_d7",
    "retained_d30",
    "cancelled_30d",
    "time_to_first_match_hours",
    "support_tickets_30d",
]


def experiment_user_metrics(
    users: DataFrame, events: DataFrame, tickets: DataFrame, cancellations: DataFrame, matches: DataFrame,
    exp: Experiment = Experiment(),
) -> DataFrame:
    """Sixteen columns per user: who they are and their six outcomes."""
    facts = _user_facts(users, events, tickets, cancellations, matches, exp)
    return facts.select(*USER_COLUMNS, *OUTCOME_COLUMNS)


def _step_flags() -> list[Column]:
    return [
        flag(F.col("onboarding_started_ts").isNotNull()).alias("onboarding_started"),
        flag(F.col("onboarding_completed_ts").isNotNull()).alias("onboarding_completed"),
        flag(F.col("first_booking_ts").isNotNull()).alias("session_booked"),
    ]


def dashboard_user_level(
    users: DataFrame, events: DataFrame, tickets: DataFrame, cancellations: DataFrame, matches: DataFrame,
    exp: Experiment = Experiment(),
) -> DataFrame:
    """Twenty-one columns per user for the dashboard tables."""
    facts = _user_facts(users, events, tickets, cancellations, matches, exp)
    noncompliant = flag(F.col("assigned_variant") != F.col("actually_exposed_variant"))
    return facts.select(
        "user_id",
        "signup_ts",
        F.to_date("signup_ts").alias("signup_date"),
        *USER_COLUMNS[2:],
        noncompliant.alias("noncompliance_flag"),
        *_step_flags(),
        *OUTCOME_COLUMNS,
    )


def bi_user_level(
    users: DataFrame, events: DataFrame, tickets: DataFrame, cancellations: DataFrame, matches: DataFrame,
    exp: Experiment = Experiment(),
) -> DataFrame:
    """Twenty-two columns per user for the BI export."""
    facts = _user_facts(users, events, tickets, cancellations, matches, exp)
    return facts.select(
        "user_id",
        "signup_ts",
        F.to_date("signup_ts").alias("signup_date"),
        week_label(F.col("signup_ts")).alias("signup_week"),
        *USER_COLUMNS[2:],
        flag(F.col("actually_exposed_variant") == TREATMENT).alias("saw_treatment"),
        *_step_flags(),
        *OUTCOME_COLUMNS,
    )
