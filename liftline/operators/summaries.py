"""Aggregates over the user-level tables: by arm, funnel step, day and segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from liftline.functions.numeric import flag, rate, relative
from liftline.params import ARMS, CONTROL, REPORT_DIMENSIONS, TREATMENT

ARM = "assigned_variant"

# Reported averages and the user-level column each one averages.
VARIANT_AVERAGES = {
    "activation_rate_7d": "activated_within_7d",
    "retention_rate_d7": "retained_d7",
    "retention_rate_d30": "retained_d30",
    "cancellation_rate_30d": "cancelled_30d",
    "avg_time_to_first_match_hours": "time_to_first_match_hours",
    "support_tickets_per_user_30d": "support_tickets_30d",
}
# Funnel steps in display order, with the chart labels.
FUNNEL_STEPS = {
    "signup": "Signup",
    "onboarding_started": "Onboarding Started",
    "onboarding_completed": "Onboarding Completed",
    "session_booked": "Session Booked",
    "activated_within_7d": "Activated Within 7 Days",
}
# Display labels of the variant summary and of the segment table.
SUMMARY_LABELS = {
    "assigned_variant": "Variant",
    "users": "Users",
    "activation_rate_7d": "Activation Rate (7D)",
    "retention_rate_d7": "Retention Rate (D7)",
    "retention_rate_d30": "Retention Rate (D30)",
    "cancellation_rate_30d": "Cancellation Rate (30D)",
    "avg_match_latency_hours": "Avg Match Latency (hrs)",
    "support_tickets_per_user": "Support Tickets per User (30D)",
    "noncompliance_rate": "Noncompliance Rate",
}
SEGMENT_LABELS = {
    "segment_dimension": "Segment Type",
    "segment_value": "Segment Value",
    "assigned_variant": "Variant",
    "users": "Users",
    "activation_rate_7d": "Activation Rate (7D)",
}
QUALITY_LABELS = {
    "users": "Total simulated users",
    "events_raw": "Total raw events",
    "duplicate_event_rate": "Duplicate event rate",
    "noncompliance_rate": "Noncompliance rate",
    "activation_rate_7d": "Overall activation rate (7D)",
}


def _users() -> Column:
    return F.count(F.lit(1)).alias("users")


def _averages(names: Sequence[str]) -> list[Column]:
    return [rate(VARIANT_AVERAGES[n]).alias(n) for n in names]


def funnel_step_rates(activation: DataFrame) -> DataFrame:
    steps = {
        "started_onboarding": "onboarding_started_ts",
        "completed_onboarding": "onboarding_completed_ts",
        "booked_session": "first_booking_ts",
    }
    return activation.groupBy(ARM).agg(
        _users(),
        *[F.count(ts).alias(f"users_{step}") for step, ts in steps.items()],
        *[(F.count(ts) / F.count(F.lit(1))).alias(f"rate_{step}") for step, ts in steps.items()],
        rate("activated_within_7d").alias("activation_rate_7d"),
    )


def retention_rates(retention: DataFrame) -> DataFrame:
    return retention.groupBy(ARM).agg(_users(), *_averages(["retention_rate_d7", "retention_rate_d30"]))


def guardrail_rates(guardrails: DataFrame) -> DataFrame:
    names = ["cancellation_rate_30d", "avg_time_to_first_match_hours", "support_tickets_per_user_30d"]
    return guardrails.groupBy(ARM).agg(_users(), *_averages(names))


def variant_summary(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(ARM).agg(_users(), *_averages(list(VARIANT_AVERAGES)))


def segment_summary(metrics: DataFrame) -> DataFrame:
    names = ["activation_rate_7d", "retention_rate_d30", "cancellation_rate_30d"]
    return metrics.groupBy(ARM, "acquisition_channel", "device").agg(_users(), *_averages(names))


def dashboard_variant_summary(user_level: DataFrame) -> DataFrame:
    """The variant summary under the dashboard's names, plus the noncompliance rate, in arm order."""
    return (
        user_level.groupBy(ARM)
        .agg(_users(), *_averages(list(VARIANT_AVERAGES)), rate("noncompliance_flag").alias("noncompliance_rate"))
        .withColumnsRenamed(
            {
                "avg_time_to_first_match_hours": "avg_match_latency_hours",
                "support_tickets_per_user_30d": "support_tickets_per_user",
            }
        )
        .orderBy(ARM)
    )


def _arm_value(column: Column, arm: str) -> Column:
    return F.max(F.when(F.col(ARM) == arm, column))


def lift_table(summary: DataFrame) -> DataFrame:
    """One row per averaged metric: both arms, absolute and relative lift."""
    return (
        summary.unpivot(ARM, list(VARIANT_AVERAGES), "metric", "value")
        .groupBy("metric")
        .agg(
            _arm_value(F.col("value"), CONTROL).alias("control_value"),
            _arm_value(F.col("value"), TREATMENT).alias("treatment_value"),
        )
        .withColumn("absolute_lift", F.col("treatment_value") - F.col("control_value"))
        .withColumn("relative_lift", relative(F.col("absolute_lift"), F.col("control_value")))
    )


def funnel_long(user_level: DataFrame) -> DataFrame:
    """Five rows per arm with a numeric step order."""
    steps = list(FUNNEL_STEPS)
    wide = user_level.groupBy(ARM).agg(
        F.count(F.lit(1)).alias("signup"), *[F.sum(s).alias(s) for s in steps[1:]]
    )
    rows = ", ".join(f"{i}, '{s}', {s}" for i, s in enumerate(steps, start=1))
    return wide.select(
        ARM, F.expr("signup").alias("_n"), F.expr(f"stack({len(steps)}, {rows}) AS (step_order, step_name, users)")
    ).select(
        ARM, "step_order", "step_name", "users", (F.col("users") / F.col("_n")).alias("rate_from_signup")
    )


def ordered_funnel(user_level: DataFrame) -> DataFrame:
    """The funnel in arm and step order, under the dashboard's column names."""
    return (
        funnel_long(user_level)
        .orderBy(ARM, "step_order")
        .select(ARM, F.col("step_name").alias("step"), "users", "rate_from_signup")
    )


def daily_metrics(user_level: DataFrame) -> DataFrame:
    return user_level.groupBy("signup_date", ARM).agg(_users(), *_averages(list(VARIANT_AVERAGES)))


def daily_activation(user_level: DataFrame) -> DataFrame:
    return user_level.groupBy("signup_date", ARM).agg(*_averages(["activation_rate_7d"]))


def _segment_totals(
    user_level: DataFrame, metrics: Sequence[str], dimensions: Sequence[str]
) -> DataFrame:
    """Users, sums and non-null counts per (dimension, value, arm).

    Users are first reduced to the combinations of all dimensions; only those few cells are then
    repeated once per dimension.
    """
    cells = user_level.groupBy(*dimensions, ARM).agg(
        _users(),
        *[F.sum(F.col(m).cast("double")).alias(f"_s_{m}") for m in metrics],
        *[F.count(m).alias(f"_n_{m}") for m in metrics],
    )
    totals = [c for c in cells.columns if c not in dimensions and c != ARM]
    return (
        cells.unpivot([ARM, *totals], list(dimensions), "segment_dimension", "segment_value")
        .where(F.col("segment_value").isNotNull())
        .groupBy("segment_dimension", "segment_value", ARM)
        .agg(*[F.sum(c).alias(c) for c in totals])
    )


def segment_metrics(user_level: DataFrame, dimensions: Sequence[str] = REPORT_DIMENSIONS) -> DataFrame:
    metrics = [
        "activated_within_7d",
        "retained_d7",
        "retained_d30",
        "cancelled_30d",
        "support_tickets_30d",
        "time_to_first_match_hours",
    ]
    totals = _segment_totals(user_level, metrics, dimensions)
    means = [F.try_divide(F.col(f"_s_{m}"), F.col(f"_n_{m}")).alias(m) for m in metrics]
    return totals.select("segment_dimension", "segment_value", ARM, "users", *means)


def segment_activation(user_level: DataFrame, dimensions: Sequence[str] = REPORT_DIMENSIONS) -> DataFrame:
    totals = _segment_totals(user_level, ["activated_within_7d"], dimensions)
    mean = F.try_divide(F.col("_s_activated_within_7d"), F.col("_n_activated_within_7d"))
    return totals.select("segment_dimension", "segment_value", ARM, "users", mean.alias("activation_rate_7d"))


def by_arm(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Chart form: one row per key with a column for each arm."""
    return df.groupBy(*keys).pivot(ARM, list(ARMS)).agg(F.first(value))


def calculated_fields(bi_level: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The workbook's calculated fields, overall or per the given columns."""

    def arm_rate(arm: str) -> Column:
        return F.avg(F.when(F.col(ARM) == arm, F.col("activated_within_7d").cast("double")))

    return bi_level.groupBy(*by).agg(
        rate("activated_within_7d").alias("activation_rate_7d"),
        rate("retained_d7").alias("d7_retention_rate"),
        rate("retained_d30").alias("d30_retention_rate"),
        rate("cancelled_30d").alias("cancellation_rate_30d"),
        rate("support_tickets_30d").alias("support_tickets_per_user"),
        F.sum(flag(F.col(ARM) == TREATMENT)).alias("treatment_users"),
        F.sum(flag(F.col(ARM) == CONTROL)).alias("control_users"),
        rate("saw_treatment").alias("exposed_to_treatment_rate"),
        F.sum("activated_within_7d").alias("activated_users"),
        (arm_rate(TREATMENT) - arm_rate(CONTROL)).alias("activation_lift_vs_control"),
    )


def headline(summary: DataFrame) -> DataFrame:
    """Total users and the activation lift in percentage points, from a variant summary."""
    value = F.col("activation_rate_7d")
    return summary.agg(
        F.sum("users").alias("total_users"),
        (100 * (_arm_value(value, TREATMENT) - _arm_value(value, CONTROL))).alias("activation_lift_pp"),
    )


def filtered(
    user_level: DataFrame,
    signup_from=None,
    signup_to=None,
    **allowed: Sequence[str],
) -> DataFrame:
    """Dashboard filters: an inclusive signup date range and allowed values per dimension."""
    if signup_from is not None:
        user_level = user_level.where(F.col("signup_date") >= F.lit(signup_from).cast("date"))
    if signup_to is not None:
        user_level = user_level.where(F.col("signup_date") <= F.lit(signup_to).cast("date"))
    for dimension, values in allowed.items():
        user_level = user_level.where(F.col(dimension).isin(*values))
    return user_level


def relabelled(column: Column, labels: dict[str, str]) -> Column:
    """Values replaced by their labels; values without one stay as they are."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), column), column)
