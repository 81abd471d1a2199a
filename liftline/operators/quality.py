"""Constraint checks and plausibility gates over the warehouse tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from liftline.functions.numeric import rate
from liftline.operators.events import EVENT_KEY
from liftline.operators.user_metrics import activated
from liftline.params import TREATMENT, Experiment
from liftline.schemas import TABLES


class QualityError(RuntimeError):
    """A readout gate failed."""


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def null_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """NULLs in every required column, one pass per table."""
    frames = []
    for name, df in tables.items():
        required = TABLES[name].required
        counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        frames.append(
            counted.unpivot([], required, "column_name", "violations").select(
                F.lit(name).alias("table_name"), "column_name", "violations"
            )
        )
    return _union(frames)


def primary_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: key values that occur more than once, and the rows beyond the first."""
    frames = []
    for name, df in tables.items():
        key = TABLES[name].key
        frames.append(
            df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("_n"))
            .agg(
                F.count_if(F.col("_n") > 1).alias("repeated_keys"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows"),
            )
            .select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), "repeated_keys", "surplus_rows")
        )
    return _union(frames)


def foreign_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Per reference: unknown key values and the rows holding them. Rows are counted per key before
    the anti join, so a key owning much of the table reaches the join as one row."""
    frames = []
    for name, df in tables.items():
        for column, (parent, parent_key) in TABLES[name].references.items():
            if parent not in tables:
                raise ValueError(f"{name}.{column} refers to {parent}, which is not among the tables")
            known = tables[parent].select(F.col(parent_key).alias(column))
            frames.append(
                df.where(F.col(column).isNotNull())
                .groupBy(column)
                .agg(F.count(F.lit(1)).alias("_n"))
                .join(known, column, "left_anti")
                .agg(
                    F.count(F.lit(1)).alias("unknown_keys"),
                    F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"),
                )
                .select(
                    F.lit(name).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    F.lit(parent).alias("references_table"),
                    "unknown_keys",
                    "orphan_rows",
                )
            )
    return _union(frames)


def domain_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows breaking a value rule; like an SQL CHECK, NULL passes."""
    frames = []
    for name, df in tables.items():
        checks = TABLES[name].checks
        if not checks:
            continue
        counted = df.agg(*[F.count_if(~F.expr(rule)).alias(rule_name) for rule_name, rule in checks.items()])
        frames.append(
            counted.unpivot([], list(checks), "rule", "violations").select(
                F.lit(name).alias("table_name"), "rule", "violations"
            )
        )
    return _union(frames)


def _gate(df: DataFrame, check: str, value: Column, lower: Column, upper: Column) -> DataFrame:
    out = df.select(
        F.lit(check).alias("check"),
        value.cast("double").alias("value"),
        lower.cast("double").alias("lower_bound"),
        upper.cast("double").alias("upper_bound"),
    )
    above = F.col("lower_bound").isNull() | (F.col("value") >= F.col("lower_bound"))
    below = F.col("upper_bound").isNull() | (F.col("value") <= F.col("upper_bound"))
    return out.withColumn("passed", F.coalesce(above & below, F.lit(False)))


def _none() -> Column:
    return F.lit(None)


def volume_gates(users: DataFrame, events: DataFrame, exp: Experiment = Experiment()) -> DataFrame:
    """Enough users, and enough events for that many users."""
    one = F.count(F.lit(1))
    counted = (
        users.agg(one.alias("users"), F.lit(0).cast("long").alias("events"))
        .unionByName(events.agg(F.lit(0).cast("long").alias("users"), one.alias("events")))
        .agg(F.sum("users").alias("users"), F.sum("events").alias("events"))
    )
    need = F.lit(exp.bounds.min_events_per_user) * F.col("users")
    return _gate(counted, "min_users", F.col("users"), F.lit(exp.bounds.min_users), _none()).unionByName(
        _gate(counted, "min_events", F.col("events"), need, _none())
    )


def null_assignment_gate(users: DataFrame) -> DataFrame:
    counted = users.agg(F.count_if(F.col("assigned_variant").isNull()).alias("n"))
    return _gate(counted, "null_assigned_variant", F.col("n"), _none(), F.lit(0))


def allocation_gate(users: DataFrame, exp: Experiment = Experiment()) -> DataFrame:
    share = F.avg(F.when(F.col("assigned_variant") == TREATMENT, F.lit(1.0)).otherwise(F.lit(0.0)))
    low, high = exp.bounds.treatment_share
    return _gate(users.agg(share.alias("v")), "treatment_share", F.col("v"), F.lit(low), F.lit(high))


def activation_gate(users: DataFrame, events: DataFrame, exp: Experiment = Experiment()) -> DataFrame:
    """Overall activation from the raw log must be plausible."""

    def first(name: str) -> Column:
        return F.min(F.when(F.col("event_name") == name, F.col("event_ts")))

    firsts = (
        events.where(F.col("event_name").isin(exp.names.completed, exp.names.booked))
        .groupBy("user_id")
        .agg(
            first(exp.names.completed).alias("onboarding_completed_ts"),
            first(exp.names.booked).alias("first_booking_ts"),
        )
    )
    share = (
        users.select("user_id", "signup_ts")
        .join(firsts, "user_id", "left")
        .agg(F.avg(activated(exp.windows.activation).cast("double")).alias("v"))
    )
    low, high = exp.bounds.activation_rate
    return _gate(share, "activation_rate", F.col("v"), F.lit(low), F.lit(high))


def quality_gates(users: DataFrame, events: DataFrame, exp: Experiment = Experiment()) -> DataFrame:
    return _union(
        [
            volume_gates(users, events, exp),
            null_assignment_gate(users),
            allocation_gate(users, exp),
            activation_gate(users, events, exp),
        ]
    )


def require_quality(users: DataFrame, events: DataFrame, exp: Experiment = Experiment()) -> None:
    """Raise with every failed gate; the result has five rows."""
    failed = quality_gates(users, events, exp).where("NOT passed").collect()
    if failed:
        raise QualityError("; ".join(f"{r['check']}={r['value']}" for r in failed))


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(rule, violations) of everything the warehouse schema forbids, one row per rule that is broken."""
    nulls = null_violations(tables).select(F.concat_ws(" ", "table_name", "column_name", F.lit("is missing")).alias("rule"), "violations")
    keys = primary_key_violations(tables).select(
        F.concat_ws(" ", "table_name", "key_column", F.lit("repeats")).alias("rule"), F.col("surplus_rows").alias("violations")
    )
    found = [nulls, keys]
    if any(TABLES[name].references for name in tables):
        found.append(
            foreign_key_violations(tables).select(
                F.concat_ws(" ", "table_name", "column_name", F.lit("is not in"), "references_table").alias("rule"),
                F.col("orphan_rows").alias("violations"),
            )
        )
    if any(TABLES[name].checks for name in tables):
        found.append(domain_violations(tables).select(F.concat_ws(" ", "table_name", "rule").alias("rule"), "violations"))
    return _union(found).where("violations > 0")


def require_constraints(tables: dict[str, DataFrame]) -> None:
    """Raise with every broken rule; there are at most as many as the schema has."""
    _require(constraint_violations(tables))


def _require(violations: DataFrame) -> None:
    broken = violations.orderBy("rule").collect()
    if broken:
        raise QualityError("; ".join(f"{r['rule']}: {r['violations']}" for r in broken))


Known = Callable[[str, DataFrame, str], DataFrame]


def batch_violations(fresh: dict[str, DataFrame], known: Known) -> DataFrame:
    """The same (rule, violations) for the rows a load writes into tables that were sound before. An upsert keeps keys unique and takes
    no key away, so only these rows can break a rule. ``known(parent, keys, column)`` gives which keys the parent will have."""
    nulls = null_violations(fresh).select(F.concat_ws(" ", "table_name", "column_name", F.lit("is missing")).alias("rule"), "violations")
    found = [nulls]
    for name, df in fresh.items():
        for column, (parent, _) in TABLES[name].references.items():
            counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
            orphans = counted.join(known(parent, counted.select(column), column), column, "left_anti")
            rule = F.lit(f"{name} {column} is not in {parent}").alias("rule")
            found.append(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(rule, "violations"))
    if any(TABLES[name].checks for name in fresh):
        found.append(domain_violations(fresh).select(F.concat_ws(" ", "table_name", "rule").alias("rule"), "violations"))
    return _union(found).where("violations > 0")


def require_batch(fresh: dict[str, DataFrame], known: Known) -> None:
    """Raise with every rule that the rows of a load would break."""
    _require(batch_violations(fresh, known))


def duplicate_event_rate(events: DataFrame) -> DataFrame:
    """Share of rows whose (user, name, time) occurs more than once, counting every copy."""
    return (
        events.groupBy(*EVENT_KEY)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.sum("_n").alias("events_raw"),
            (F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(F.lit(0))) / F.sum("_n")).alias(
                "duplicate_event_rate"
            ),
        )
    )


def quality_summary(user_level: DataFrame, events: DataFrame) -> DataFrame:
    """Five (check, value) rows for the dashboard."""
    per_user = user_level.agg(
        F.count(F.lit(1)).cast("double").alias("users"),
        rate("noncompliance_flag").alias("noncompliance_rate"),
        rate("activated_within_7d").alias("activation_rate_7d"),
    ).unpivot([], ["users", "noncompliance_rate", "activation_rate_7d"], "check", "value")
    per_event = (
        duplicate_event_rate(events)
        .withColumn("events_raw", F.col("events_raw").cast("double"))
        .unpivot([], ["events_raw", "duplicate_event_rate"], "check", "value")
    )
    return per_user.unionByName(per_event)
