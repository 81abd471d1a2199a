"""The named view layer: ten temporary views over the DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from liftline.operators import events as ev, summaries as sm, user_metrics as um
from liftline.params import ARMS, Experiment


def view_frames(tables: dict[str, DataFrame], exp: Experiment = Experiment()) -> dict[str, DataFrame]:
    users, events = tables["dim_users"], tables["fact_events"]
    facts = (tables["fact_support_tickets"], tables["fact_cancellations"], tables["fact_matches"])
    activation = um.activation_user_level(users, events, exp)
    retention = um.retention_user_level(users, events, exp)
    guardrails = um.guardrails_user_level(users, *facts, exp)
    metrics = um.experiment_user_metrics(users, events, *facts, exp)
    # The names under which these views are queried.
    return {
        "vw_events_deduped": ev.deduped_events(events),
        "vw_activation_user_level": activation,
        "vw_funnel_step_rates": sm.funnel_step_rates(activation),
        "vw_retention_user_level": retention,
        "vw_retention_rates": sm.retention_rates(retention),
        "vw_guardrails_user_level": guardrails,
        "vw_guardrail_rates": sm.guardrail_rates(guardrails),
        "vw_experiment_user_metrics": metrics,
        "vw_experiment_variant_summary": sm.variant_summary(metrics),
        "vw_experiment_segment_summary": sm.segment_summary(metrics),
    }


def register_views(tables: dict[str, DataFrame], exp: Experiment = Experiment()) -> list[str]:
    frames = view_frames(tables, exp)
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)


# The columns the statistics read from the user-level view.
ANALYSIS_COLUMNS = [
    "user_id",
    "assigned_variant",
    "acquisition_channel",
    "device",
    "age_bucket",
    "baseline_score",
    "activated_within_7d",
    "retained_d7",
    "retained_d30",
    "cancelled_30d",
    "time_to_first_match_hours",
    "support_tickets_30d",
]


def analysis_input(metrics: DataFrame) -> DataFrame:
    """User-level rows of the two compared arms, with the columns the statistics need."""
    in_test: Column = F.col("assigned_variant").isin(*ARMS)
    return metrics.where(in_test).select(*ANALYSIS_COLUMNS)


def analysis_input_from_view(spark: SparkSession) -> DataFrame:
    return analysis_input(spark.table("vw_experiment_user_metrics"))


def analysis_input_from_jdbc(spark: SparkSession, url: str, partitions: int, lower: int, upper: int, **options):
    """The same rows from an external warehouse, read in parallel ranges of ``user_id``."""
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable="vw_experiment_user_metrics",
        partitionColumn="user_id",
        numPartitions=partitions,
        lowerBound=lower,
        upperBound=upper,
        **options,
    )
    return analysis_input(reader.load())
