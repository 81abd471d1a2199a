"""Rollout decisions and the metric dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from liftline.functions.numeric import number_text
from liftline.params import CONTROL, GUARDRAIL_METRICS, PRIMARY_METRIC, TREATMENT, Tolerances

# Texts of the p-value decision.
PVALUE_ROLLOUT = (
    "Recommend staged rollout of treatment onboarding (10% -> 50% -> 100%) with guardrail monitoring."
)
PVALUE_MITIGATE = (
    "Do not fully roll out yet; primary improved but guardrail risks require mitigation and follow-up test."
)
PVALUE_STOP = "Do not roll out treatment yet; primary metric did not meet decision threshold."

# Decision, rationale and action plan of the tolerance decision.
TOLERANCE_ROLLOUT = (
    "Proceed with staged rollout",
    "The treatment improved 7-day activation and guardrail shifts remained within acceptable operating thresholds.",
    "Roll out 10% -> 50% -> 100% with daily monitoring and rollback triggers.",
)
TOLERANCE_HOLD = (
    "Hold full rollout and mitigate risk",
    "Activation improved, but at least one guardrail exceeded tolerance.",
    "Address guardrail risk drivers, then rerun a targeted validation test.",
)
TOLERANCE_STOP = (
    "Do not roll out treatment yet",
    "Primary activation outcome did not improve versus control.",
    "Iterate onboarding design and retest.",
)

# The metric dictionary.
DICTIONARY_COLUMNS = (
    "metric_key",
    "business_metric",
    "category",
    "definition",
    "why_it_matters",
    "desired_direction",
)
DICTIONARY = [
    (
        "activated_within_7d",
        "7-Day Activation Rate",
        "Primary Outcome",
        "Share of new users who complete onboarding and book their first session within 7 days.",
        "Captures early conversion from signup to meaningful product use.",
        "Higher",
    ),
    (
        "retained_d7",
        "Day-7 Retention",
        "Secondary Outcome",
        "Share of users who return to the app on or after day 7.",
        "Signals short-term habit formation after onboarding.",
        "Higher",
    ),
    (
        "retained_d30",
        "Day-30 Retention",
        "Secondary Outcome",
        "Share of users who return to the app on or after day 30.",
        "Reflects medium-term user stickiness.",
        "Higher",
    ),
    (
        "cancelled_30d",
        "30-Day Cancellation Rate",
        "Guardrail",
        "Share of users who cancel within 30 days of signup.",
        "Ensures growth is not coming from poor-fit or low-quality starts.",
        "Lower",
    ),
    (
        "time_to_first_match_hours",
        "Time to First Match (hours)",
        "Guardrail",
        "Average hours between signup and first therapist match.",
        "Long wait times can hurt trust and downstream retention.",
        "Lower",
    ),
    (
        "support_tickets_30d",
        "Support Tickets per User (30D)",
        "Guardrail",
        "Average number of support tickets per user in first 30 days.",
        "Tracks friction introduced by product changes.",
        "Lower",
    ),
    (
        "noncompliance_flag",
        "Noncompliance Rate",
        "Design Integrity",
        "Share of users whose assigned experience differs from what they actually saw.",
        "Higher noncompliance weakens confidence in treatment effect estimates.",
        "Lower",
    ),
]


def _worsened(level: float) -> Column:
    is_guardrail = F.col("metric").isin(*GUARDRAIL_METRICS)
    return is_guardrail & (F.col("effect_abs") > 0) & (F.col("p_value") < level)


def guardrail_regressions(results: DataFrame, level: float = 0.05) -> DataFrame:
    """Guardrails that moved the wrong way beyond chance, with a line of text each."""
    return results.where(_worsened(level)).select(
        "metric",
        "effect_abs",
        "p_value",
        F.concat(
            F.col("metric"),
            F.lit(" worsened (effect="),
            number_text(F.col("effect_abs")),
            F.lit(", p="),
            number_text(F.col("p_value")),
            F.lit(")"),
        ).alias("issue"),
    )


def decision_by_pvalue(results: DataFrame, level: float = 0.05) -> DataFrame:
    """One row: decision text, whether the primary metric won, number of guardrail issues."""
    won = (F.col("metric") == PRIMARY_METRIC) & (F.col("effect_abs") > 0) & (F.col("p_value") < level)
    flags = results.agg(
        F.coalesce(F.bool_or(won), F.lit(False)).alias("primary_win"),
        F.count_if(_worsened(level)).alias("guardrail_issues"),
    )
    clean = F.col("guardrail_issues") == 0
    return flags.select(
        F.when(F.col("primary_win") & clean, PVALUE_ROLLOUT)
        .when(F.col("primary_win"), PVALUE_MITIGATE)
        .otherwise(PVALUE_STOP)
        .alias("decision"),
        "primary_win",
        "guardrail_issues",
    )


def decision_by_tolerance(summary: DataFrame, tolerances: Tolerances = Tolerances()) -> DataFrame:
    """One row from the dashboard variant summary: outcome, deltas and the three guardrail checks."""

    def delta(column: str) -> Column:
        value = F.col(column)
        arm = F.col("assigned_variant")
        return F.max(F.when(arm == TREATMENT, value)) - F.max(F.when(arm == CONTROL, value))

    deltas = summary.agg(
        delta("activation_rate_7d").alias("_lift"),
        delta("cancellation_rate_30d").alias("_cancellation"),
        delta("avg_match_latency_hours").alias("_latency"),
        delta("support_tickets_per_user").alias("_tickets"),
    ).withColumns(
        {
            "_ok_cancellation": F.coalesce(F.col("_cancellation") <= tolerances.cancellation, F.lit(False)),
            "_ok_latency": F.coalesce(F.col("_latency") <= tolerances.latency_hours, F.lit(False)),
            "_ok_tickets": F.coalesce(F.col("_tickets") <= tolerances.tickets, F.lit(False)),
        }
    )
    improved = F.col("_lift") > 0
    safe = F.col("_ok_cancellation") & F.col("_ok_latency") & F.col("_ok_tickets")

    def text(i: int) -> Column:
        return (
            F.when(improved & safe, TOLERANCE_ROLLOUT[i])
            .when(improved, TOLERANCE_HOLD[i])
            .otherwise(TOLERANCE_STOP[i])
        )

    return deltas.select(
        text(0).alias("decision"),
        text(1).alias("rationale"),
        text(2).alias("action_plan"),
        (100 * F.col("_lift")).alias("activation_lift_pp"),
        (100 * F.col("_cancellation")).alias("cancellation_delta_pp"),
        F.col("_latency").alias("match_latency_delta_hours"),
        F.col("_tickets").alias("support_ticket_delta"),
        F.col("_ok_cancellation").alias("guardrail_cancellation_within_tolerance"),
        F.col("_ok_latency").alias("guardrail_latency_within_tolerance"),
        F.col("_ok_tickets").alias("guardrail_support_within_tolerance"),
    )


def kpi_snapshot(results: DataFrame, power: DataFrame, cuped: DataFrame) -> DataFrame:
    """One row with the primary effect, its interval, what was detectable and the mean CUPED gain."""
    reduction = cuped.agg(F.coalesce(F.avg("variance_reduction_pct"), F.lit(0.0))).scalar()
    return (
        results.where(F.col("metric") == PRIMARY_METRIC)
        .join(power.select("metric", "observed_mde_abs"), "metric")
        .select(
            F.col("metric").alias("primary_metric"),
            F.col("control_mean").alias("control_rate"),
            F.col("treatment_mean").alias("treatment_rate"),
            F.col("effect_abs").alias("absolute_lift"),
            "p_value",
            "ci_low",
            "ci_high",
            "observed_mde_abs",
            reduction.alias("mean_cuped_variance_reduction_pct"),
        )
    )


def strongest_segment(segments: DataFrame) -> DataFrame:
    """The significant segment with the largest effect, if any."""
    return (
        segments.where("significant_fdr_05")
        .orderBy(F.col("effect_abs").desc(), "segment_dimension", "segment_value")
        .limit(1)
    )


def metric_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DICTIONARY, ", ".join(f"{c} string" for c in DICTIONARY_COLUMNS))


def labelled(results: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Test results with the business name, category and wanted direction of their metric."""
    names = dictionary.select(
        F.col("metric_key").alias("metric"), "business_metric", "category", "desired_direction"
    )
    return results.join(names, "metric", "left")
