"""Treatment-control comparisons: differences in means, tests, intervals, segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from liftline.functions.numeric import relative, with_two_sided_p
from liftline.operators.bootstrap import interval_from_cells
from liftline.operators.moments import ARM, arm_parts, bucket_cells, moments_from_parts
from liftline.operators.multiple_testing import benjamini_hochberg
from liftline.params import CONTROL, METRICS, PRIMARY_METRIC, TEST_DIMENSIONS, TREATMENT, Bootstrap, Experiment

METHOD = "difference_in_means + bootstrap_ci"  # fixed value: label of the result table


def difference_tests(moments: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Effect and two-sided unequal-variance z-test per (groups, metric)."""

    def arm(name: str, column: str) -> Column:
        return F.max(F.when(F.col(ARM) == name, F.col(column)))

    zero = F.lit(0).cast("long")
    wide = moments.groupBy(*groups, "metric").agg(
        arm(CONTROL, "mean").alias("control_mean"),
        arm(TREATMENT, "mean").alias("treatment_mean"),
        arm(CONTROL, "variance").alias("_vc"),
        arm(TREATMENT, "variance").alias("_vt"),
        F.coalesce(arm(CONTROL, "n"), zero).alias("n_control"),
        F.coalesce(arm(TREATMENT, "n"), zero).alias("n_treatment"),
    )

    def mean_variance(variance: str, n: str) -> Column:
        return F.col(variance) / F.greatest(F.col(n), F.lit(1))

    error = F.sqrt(mean_variance("_vt", "n_treatment") + mean_variance("_vc", "n_control"))
    effect = F.col("treatment_mean") - F.col("control_mean")
    effects = wide.withColumns({"effect_abs": effect, "standard_error": error})
    return (
        with_two_sided_p(effects, "effect_abs", "standard_error")
        .withColumn("effect_rel", relative(F.col("effect_abs"), F.col("control_mean")))
        .select(
            *groups,
            "metric",
            "control_mean",
            "treatment_mean",
            "effect_abs",
            "effect_rel",
            "standard_error",
            "p_value",
            "n_control",
            "n_treatment",
        )
    )


def ab_result_table(
    df: DataFrame, metrics: Sequence[str] = METRICS, boot: Bootstrap = Bootstrap()
) -> DataFrame:
    """Eleven columns per metric. Tests and intervals come from the same bucket cells."""
    cells = bucket_cells(df, metrics, boot)
    tests = difference_tests(moments_from_parts(arm_parts(df, cells, metrics, boot)))
    return tests.join(interval_from_cells(cells, metrics, boot), "metric", "left").select(
        "metric",
        "control_mean",
        "treatment_mean",
        "effect_abs",
        "effect_rel",
        "ci_low",
        "ci_high",
        "p_value",
        "n_control",
        "n_treatment",
        F.lit(METHOD).alias("analysis_method"),
    )


def segment_tests(
    df: DataFrame,
    dimensions: Sequence[str] = TEST_DIMENSIONS,
    metric: str = PRIMARY_METRIC,
    exp: Experiment = Experiment(),
) -> DataFrame:
    """One test per segment whose two arms are both large enough, adjusted over those segments.

    Thirteen columns, also when no segment qualifies. Only qualifying segments are resampled.
    """
    boot, groups = exp.segment_bootstrap, ["segment_dimension", "segment_value"]
    # stack, not unpivot: its two uses below stay recognisable as one and the same shuffle.
    pairs = ", ".join(f"'{d}', CAST(`{d}` AS STRING)" for d in dimensions)
    long = df.select(
        "user_id", ARM, metric, F.expr(f"stack({len(dimensions)}, {pairs}) AS ({', '.join(groups)})")
    ).where("segment_dimension IS NOT NULL AND segment_value IS NOT NULL")
    cells = bucket_cells(long, [metric], boot, groups)
    tests = difference_tests(moments_from_parts(arm_parts(long, cells, [metric], boot, groups), groups), groups)
    large = tests.where(
        (F.col("n_control") >= exp.min_segment_arm) & (F.col("n_treatment") >= exp.min_segment_arm)
    )
    resampled = cells.join(large.select(*groups), groups, "left_semi")
    intervals = interval_from_cells(resampled, [metric], boot, groups)
    adjusted = benjamini_hochberg(large, groups, ["metric"])
    return (
        adjusted.join(intervals, [*groups, "metric"], "left")
        .withColumn("significant_fdr_05", F.col("p_value_fdr") <= exp.significance)
        .select(
            *groups,
            "metric",
            "n_control",
            "n_treatment",
            "control_mean",
            "treatment_mean",
            "effect_abs",
            "ci_low",
            "ci_high",
            "p_value",
            "p_value_fdr",
            "significant_fdr_05",
        )
        .orderBy(*groups)
    )
