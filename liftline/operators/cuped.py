"""CUPED: variance reduction with a pre-experiment covariate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from liftline.operators.ab_tests import difference_tests
from liftline.operators.bootstrap import REPLICATE, percentile_interval, replicate_sums
from liftline.operators.moments import ARM, arm_parts, bucket_cells, by_metric, merged
from liftline.params import CUPED_METRICS, Bootstrap


def cuped_adjusted(df: DataFrame, outcome: str, covariate: str, out: str = "cuped_outcome") -> DataFrame:
    """Rows with both values present, plus the adjusted outcome y - theta (x - mean x).

    Theta and the covariate mean are pooled over all rows and enter as one-row subqueries.
    """
    rows = df.where(F.col(outcome).isNotNull() & F.col(covariate).isNotNull())
    y, x = F.col(outcome).cast("double"), F.col(covariate).cast("double")
    slope = F.when(F.min(x) == F.max(x), F.lit(0.0)).otherwise(F.try_divide(F.covar_samp(x, y), F.var_samp(x)))
    pooled = rows.agg(F.struct(slope.alias("theta"), F.avg(x).alias("mean")).alias("p")).scalar()
    # A slope that is NULL because there is a single row leaves the outcome as it is.
    return rows.withColumn(out, y - F.coalesce(pooled["theta"], F.lit(0.0)) * (x - pooled["mean"]))


def cuped_table(
    df: DataFrame,
    covariate: str = "baseline_score",
    metrics: Sequence[str] = CUPED_METRICS,
    boot: Bootstrap = Bootstrap(),
) -> DataFrame:
    """Ten columns per metric. The adjustment is linear, so slope, variances, effect and replicates
    all follow from bucket sums and centred co-moments; users are scanned once. The raw effect is that of
    all users with an outcome; everything else is over those with a covariate too."""
    cells = bucket_cells(df, metrics, boot, x=covariate)
    arms = arm_parts(df, cells, metrics, boot, x=covariate)

    n, flat = F.col("n"), F.col("x_min") == F.col("x_max")
    pooled = merged(arms, ["metric"], covariate).select(
        "metric",
        F.when(flat, F.lit(0.0)).otherwise(F.try_divide(F.col("qxy"), F.col("qxx"))).alias("theta"),
        F.try_divide(F.col("sx"), n).alias("_x_mean"),
        F.when(flat, F.col("qyy") / n).otherwise(F.try_divide(F.col("qyy"), n - 1)).alias("raw_variance"),
        n.alias("_n"),
        flat.alias("_flat"),
        F.col("qyy").alias("_qyy"),
        F.col("qxx").alias("_qxx"),
        F.col("qxy").alias("_qxy"),
    )

    theta = F.col("theta")
    tests_input = arms.join(pooled.select("metric", "theta", "_x_mean"), "metric").select(
        "metric",
        ARM,
        "n",
        (F.try_divide(F.col("sy"), n) - theta * (F.try_divide(F.col("sx"), n) - F.col("_x_mean"))).alias("mean"),
        F.when(
            n > 1,
            F.try_divide(
                F.greatest(F.lit(0.0), F.col("qyy") - 2 * theta * F.col("qxy") + theta * theta * F.col("qxx")), n - 1
            ),
        )
        .otherwise(F.lit(0.0))
        .alias("variance"),
    )
    raw_effect = difference_tests(
        arms.select(
            "metric", ARM, F.col("n_all").alias("n"), F.try_divide(F.col("sy_all"), F.col("n_all")).alias("mean"),
            F.lit(0.0).alias("variance"),
        )
    ).select("metric", F.col("effect_abs").alias("raw_effect_abs"))
    tests = difference_tests(tests_input).select(
        "metric", F.col("effect_abs").alias("cuped_effect_abs"), F.col("p_value").alias("cuped_p_value")
    )

    parts = ["n", "sy", "sx"]
    sums = by_metric(
        replicate_sums(cells, [f"{p}_{m}" for m in metrics for p in parts], boot), metrics, [ARM, REPLICATE], parts
    ).join(pooled.select("metric", "theta", "_x_mean"), "metric")
    adjusted = F.try_divide(F.col("sy"), n) - theta * (F.try_divide(F.col("sx"), n) - F.col("_x_mean"))
    intervals = percentile_interval(sums, adjusted, boot).withColumnsRenamed(
        {"ci_low": "cuped_ci_low", "ci_high": "cuped_ci_high"}
    )

    residual = F.greatest(
        F.lit(0.0), F.col("_qyy") - 2 * theta * F.col("_qxy") + theta * theta * F.col("_qxx")
    )
    variance = F.when(F.col("_flat"), F.col("raw_variance")).otherwise(F.try_divide(residual, F.col("_n") - 1))
    reduction = F.when(F.col("_flat") | (F.col("raw_variance") <= 0), F.lit(0.0)).otherwise(
        100 * (1 - F.try_divide(F.col("cuped_variance"), F.col("raw_variance")))
    )
    return (
        pooled.withColumn("cuped_variance", variance)
        .withColumn("variance_reduction_pct", reduction)
        .join(raw_effect, "metric")
        .join(tests, "metric")
        .join(intervals, "metric", "left")
        .select(
            "metric",
            "theta",
            "raw_variance",
            "cuped_variance",
            "variance_reduction_pct",
            "raw_effect_abs",
            "cuped_effect_abs",
            "cuped_ci_low",
            "cuped_ci_high",
            "cuped_p_value",
        )
    )
