"""Percentile bootstrap intervals from Poisson(1) resampling weights.

A unit's weight in a replicate depends only on (seed, arm, unit, replicate), so replicates are the
same on any partitioning and after any recomputation. Units are hashed buckets of users (see
``bucket_cells``): the replicate work is buckets x replicates per arm, not users x replicates, and
widths carry an extra relative error of about 1 / sqrt(2 x buckets).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from liftline.functions.resampling import (
    DRAWS_PER_DIGEST,
    digest_draws,
    draw_digest,
    has_weight,
    poisson_weight,
)
from liftline.operators.moments import ARM, BUCKET, bucket_cells, by_metric
from liftline.params import CONTROL, METRICS, TREATMENT, Bootstrap

REPLICATE = "_replicate"
# Resampled rows given to one task when the units are buckets.
ROWS_PER_TASK = 250_000


def replicate_sums(
    cells: DataFrame, sums: Sequence[str], boot: Bootstrap, groups: Sequence[str] = ()
) -> DataFrame:
    """Weighted sums of the given cell columns per (groups, arm, replicate)."""
    blocks = math.ceil(boot.replicates / DRAWS_PER_DIGEST)
    # Always true. Naming the other columns keeps them in the cells on this side too, so that the
    # cells behind the tests and those behind the intervals are one shuffle, computed once.
    spreads = [c for c in cells.columns if c.startswith(("q", "x_m", "n_all_", "sy_all_"))]
    cells = cells.where(" AND ".join(f"(`{c}` IS NULL OR `{c}` >= double('-inf'))" for c in spreads))
    if boot.buckets is not None:
        # Cells are few and small, but each becomes thousands of weighted rows: spread them first.
        tasks = math.ceil(2 * boot.buckets * boot.replicates / ROWS_PER_TASK)
        if groups:  # their number is unknown: as many tasks as a shuffle has
            tasks = max(2 * tasks, int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        cells = cells.repartition(tasks, *groups, ARM, BUCKET)
    # Digest and weight are columns of their own steps, so each is worked out once per row; draws
    # that give weight 0 are dropped before they are weighed.
    digest = draw_digest(F.lit(str(boot.seed)), F.col(ARM), F.col(BUCKET).cast("string"), F.col("_block").cast("string"))
    return (
        cells.select(*groups, ARM, BUCKET, *sums, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
        .select(*groups, ARM, *sums, "_block", digest.alias("_digest"))
        .select(*groups, ARM, *sums, "_block", F.posexplode(digest_draws(F.col("_digest"))).alias("_i", "_draw"))
        .withColumn(REPLICATE, F.col("_block") * DRAWS_PER_DIGEST + F.col("_i"))
        .where(has_weight(F.col("_draw")) & (F.col(REPLICATE) < boot.replicates))
        .select(*groups, ARM, REPLICATE, *sums, poisson_weight("_draw").alias("_weight"))
        .groupBy(*groups, ARM, REPLICATE)
        .agg(*[F.sum(F.col("_weight") * F.col(s)).alias(s) for s in sums])
    )


def percentile_interval(
    means: DataFrame, value: Column, boot: Bootstrap, groups: Sequence[str] = ()
) -> DataFrame:
    """Interval of treatment minus control from one row per (groups, metric, arm, replicate).
    Each group holds one value per replicate."""
    difference = F.max(F.when(F.col(ARM) == TREATMENT, value)) - F.max(F.when(F.col(ARM) == CONTROL, value))
    bounds = F.percentile("_difference", F.array(F.lit(boot.lower), F.lit(boot.upper)))
    return (
        means.groupBy(*groups, "metric", REPLICATE)
        .agg(difference.alias("_difference"))
        .groupBy(*groups, "metric")
        .agg(bounds.alias("_bounds"))
        .select(*groups, "metric", F.col("_bounds")[0].alias("ci_low"), F.col("_bounds")[1].alias("ci_high"))
    )


def interval_from_cells(
    cells: DataFrame, metrics: Sequence[str], boot: Bootstrap, groups: Sequence[str] = ()
) -> DataFrame:
    sums = [f"{p}_{m}" for m in metrics for p in ("n", "sy")]
    long = by_metric(replicate_sums(cells, sums, boot, groups), metrics, [*groups, ARM, REPLICATE], ["n", "sy"])
    return percentile_interval(long, F.try_divide(F.col("sy"), F.col("n")), boot, groups)


def bootstrap_difference(
    df: DataFrame,
    metrics: Sequence[str] = METRICS,
    boot: Bootstrap = Bootstrap(),
    groups: Sequence[str] = (),
    unit: str = "user_id",
) -> DataFrame:
    """``ci_low`` and ``ci_high`` of the difference in means per (groups, metric)."""
    return interval_from_cells(bucket_cells(df, metrics, boot, groups, unit=unit), metrics, boot, groups)
