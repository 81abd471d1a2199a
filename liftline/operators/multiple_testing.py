"""Benjamini-Hochberg adjusted p-values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from liftline.params import PRIMARY_METRIC
from liftline.session import scratch_path


def benjamini_hochberg(
    df: DataFrame, ties: Sequence[str], family: Sequence[str], p: str = "p_value", out: str = "p_value_fdr"
) -> DataFrame:
    """Adds the q-value of each test within its family. Rows are test results, one per metric or
    segment; equal p-values are ranked by the ``ties`` columns and get equal q-values. A missing p-value
    ranks last, counts as a test of its family and gets the q-value 1."""
    by_p = Window.partitionBy(*family).orderBy(F.col(p).asc_nulls_last(), *ties)
    rank = F.row_number().over(by_p)
    tests = F.count(F.lit(1)).over(Window.partitionBy(*family))
    ranked = df.withColumn("_rank", rank).withColumn("_scaled", F.col(p) * tests / F.col("_rank"))
    from_largest = (
        Window.partitionBy(*family)
        .orderBy(F.col("_rank").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    q = F.least(F.lit(1.0), F.min("_scaled").over(from_largest))
    return ranked.withColumn(out, q).drop("_rank", "_scaled")


#: Tests per sorted range.
TESTS_PER_TASK = 1_000_000


def benjamini_hochberg_large(
    df: DataFrame, ties: Sequence[str], family: Sequence[str] = (), p: str = "p_value", out: str = "p_value_fdr"
) -> DataFrame:
    """The same q-values for families too large for one task.

    Tests are sorted by (family, p, ties) over ranges and stored in the scratch folder, numbered within each range. Ranks follow from the counts of the
    ranges before; the running minimum from the largest p-value down is taken within a range, and the least of the ranges after it is carried
    in. Windows span one range of a family or one row per range, never a family.
    """
    spark, keys = df.sparkSession, list(family)
    if not keys:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    order = [*keys, F.col(p).asc_nulls_last(), *ties]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // TESTS_PER_TASK))
    ranged = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    path = scratch_path(spark, "tests-in-order")
    ranged.withColumn("_range", F.shiftright("_row", 33)).write.parquet(path)
    stored = spark.read.parquet(path)

    at = [*keys, "_range"]
    named = {k: f"_at{i}" for i, k in enumerate(at)}
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(name)) for k, name in named.items()])
    per_range = Window.partitionBy(*list(named.values())[:-1]).orderBy(named["_range"])

    counts = stored.groupBy(*at).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")).withColumnsRenamed(named)
    before = F.coalesce(F.sum("_n").over(per_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    everything = per_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = counts.withColumns({"_before": before, "_tests": F.sum("_n").over(everything)}).drop("_n")
    ranked = stored.join(counts, same).drop(*named.values())
    ranked = ranked.withColumn("_rank", F.col("_row") - F.col("_first") + F.col("_before") + 1)
    ranked = ranked.withColumn("_scaled", F.col(p) * F.col("_tests") / F.col("_rank"))

    least = ranked.groupBy(*at).agg(F.min("_scaled").alias("_least")).withColumnsRenamed(named)
    later = F.min("_least").over(per_range.rowsBetween(1, Window.unboundedFollowing))
    carried = least.withColumn("_later", later).drop("_least")
    from_largest = Window.partitionBy(*at).orderBy(F.col("_rank").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranked.withColumn("_inside", F.min("_scaled").over(from_largest))
    q = F.least(F.lit(1.0), "_inside", "_later")
    return inside.join(carried, same).withColumn(out, q).select(*df.columns, out).drop("_all")


def metric_family(primary: str = PRIMARY_METRIC) -> Column:
    return F.when(F.col("metric") == primary, F.lit("primary")).otherwise(F.lit("secondary"))


def with_metric_fdr(results: DataFrame, primary: str = PRIMARY_METRIC, level: float = 0.05) -> DataFrame:
    """The primary metric keeps its own p-value; all others are adjusted together. A test without a
    p-value is never significant."""
    adjusted = benjamini_hochberg(results.withColumn("_family", metric_family(primary)), ["metric"], ["_family"])
    return (
        adjusted.withColumn(
            "p_value_fdr",
            F.when(F.col("_family") == "primary", F.col("p_value")).otherwise(F.col("p_value_fdr")),
        )
        .withColumn("significant_fdr_05", F.coalesce(F.col("p_value_fdr") <= level, F.lit(False)))
        .drop("_family")
    )
