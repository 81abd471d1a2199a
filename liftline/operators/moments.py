"""Counts, sums and centred second moments per arm.

The bucket form reduces users to a bounded number of hashed groups per arm in one aggregate. Means,
variances, covariances and bootstrap replicates are all read off those groups, so the user-level
table is scanned once whatever is estimated from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from liftline.functions.resampling import hashed_bucket
from liftline.params import METRICS, Bootstrap

ARM = "assigned_variant"
BUCKET = "_bucket"


def _parts(x: str | None) -> list[str]:
    return ["n", "sy", "qyy"] + (["sx", "qxx", "qxy", "x_min", "x_max", "n_all", "sy_all"] if x else [])


def _totals(metric: str, x: str | None) -> list[Column]:
    """Aggregates of one metric; with a covariate, over rows where both are present, and the count and sum
    of all its values besides."""
    y = f"CAST(`{metric}` AS DOUBLE)"
    exprs = {"n": f"count({y})", "sy": f"sum({y})", "qyy": f"var_pop({y}) * count({y})"}
    if x:
        alone = {"n_all": f"count({y})", "sy_all": f"sum({y})"}
        both = f"`{metric}` IS NOT NULL AND `{x}` IS NOT NULL"
        y = f"CASE WHEN {both} THEN {y} END"
        xx = f"CASE WHEN {both} THEN CAST(`{x}` AS DOUBLE) END"
        exprs = {
            "n": f"count({y})",
            "sy": f"sum({y})",
            "qyy": f"var_pop({y}) * count({y})",
            "sx": f"sum({xx})",
            "qxx": f"var_pop({xx}) * count({y})",
            "qxy": f"covar_pop({xx}, {y}) * count({y})",
        } | alone
    out = [F.expr(f"coalesce({e}, 0) AS `{part}_{metric}`") for part, e in exprs.items()]
    if x:
        out += [F.expr(f"{f}({xx}) AS `x_{f}_{metric}`") for f in ("min", "max")]
    return out


def bucket_cells(
    df: DataFrame,
    metrics: Sequence[str],
    boot: Bootstrap,
    groups: Sequence[str] = (),
    x: str | None = None,
    unit: str = "user_id",
) -> DataFrame:
    """One row per (groups, arm, bucket); with ``boot.buckets`` unset, one per unit."""
    bucket = F.col(unit) if boot.buckets is None else hashed_bucket(boot.seed, F.col(unit), boot.buckets)
    return (
        df.withColumn(BUCKET, bucket)
        .groupBy(*groups, ARM, BUCKET)
        .agg(*[c for m in metrics for c in _totals(m, x)])
    )


def by_metric(wide: DataFrame, metrics: Sequence[str], keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Columns ``<part>_<metric>`` turned into one row per metric with a column per part."""
    rows = ", ".join(f"'{m}', " + ", ".join(f"`{p}_{m}`" for p in parts) for m in metrics)
    return wide.select(*keys, F.expr(f"stack({len(metrics)}, {rows}) AS (metric, {', '.join(parts)})"))


def merged(rows: DataFrame, keys: Sequence[str], x: str | None = None) -> DataFrame:
    """Partial moments combined per key without losing digits: what lies inside the parts plus
    what lies between their means. A key holds at most one row per bucket."""
    window = Window.partitionBy(*keys)
    n_total = F.sum("n").over(window)
    rows = rows.withColumn("_ybar", F.try_divide(F.sum("sy").over(window), n_total))
    dy = F.try_divide(F.col("sy"), F.col("n")) - F.col("_ybar")
    sums = {"qyy": F.col("qyy") + F.col("n") * dy * dy}
    if x:
        rows = rows.withColumn("_xbar", F.try_divide(F.sum("sx").over(window), n_total))
        dx = F.try_divide(F.col("sx"), F.col("n")) - F.col("_xbar")
        sums["qxx"] = F.col("qxx") + F.col("n") * dx * dx
        sums["qxy"] = F.col("qxy") + F.col("n") * dx * dy
    out = [F.sum("n").alias("n"), F.sum("sy").alias("sy")]
    out += [F.coalesce(F.sum(e), F.lit(0.0)).alias(name) for name, e in sums.items()]
    if x:
        out += [F.sum("sx").alias("sx"), F.min("x_min").alias("x_min"), F.max("x_max").alias("x_max")]
        out += [F.sum(c).alias(c) for c in ("n_all", "sy_all")]
    return rows.groupBy(*keys).agg(*out)


def arm_parts(
    df: DataFrame, cells: DataFrame, metrics: Sequence[str], boot: Bootstrap,
    groups: Sequence[str] = (), x: str | None = None,
) -> DataFrame:
    """Moments per (groups, metric, arm). Bounded buckets are merged; without them the rows are
    aggregated directly, since merging would put every unit of an arm in one window."""
    keys = [*groups, ARM]
    if boot.buckets is None:
        wide = df.groupBy(*keys).agg(*[c for m in metrics for c in _totals(m, x)])
        return by_metric(wide, metrics, keys, _parts(x))
    return merged(by_metric(cells, metrics, [*keys, BUCKET], _parts(x)), [*groups, "metric", ARM], x)


def _described(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    n = F.col("n")
    variance = F.when(n > 1, F.try_divide(F.col("qyy"), n - 1)).otherwise(F.lit(0.0))
    return parts.select(*keys, n.alias("n"), F.try_divide(F.col("sy"), n).alias("mean"), variance.alias("variance"))


def moments_from_parts(parts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    return _described(parts, [*groups, "metric", ARM])


def arm_moments(df: DataFrame, metrics: Sequence[str] = METRICS, groups: Sequence[str] = ()) -> DataFrame:
    """n, mean and sample variance per (groups, metric, arm); NULL outcomes are dropped, and the
    variance of fewer than two values is 0."""
    keys = [*groups, ARM]
    wide = df.groupBy(*keys).agg(*[c for m in metrics for c in _totals(m, None)])
    return _described(by_metric(wide, metrics, keys, _parts(None)), [*groups, "metric", ARM])
