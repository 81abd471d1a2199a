"""Percentile bootstrap with exactly n draws with replacement per arm and replicate.

Users with a value are dealt to leaves of a binary tree by a hash of their id. A replicate's n draws are split over the tree from
the root down: the left child of a node gets a binomial number of the node's draws, with the share of users it holds. So every leaf knows its number
of draws without seeing the others, the numbers add up to n exactly, and inside a leaf each draw picks one of its users. All randomness
follows from seed, metric, arm, node and leaf: a replicate is the same on any partitioning and after any recomputation.

A task holds one leaf at a time and one sum per (metric, arm, replicate); what is shuffled is those sums, once per task. The tree of counts is
broadcast: its size is bounded by ``MAX_LEVELS``, whatever the number of users. Work grows with users x replicates, as resampling users does;
``liftline.operators.bootstrap`` resamples hashed buckets at a cost that does not.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, functions as F

from liftline.operators.bootstrap import REPLICATE, percentile_interval
from liftline.operators.moments import ARM
from liftline.params import METRICS, Bootstrap

#: Users in a leaf, about; and levels of the tree at most (2^17 counts per metric and arm).
LEAF_USERS, MAX_LEVELS = 1_024, 17
LEAF = "_leaf"


def tree_levels(users: int) -> int:
    return min(MAX_LEVELS, max(0, -(-users // LEAF_USERS) - 1).bit_length())


def exact_sums(df: DataFrame, metrics: Sequence[str] = METRICS, boot: Bootstrap = Bootstrap(), unit: str = "user_id") -> DataFrame:
    """(metric, arm, replicate, n, sy): how many draws a replicate has and the sum of what was drawn."""
    long = df.select(F.col(unit).alias("_unit"), ARM, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["_unit", ARM], list(metrics), "metric", "y"
    ).where(F.col("y").isNotNull() & F.col(ARM).isNotNull())
    largest = long.groupBy("metric", ARM).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    levels = tree_levels(largest)
    leaves = long.withColumn(LEAF, F.pmod(F.xxhash64("_unit", F.lit(boot.seed)), F.lit(1 << levels)).cast("int"))
    counted = leaves.groupBy("metric", ARM, LEAF).agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by the tree
    sizes: dict[tuple[str, str], dict[int, int]] = {}
    for r in counted:
        sizes.setdefault((r["metric"], r[ARM]), {})[r[LEAF]] = r["n"]
    shared = df.sparkSession.sparkContext.broadcast(sizes)
    replicates, seed, order = boot.replicates, boot.seed, list(metrics)

    def resampled(frames: Iterator) -> Iterator:
        """Leaves of this partition come in order, each as a run of rows sorted by unit."""
        import zlib

        import numpy as np
        import pandas as pd

        totals: dict = {}
        trees: dict = {}
        path: list = []  # (level, node, draws of each replicate) from the root to the last leaf

        def tree(group: tuple) -> list:
            if group not in trees:
                counts = np.zeros(1 << levels, np.int64)
                for leaf, n in shared.value[group].items():
                    counts[leaf] = n
                trees.clear()
                trees[group] = [counts]
                while len(trees[group][-1]) > 1:
                    below = trees[group][-1]
                    trees[group].append(below[0::2] + below[1::2])
                trees[group].reverse()
            return trees[group]

        def draws(group: tuple, leaf: int) -> np.ndarray:
            counts, code = tree(group), [seed, order.index(group[0]), zlib.crc32(group[1].encode())]
            if not path or path[0][0] != group:
                path[:] = [(group, 0, np.full(replicates, counts[0][0], np.int64))]
            for level in range(1, levels + 1):
                node = leaf >> (levels - level)
                if level < len(path) and path[level][1] == node:
                    continue
                del path[level:]
                left, both = counts[level][node & ~1], counts[level - 1][node >> 1]
                rng = np.random.default_rng([*code, 1, level, node >> 1])
                taken = rng.binomial(path[-1][2], left / both)
                path.append((group, node, path[-1][2] - taken if node & 1 else taken))
            return path[-1][2]

        def close(group: tuple, leaf: int, values: list) -> None:
            y = np.concatenate(values)
            n = draws(group, leaf)
            rng = np.random.default_rng([seed, order.index(group[0]), zlib.crc32(group[1].encode()), 2, leaf])
            count, total = totals.setdefault(group, (np.zeros(replicates, np.int64), np.zeros(replicates)))
            count += n
            step = max(1, 4_000_000 // max(1, int(n.max())))
            for k in range(0, replicates, step):
                some = n[k : k + step]
                picked = np.append(0.0, np.cumsum(y[rng.integers(0, len(y), int(some.sum()))]))
                ends = np.cumsum(some)
                total[k : k + step] += picked[ends] - picked[ends - some]

        at, held = None, []
        for frame in frames:
            for (metric, arm, leaf), part in frame.groupby(["metric", ARM, LEAF], sort=False):
                if at is not None and at != (metric, arm, leaf):
                    close(at[:2], at[2], held)
                    held = []
                at = (metric, arm, leaf)
                held.append(part["y"].to_numpy())
        if at is not None:
            close(at[:2], at[2], held)
        for (metric, arm), (count, total) in totals.items():
            yield pd.DataFrame({"metric": metric, ARM: arm, REPLICATE: np.arange(replicates), "n": count, "sy": total})

    dealt = leaves.repartition("metric", ARM, LEAF).sortWithinPartitions("metric", ARM, LEAF, "_unit", "y")
    each = dealt.select("metric", ARM, LEAF, "y").mapInPandas(resampled, f"metric string, {ARM} string, {REPLICATE} int, n long, sy double")
    return each.groupBy("metric", ARM, REPLICATE).agg(F.sum("n").alias("n"), F.sum("sy").alias("sy"))


def exact_intervals(df: DataFrame, metrics: Sequence[str] = METRICS, boot: Bootstrap = Bootstrap(), unit: str = "user_id") -> DataFrame:
    """``ci_low`` and ``ci_high`` of the difference in means per metric."""
    return percentile_interval(exact_sums(df, metrics, boot, unit), F.try_divide(F.col("sy"), F.col("n")), boot)
