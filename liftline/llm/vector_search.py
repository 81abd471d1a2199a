"""Nearest neighbours by randomly rotated one-bit codes.

Every vector, less the centroid of all, is scaled to unit length, rotated by a random orthogonal matrix and kept as the signs
of its components, packed to bits, with two scalars: its distance from the centroid, and how well the signs represent it (their
inner product with the rotated vector). From these the inner product with a query is estimated without bias, with a bound on the error that
holds with high probability (``ERROR`` standard deviations). A vector is reranked by its exact distance only where the
lower bound of its distance is below the k-th exact distance found so far.

Vectors are dealt to slabs by the hash of their id, so that each slab is bounded however many vectors are equal; every block of queries
goes to every slab. A task holds the codes and vectors of one slab and lets the queries stream past, so its memory is bounded whatever
the number of queries. Each slab returns its k best of each query and the last step merges those. The centroid is the only statistic and
covers all vectors; the matrix depends on the dimension alone.

Defined results: NULL or zero vectors and those with NULL or non-finite components take no part, nor do rows with a NULL id; vectors
are compared with those of the same dimension; of rows with the same id the first vector in order counts; ties go to the
smaller id; other columns are ignored; with fewer than k candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from liftline.llm.common import col, map_frames, written

#: Vectors per slab, and queries that pass through a slab at once.
SLAB, QUERIES = 65_536, 256
#: Standard deviations of the estimate's error that a bound allows for.
ERROR = 2.5
SEED = 20_240_501


@lru_cache(maxsize=8)
def rotation(dimension: int) -> np.ndarray:
    random = np.random.default_rng(SEED).standard_normal((dimension, dimension))
    q, r = np.linalg.qr(random)
    return q * np.sign(np.diag(r))


class Codes:
    """Packed one-bit codes of vectors around a centroid."""

    def __init__(self, vectors: np.ndarray, centroid: np.ndarray):
        self.dimension = vectors.shape[1]
        centred = vectors - centroid
        self.length = np.linalg.norm(centred, axis=1)
        turned = centred @ rotation(self.dimension) / np.where(self.length > 0, self.length, 1)[:, None]
        self.bits = np.packbits(turned > 0, axis=1)
        #: Inner product of each unit vector with its code, whose components are +-1 / sqrt(dimension).
        self.fit = np.abs(turned).sum(axis=1) / np.sqrt(self.dimension)
        self.fit[self.length == 0] = 1

    def signs(self) -> np.ndarray:
        bits = np.unpackbits(self.bits, axis=1, count=self.dimension)
        return (bits.astype(np.float32) * 2 - 1) / np.float32(np.sqrt(self.dimension))

    def bounds(self, queries: np.ndarray, centroid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(estimates, lower bounds) of squared distances: a row per query, a column per code."""
        centred = queries - centroid
        length = np.linalg.norm(centred, axis=1)
        turned = (centred @ rotation(self.dimension) / np.where(length > 0, length, 1)[:, None]).astype(np.float32)
        inner = (turned @ self.signs().T) / self.fit
        slack = ERROR * np.sqrt(np.maximum(0, 1 - self.fit**2)) / self.fit / np.sqrt(max(1, self.dimension - 1))
        both = 2 * length[:, None] * self.length[None, :]
        base = length[:, None] ** 2 + self.length[None, :] ** 2
        return base - both * inner, base - both * np.minimum(1, inner + slack)


def nearest_in(
    ids: np.ndarray, vectors: np.ndarray, codes: Codes, query_ids: np.ndarray, queries: np.ndarray, centroid: np.ndarray, k: int
) -> list[tuple[int, int, float]]:
    """(query id, id, distance) of the k nearest of each query among the vectors of a slab."""
    estimates, lower = codes.bounds(queries, centroid)
    out = []
    for q, (query_id, query) in enumerate(zip(query_ids.tolist(), queries)):
        able = np.flatnonzero(ids != query_id)
        if not len(able):
            continue
        m = min(k, len(able))
        # the k of the best estimates give a first k-th distance; every code whose bound is below it is reranked
        first = able[np.argpartition(estimates[q, able], m - 1)[:m]]
        limit = np.max(((vectors[first] - query) ** 2).sum(axis=1))
        chosen = able[lower[q, able] <= limit * (1 + 1e-6)]
        chosen = np.union1d(chosen, first)
        distance = np.sqrt(((vectors[chosen] - query) ** 2).sum(axis=1))
        best = np.lexsort((ids[chosen], distance))[:m]
        out += [(query_id, int(ids[c]), float(d)) for c, d in zip(chosen[best], distance[best])]
    return out


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def search(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", slab: int = SLAB
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` marks, its k nearest other rows and their distances."""
    rows = vectors.select(
        col(id_col).cast("long").alias("id"), col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & _usable(F.col("v"))).withColumn("d", F.size("v"))
    spark = vectors.sparkSession
    sizes = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per dimension
    total = sum(r["n"] for r in sizes)
    wanted = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // 1024))
    slabs = max(1, wanted, -(-total // slab))
    means = rows.select("d", F.posexplode("v").alias("i", "x")).groupBy("d", "i").agg(F.avg("x").alias("x")).collect()
    centroids = {r["d"]: np.zeros(r["d"]) for r in sizes}
    for r in means:  # as many numbers as dimensions
        centroids[r["d"]][r["i"]] = r["x"]

    slab_of = F.pmod(F.xxhash64("id"), F.lit(slabs)).cast("int")
    data = rows.select(F.lit(0).alias("kind"), slab_of.alias("slab"), "id", "v", "d")
    asked = written(rows.where("asks").groupBy("id").agg(F.min("v").alias("v")), "queries")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))
    asking = asked.select(F.lit(1).alias("kind"), everywhere.alias("slab"), "id", "v", F.size("v").alias("d"))
    both = data.unionByName(asking).repartition(slabs, "slab").sortWithinPartitions("slab", "kind", "d", "id", "v")

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, ready = None, False
        held: dict[int, list] = {}
        slabs_of: dict[int, tuple] = {}

        def close() -> None:
            for d, parts in held.items():
                ids = np.concatenate([p[0] for p in parts])
                values = np.concatenate([p[1] for p in parts])
                once = np.concatenate([[True], ids[1:] != ids[:-1]])  # sorted: the first vector of each id
                slabs_of[d] = ids[once], values[once], Codes(values[once], centroids[d])
            held.clear()

        for frame in frames:
            for (slab, kind, d), part in frame.groupby(["slab", "kind", "d"], sort=True):
                if slab != at:
                    at, ready = slab, False
                    held.clear()
                    slabs_of.clear()
                if kind == 0:
                    held.setdefault(d, []).append((part["id"].to_numpy(), np.stack(part["v"].to_numpy())))
                    continue
                if not ready:
                    close()
                    ready = True
                if d not in slabs_of:
                    continue
                ids, values, codes = slabs_of[d]
                for q in range(0, len(part), QUERIES):
                    some = part.iloc[q : q + QUERIES]
                    got = nearest_in(ids, values, codes, some["id"].to_numpy(), np.stack(some["v"].to_numpy()), centroids[d], k)
                    yield pd.DataFrame(got, columns=["query_id", "vec_id", "score"])

    best = map_frames(both, found, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
