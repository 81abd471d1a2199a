"""Compression of vectors to one code per part, with codebooks from dual-tree Lloyd rounds.

Components become integers, floor(256 x), and a vector is cut into equal consecutive parts. The parts at one position, taken a block
of vectors at a time, form a balanced tree; so do the entries of that position's codebook. A round walks both trees at once. For a pair
of nodes the boxes around them give the least distance between any part and any entry, and the box of parts with one entry of the other node
gives a distance that no part's nearest entry exceeds: pairs beyond that are pruned. A node of parts left with a single entry is assigned whole
by its cached count and sum; leaves left with several compare integers. All bounds are integers too, so nothing is lost to rounding.

The order of each tree is stored with its block once and read by every round. A task sends one count and one sum per entry, so a round shuffles
tasks x parts x entries rows whatever the number of vectors; codebooks are the only thing the driver holds.

Defined results: rows whose vector is NULL or has NULL or non-finite components are left out; vectors shorter than the longest, and
those whose length is no multiple of the number of parts, are filled up with zeros; components beyond +-2^27 are taken as that bound, so
that squares fit 64 bits; the first entries are those of the smallest ids (NULL last), equal ids in order of their vectors; with fewer rows than entries the
codebooks are that small; ties between entries go to the lower index; repeated rows are rows of their own; NULL labels count as
equal; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from liftline.llm.common import broadcast_if_small, col, map_frames, written
from liftline.llm.tokens import ranges

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Vectors per block, about (a block takes whole frames, and has fewer than 2^16), and parts per leaf of its trees.
BLOCK, LEAF = 8_192, 4
SCALE, LARGEST = 256, 1 << 27
#: Sums of labels that may be broadcast; beyond that the join shuffles.
BROADCAST_LABELS = 100_000


def bounds(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin in the order of a tree of ``n`` points, and ``n``."""
    return np.arange((1 << level) + 1) * n >> level


def tree_order(points: np.ndarray, depth: int) -> np.ndarray:
    """An order of the points in which each node of each level is a run: every node is halved along its widest side."""
    n = len(points)
    order = np.arange(n)
    for level in range(depth):
        edge = bounds(n, level)
        placed = points[order]
        low, high = np.minimum.reduceat(placed, edge[:-1]), np.maximum.reduceat(placed, edge[:-1])
        node = np.repeat(np.arange(1 << level), np.diff(edge))
        side = np.argmax(high - low, axis=1)[node]
        order = order[np.lexsort((placed[np.arange(n), side], node))]
    return order


def part_depth(n: int) -> int:
    return max(0, (n // LEAF).bit_length() - 1)


class Tree:
    """Boxes, counts and sums of the nodes of each level; level 0 is the root."""

    def __init__(self, points: np.ndarray, depth: int):
        n = len(points)
        self.points, self.depth = points, depth
        self.edges = [bounds(n, level) for level in range(depth + 1)]
        self.low = [np.minimum.reduceat(points, e[:-1]) for e in self.edges]
        self.high = [np.maximum.reduceat(points, e[:-1]) for e in self.edges]
        self.sums = [np.add.reduceat(points, e[:-1]) for e in self.edges]


class EntryTree(Tree):
    """The different entries of one codebook, down to single ones; of equal entries the lowest index stands for all."""

    def __init__(self, entries: np.ndarray):
        different, index = np.unique(entries, axis=0, return_index=True)
        depth = (len(different) - 1).bit_length()
        at = np.minimum(np.arange(1 << depth), len(different) - 1)  # a power of two: the last entry fills up
        order = tree_order(different[at], depth)
        super().__init__(different[at][order], depth)
        self.index, self.real = index[at][order], order < len(different)


def nearest(parts: Tree, entries: EntryTree) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(counts, sums) per entry of the parts assigned to it, and (positions, entries) of the assigned runs of parts: whole nodes first."""
    n_entries = int(entries.index.max()) + 1
    counts, sums = np.zeros(n_entries, np.int64), np.zeros((n_entries, parts.points.shape[1]), np.int64)
    placed, chosen = [], []
    p, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    level_p = level_e = 0
    while True:
        low, high = parts.low[level_p][p], parts.high[level_p][p]
        gap = np.maximum(0, np.maximum(entries.low[level_e][e] - high, low - entries.high[level_e][e]))
        least = (gap * gap).sum(axis=1)
        one = entries.points[entries.edges[level_e][e]]
        far = np.maximum(np.abs(high - one), np.abs(one - low))
        most = (far * far).sum(axis=1)
        limit = np.full(1 << level_p, np.iinfo(np.int64).max)
        np.minimum.at(limit, p, most)
        kept = least <= limit[p]
        if level_e == entries.depth:
            kept &= entries.real[e]
            # the entry of the limit is nearer than another to every part of the box if it is so at the corner towards the other
            best = np.zeros(1 << level_p, np.int64)
            at_limit = (most == limit[p]) & entries.real[e]
            best[p[at_limit]] = e[at_limit]
            rival = entries.points[best[p]]
            corner = np.where(one > rival, high, low)
            kept &= (e == best[p]) | (((corner - one) ** 2).sum(axis=1) <= ((corner - rival) ** 2).sum(axis=1))
        p, e = p[kept], e[kept]
        if level_e < entries.depth:
            level_e += 1
            e = np.concatenate([2 * e, 2 * e + 1])
            p = np.concatenate([p, p])
            if level_p < parts.depth:
                level_p += 1
                p, e = np.concatenate([2 * p, 2 * p + 1]), np.concatenate([e, e])
            continue
        single = np.bincount(p, minlength=1 << level_p)[p] == 1
        if single.any():
            node, entry = p[single], entries.index[e[single]]
            edge = parts.edges[level_p]
            size = edge[node + 1] - edge[node]
            np.add.at(counts, entry, size)
            np.add.at(sums, entry, parts.sums[level_p][node])
            placed.append(ranges(edge[node], size))
            chosen.append(np.repeat(entry, size))
            p, e = p[~single], e[~single]
        if level_p == parts.depth or not len(p):
            break
        level_p += 1
        p, e = np.concatenate([2 * p, 2 * p + 1]), np.concatenate([e, e])
    if len(p):
        # uncertain leaves: every part with every entry left, in integers; the least (distance, index) of a part wins
        edge = parts.edges[level_p]
        size = edge[p + 1] - edge[p]
        at, entry = ranges(edge[p], size), np.repeat(e, size)
        step = parts.points[at] - entries.points[entry]
        order = np.lexsort((entries.index[entry], (step * step).sum(axis=1), at))
        at, entry = at[order], entries.index[entry[order]]
        first = np.concatenate([[True], at[1:] != at[:-1]])
        at, entry = at[first], entry[first]
        np.add.at(counts, entry, 1)
        np.add.at(sums, entry, parts.points[at])
        placed.append(at)
        chosen.append(entry)
    return counts, sums, placed, chosen


def _integers(vector: Column) -> Column:
    bound = F.lit(float(LARGEST))
    return F.transform(vector, lambda x: F.floor(F.greatest(-bound, F.least(bound, x * SCALE))).cast("int"))


def _finite(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def blocks(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """(ids, points, orders) of rows (row, v): blocks of vectors with the order of each part's tree, stored."""

    def built(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            held.append(frame)
            if sum(map(len, held)) >= BLOCK:
                yield block(pd.concat(held))
                held = []
        if held:
            yield block(pd.concat(held))

    def block(some: pd.DataFrame) -> pd.DataFrame:
        points = np.zeros((len(some), width), np.int32)
        for i, v in enumerate(some["v"]):
            points[i, : len(v)] = v
        each = points.astype(np.int64).reshape(len(some), parts, width // parts)
        orders = np.stack([tree_order(each[:, j], part_depth(len(some))) for j in range(parts)])
        return pd.DataFrame({
            "ids": [some["row"].to_numpy(np.int64).tobytes()], "points": [points.tobytes()], "orders": [orders.astype(np.uint16).tobytes()],
        })

    return written(map_frames(rows.select("row", "v"), built, "ids binary, points binary, orders binary"), "part-trees")


def _unpacked(row, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, np.int64)
    points = np.frombuffer(row.points, np.int32).astype(np.int64).reshape(len(ids), parts, -1)
    return ids, points, np.frombuffer(row.orders, np.uint16).reshape(parts, len(ids))


def lloyd_round(stored: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (part, entry, component) after one round; unused entries stay."""
    parts = len(books)

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = [EntryTree(b) for b in books if len(b)]
        counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for frame in frames:
            for row in frame.itertuples():
                _, points, orders = _unpacked(row, parts)
                for j in range(parts):
                    n, s, _, _ = nearest(Tree(points[orders[j], j], part_depth(len(points))), trees[j])
                    counts[j, : len(n)] += n
                    sums[j, : len(n)] += s
        part, entry = np.nonzero(counts)
        yield pd.DataFrame({"part": part, "entry": entry, "n": counts[part, entry], "s": sums[part, entry].tolist()})

    width = books.shape[2]
    each = map_frames(stored, summed, "part int, entry int, n long, s array<long>")
    total = each.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(width)])
    out = books.copy()
    for r in total.collect():  # one row per entry of a codebook
        out[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return out


def assigned(stored: DataFrame, books: np.ndarray) -> DataFrame:
    """(row, code, error) of every vector: its entries as hex digits and the squared distance to them."""
    parts = len(books)

    def coded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = [EntryTree(b) for b in books if len(b)]
        for frame in frames:
            for row in frame.itertuples():
                ids, points, orders = _unpacked(row, parts)
                codes = np.zeros((len(ids), parts), np.int64)
                for j in range(parts):
                    _, _, at, entry = nearest(Tree(points[orders[j], j], part_depth(len(ids))), trees[j])
                    codes[orders[j][np.concatenate(at)], j] = np.concatenate(entry)
                step = points - books[np.arange(parts), codes]
                text = codes.astype(np.uint8).tobytes().hex()
                yield pd.DataFrame({
                    "row": ids, "code": [text[2 * parts * i : 2 * parts * (i + 1)] for i in range(len(ids))],
                    "error": (step * step).sum(axis=(1, 2)),
                })

    return map_frames(stored, coded, "row long, code string, error long")


def books_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.reshape(-1).tolist()))


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id",
    vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error, label_error), codebooks)."""
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    given = vectors.select(col(id_col).alias("vec_id"), col(label_col).alias("label"), col(vector_col).cast("array<double>").alias("v"))
    kept = given.where(_finite(F.col("v"))).withColumn("v", _integers(F.col("v")))
    rows = written(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-max(longest, 1) // parts) * parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # as many as a codebook has
    books = np.zeros((len(first), width), np.int64)
    for i, r in enumerate(first):
        books[i, : len(r["v"])] = r["v"]
    books = books.reshape(len(first), parts, width // parts).transpose(1, 0, 2)
    stored = blocks(rows, width, parts)
    for _ in range(rounds if len(first) else 0):
        books = lloyd_round(stored, books)
    named = written(rows.select("row", "vec_id", "label").join(assigned(stored, books), "row").drop("row"), "codes")
    per_label = named.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = broadcast_if_small(written(per_label.withColumnRenamed("label", "other"), "label-errors"), BROADCAST_LABELS)
    out = named.join(sums, F.col("label").eqNullSafe(F.col("other"))).drop("other")
    return out.select("vec_id", "label", "code", "error", "label_error"), books


def digest(found: DataFrame, books: np.ndarray) -> DataFrame:
    name = hashlib.sha256(books_text(books).encode()).hexdigest()
    return found.select("vec_id", "code", "error", "label_error", F.lit(name).alias("codebooks_sha256"))
