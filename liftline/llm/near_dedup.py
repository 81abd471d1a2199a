"""Near-duplicates by Order MinHash sketches and banded alignment.

A text is its sequence of five-word shingles, each labelled by how often it occurred before. The similarity of two texts is
m / (a + b - m) for m shingles aligned in order out of a and b; alignment looks only as far off the diagonal as 0.8 allows, so it is
exact there.

Texts of up to ``EXACT`` shingles meet by prefix filter, which loses no pair: labelled shingles are ordered from rare to common, and
two texts of similarity 0.8 share one among the first n - 0.8 n + 1 of each. Texts of ``LONG`` or more shingles meet by sketches. A
sketch takes the ``PER_SKETCH`` labelled shingles of the smallest random values and keeps their order in the text; texts whose
sketches agree, order included, share a bucket. A pair of m aligned shingles out of N shares a sketch of k with the chance
C(m, k) / C(N, k): with ``SKETCHES`` of them a pair of similarity 0.8 is missed at most 4.2 times in a million. No
similar pair has a text below ``LONG`` and one above ``EXACT``.

Equal word sequences are one node of the graph, whatever the number of copies. Within a bucket every node is compared with
``CENTRES`` nodes of it, not with all: groups of copies are tied together by few pairs. Where a bucket then still holds several
components, all pairs across them are compared if it has few members (``SMALL``). In a prefix bucket only pairs meet whose sizes let the
shared prefixes reach that shingle. The members of a larger bucket of sketches, typically texts that share a long passage or come from
one text by many edits, meet again by their prefixes, with shingles ordered by how often those members have them: exact, and what many
share stands at the end of that order, beyond the prefixes.

The members of larger prefix buckets meet by their differences from a centre, the node of most links in the bucket's largest component.
With X the labelled shingles of a text and P those of the centre, X ^ Y = (X ^ P) ^ (Y ^ P): two texts are at most as far apart as 0.8
allows only if their differences share (|X ^ P| + |Y ^ P| - allowed) / 2 elements, so they meet by a prefix filter of the differences.
What a family of edited texts has in common is in no difference, and its own edits come first in each. Texts as near to the centre as 0.8
allows, but not aligned with it (parts moved), are compared with the other near ones of their buckets.

Components are found by alternating star contraction, checkpointed each round; links found later are contracted between the components
already known.

Defined results: every row gets a class, the smallest id in its group; texts of fewer than five words are grouped only if
their words are equal; texts without words (NULL or empty) are their own class; a NULL id is in a class like any other and is never
its name unless all ids are NULL; repeated rows share a class; other columns are ignored or, in ``deduped``, kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from liftline.llm.common import broadcast_if_small, col, map_frames, texts, written
from liftline.llm.tokens import mixed
from liftline.llm.words import SHINGLE, words
from liftline.session import scratch_folder

SIMILARITY = 0.8
SKETCHES, PER_SKETCH = 32, 5
#: Texts of up to ``EXACT`` shingles meet by prefixes, those of ``LONG`` or more by sketches: no similar pair lies astride the two.
EXACT, LONG = 125, 100
#: Counters by which shingles are ordered from rare to common; any order is exact.
SLOTS, CHUNK = 1 << 20, 1 << 12
CENTRES = 2
#: Rows of eight bytes that may be broadcast; beyond that the join shuffles.
BROADCAST_ROWS = 1_000_000
SMALL = 32
#: Rows of links that a task gets at least where a table is small.
TASK_ROWS = 50_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_values(word_hashes: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """One 64-bit value per ``n`` words in a row."""
    w = mixed(word_hashes.astype(np.uint64))
    if len(w) < n:
        return np.zeros(0, np.uint64)
    return mixed(reduce(lambda a, k: a * ODD + w[k : len(w) - n + 1 + k], range(1, n), w[: len(w) - n + 1]))


def labelled_values(shingles: np.ndarray) -> np.ndarray:
    """Each shingle with how often it occurred before, as one value: all differ."""
    n = len(shingles)
    if not n:
        return np.zeros(0, np.uint64)
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    seen = np.empty(n, np.uint64)
    seen[order] = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    return mixed(shingles + seen * ODD)


def order_sketch(shingles: np.ndarray, sketches: int, per_sketch: int) -> np.ndarray:
    """Bucket numbers of a sequence of shingles; none for an empty one."""
    n = len(shingles)
    if not n:
        return np.zeros(0, np.int64)
    labelled = labelled_values(shingles)
    take = min(per_sketch, n)
    out = []
    step = max(1, 250_000 // n)
    for k in range(0, sketches, step):
        seeds = np.arange(k, min(sketches, k + step), dtype=np.uint64)
        values = (labelled[None, :] ^ mixed(seeds)[:, None]) * (mixed(seeds + np.uint64(77)) | np.uint64(1))[:, None]
        smallest = np.argpartition(values, take - 1, axis=1)[:, :take] if take < n else np.tile(np.arange(n), (len(seeds), 1))
        kept = shingles[np.sort(smallest, axis=1)]  # in text order
        tuple_hash = reduce(lambda a, j: mixed(a * ODD + kept[:, j]), range(take), mixed(seeds + np.uint64(per_sketch << 20)))
        out.append(tuple_hash.view(np.int64))
    return np.concatenate(out)


def prefix(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The labelled shingles, rare ones first, of which every similar sequence's prefix has one: all but as many as must be shared, and one."""
    labelled = labelled_values(shingles)
    n = len(labelled)
    order = np.lexsort((labelled, counts[labelled % np.uint64(len(counts))]))
    return labelled[order[: n - int(np.ceil(SIMILARITY * n - 1e-9)) + 1 if n else 0]]


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The longest common subsequence of two sequences within ``band`` of the diagonal: one row of bits per element of ``b``, as wide as
    the band, so that the work is linear in the texts."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    size = len(a)
    places: dict[int, list[int]] = {}
    for i, x in enumerate(a.tolist()):
        places.setdefault(x, []).append(i)
    #: Per element seen: the first place its bits stand for, the bits, and how many of its places are in them.
    seen: dict[int, tuple[int, int, int]] = {}
    low, high, free, matched = 0, 0, 0, 0  # the band holds the places [low, high); a bit of ``free`` is 0 where a match ends
    for j, x in enumerate(b.tolist()):
        wide = min(size, j + band + 1)
        if wide > high:
            free |= ((1 << (wide - high)) - 1) << (high - low)
            high = wide
        left = min(max(0, j - band), high)
        if left > low:
            gone = left - low
            matched += gone - (free & ((1 << gone) - 1)).bit_count()
            free >>= gone
            low = left
        if low >= size:
            break
        mine = places.get(x)
        if mine is None:
            continue
        since, bits, used = seen.get(x, (low, 0, 0))
        bits >>= low - since
        while used < len(mine) and mine[used] < high:
            if mine[used] >= low:
                bits |= 1 << (mine[used] - low)
            used += 1
        seen[x] = (low, bits, used)
        both = free & bits
        if both:
            free = ((free + both) | (free - both)) & ((1 << (high - low)) - 1)
    return head + tail + matched + (high - low) - free.bit_count()


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether m / (len(a) + len(b) - m) is at least ``least`` for the m shingles aligned in order."""
    total = len(a) + len(b)
    need = int(np.ceil(least * total / (1 + least) - 1e-9))
    if need > min(len(a), len(b)):
        return False
    x, y = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if int(np.minimum(x[1][i], y[1][j]).sum()) < need:
        return False
    return aligned(a, b, max(1, total - 2 * need)) >= need


def _sequences(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, node, check, n, words), stored: texts are cut into words once. ``words`` are 32-bit hashes, ``tie`` is the
    hash of the text; ``node`` and ``check`` stand for the sequence; NULL node: no words."""
    each = docs.select("doc_id", F.xxhash64("text").alias("tie"), words(F.col("text")).alias("w"))
    h = F.transform("w", lambda x: F.hash(x))
    named = each.select("doc_id", "tie", F.size("w").alias("n"), h.alias("words"))
    node = F.when(F.col("n") > 0, F.xxhash64("words", F.lit(1)))
    found = named.select("doc_id", "tie", node.alias("node"), F.xxhash64("words", F.lit(2)).alias("check"), "n", "words")
    return written(found, "sequences")


def _buckets(sequences: DataFrame, sketches: int, per_sketch: int) -> DataFrame:
    """(node, bucket) of every sequence long enough, once per node and task at least."""

    def sketched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            once = frame.drop_duplicates("node")
            found = [order_sketch(shingle_values(np.asarray(w)), sketches, per_sketch) for w in once["words"]]
            yield pd.DataFrame({"node": np.repeat(once["node"].to_numpy(), [len(x) for x in found]), "bucket": np.concatenate(found)})

    long = sequences.where(F.col("n") >= LONG + SHINGLE - 1).select("node", "words")
    return written(map_frames(long, sketched, "node long, bucket long"), "sketches")


def _labelled(frame: pd.DataFrame) -> list[np.ndarray]:
    """The labelled shingles of each node of a frame (node, words), once."""
    return [labelled_values(shingle_values(np.asarray(w))) for w in frame.drop_duplicates("node")["words"]]


def _counts(rows: DataFrame, values_of: Callable[[pd.DataFrame], list[np.ndarray]] = _labelled) -> np.ndarray:
    """How many values fall in each slot: a few megabytes, whatever the input."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SLOTS, np.int64)
        for frame in frames:
            values, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *values_of(frame)]) % np.uint64(SLOTS), return_counts=True)
            total[values.astype(np.int64)] += n
        some = [k for k in range(SLOTS // CHUNK) if total[k * CHUNK : (k + 1) * CHUNK].any()]
        yield pd.DataFrame({"chunk": some, "counts": [total[k * CHUNK : (k + 1) * CHUNK].tobytes() for k in some]})

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in frame["counts"])
        return pd.DataFrame({"chunk": frame["chunk"].iloc[:1], "counts": [total.tobytes()]})

    schema = "chunk long, counts binary"
    parts = map_frames(rows, counted, schema).groupBy("chunk").applyInPandas(added, schema)
    out = np.zeros(SLOTS, np.int64)
    for r in parts.collect():
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], np.int64)
    return out


def _short(sequences: DataFrame) -> DataFrame:
    return sequences.where(F.col("n").between(SHINGLE, EXACT + SHINGLE - 1)).select("node", "words")


def _prefixes(sequences: DataFrame) -> DataFrame:
    """(node, size, bucket, place): the prefix of every sequence (node, words), once per node and task at least."""
    shared = sequences.sparkSession.sparkContext.broadcast(_counts(sequences))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            once = frame.drop_duplicates("node")
            found = [prefix(shingle_values(np.asarray(w)), shared.value).view(np.int64) for w in once["words"]]
            lengths = [len(x) for x in found]
            yield pd.DataFrame({
                "node": np.repeat(once["node"].to_numpy(), lengths),
                "size": np.repeat(np.array([len(w) - SHINGLE + 1 for w in once["words"]], np.int64), lengths),
                "bucket": np.concatenate([np.zeros(0, np.int64), *found]),
                "place": np.concatenate([np.zeros(0, np.int64), *map(np.arange, lengths)]),
            })

    return written(map_frames(sequences, cut, "node long, size long, bucket long, place long"), "prefixes")


def _shared(buckets: DataFrame) -> DataFrame:
    """The rows (bucket, node, ...) where at least two nodes share the bucket."""
    ends = buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    return written(buckets.join(ends.select("bucket"), "bucket").distinct(), "buckets")


def _star_pairs(shared: DataFrame) -> DataFrame:
    """(a, b), a < b: each node with a few nodes of its bucket."""
    orders = [F.min_by("node", F.xxhash64("node", F.lit(k))).alias(f"c{k}") for k in range(CENTRES)]
    centres = shared.groupBy("bucket").agg(*orders)
    each = shared.join(centres, "bucket").select("node", F.explode(F.array_distinct(F.array(*[f"c{k}" for k in range(CENTRES)]))).alias("c"))
    return each.where("node <> c").select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()


def _verified(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """The pairs that are similar. A pair's sequences meet in one row; long groups of pairs of one node are split by the join."""
    left = contents.select(F.col("node").alias("a"), F.col("words").alias("left"))
    right = contents.select(F.col("node").alias("b"), F.col("words").alias("right"))

    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            good = [
                similar(shingle_values(np.asarray(x)), shingle_values(np.asarray(y))) for x, y in zip(frame["left"], frame["right"])
            ]
            yield frame.loc[good, ["a", "b"]]

    return map_frames(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right"), kept, "a long, b long")


def _few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more tasks than ``rows`` rows need: small tables in many parts cost a file and a task for each part."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.coalesce(parts) if parts < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def _stars(edges: DataFrame) -> tuple[bool, int]:
    """Whether every node is the centre of its links or has one link, to a centre, and the number of edges."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up")))
    per = ends.groupBy("x").agg(F.sum("up").alias("ups"), F.count(F.lit(1)).alias("n"))
    bad, rows = per.agg(F.count_if(F.expr("ups > 0 AND n > 1")), F.sum("ups")).first()
    return not bad, rows or 0


def _contracted(edges: DataFrame, rows: int, folder: str) -> DataFrame:
    """(u, v), u > v: every node with the smallest one it is connected with. Rounds are stored below ``folder``."""
    spark = edges.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        _few(df.where("u <> v").distinct(), rows).write.parquet(f"{folder}/{name}")
        return spark.read.schema("u long, v long").parquet(f"{folder}/{name}")

    edges, k = stored(edges, "edges"), 0
    while True:
        done, rows = _stars(edges)
        if done:
            return edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _few(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), rows)
        large = _few(both.where("v > u").join(low, "u"), rows).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large, f"large-{k}")
        low = _few(large.groupBy("u").agg(F.min("v").alias("m")), rows)
        small = _few(large.join(low, "u"), rows).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, k = stored(small.unionByName(low.select("u", F.col("m").alias("v"))), f"small-{k}"), k + 1


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component): the smallest node each is connected with, for every node of ``links`` (a, b) and of ``known``, the components
    by other links: only links across those are contracted."""
    spark, rows = links.sparkSession, links.count()
    ends = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if known is not None:
        if not rows:
            return known
        for end in ("u", "v"):
            named = known.select(F.col("node").alias(end), "component")
            ends = ends.join(named, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    with scratch_folder(spark, "contraction") as folder:
        edges = _contracted(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), rows, folder)
        roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
        found = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        if known is not None:
            moved = edges.select(F.col("u").alias("component"), F.col("v").alias("to"))
            named = known.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            found, rows = named.unionByName(found), rows + known.count()
        return written(_few(found.distinct(), rows), "components")


def _open(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows (bucket, node, ...) of the buckets that hold several components, with the component, how many members there are, the
    bucket's largest component (``main``), and whether the row lies outside of it."""
    named = shared.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = named.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
    ends = sizes.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("k").alias("members"), F.max_by("component", F.struct("k", "component")).alias("main")
    )
    return named.join(ends.where("parts > 1"), "bucket").withColumn("outside", F.col("component") != F.col("main")).drop("parts")


def _across(rows: DataFrame) -> DataFrame:
    """(a, b), a < b: pairs of one bucket in different components. Rows with a place in a prefix meet only where the prefixes that a
    pair of their sizes must share reach so far."""
    columns = [c for c in ("component", "outside", "size", "place") if c in rows.columns]
    left = rows.where("outside").select("bucket", F.col("node").alias("x"), *[F.col(c).alias(f"{c}_x") for c in columns])
    right = rows.select("bucket", F.col("node").alias("y"), *[F.col(c).alias(f"{c}_y") for c in columns])
    able = (F.col("component_x") != F.col("component_y")) & (~F.col("outside_y") | (F.col("x") < F.col("y")))
    if "place" in columns:
        need = F.ceil((F.col("size_x") + F.col("size_y")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9)
        able &= (F.col("place_x") + need <= F.col("size_x")) & (F.col("place_y") + need <= F.col("size_y"))
    met = left.withColumnRenamed("bucket", "at").join(right, (F.col("at") == F.col("bucket")) & able)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def allowed(total: int) -> int:
    """How many labelled shingles two similar sequences of ``total`` shingles together may have that the other lacks."""
    return total - 2 * int(np.ceil(SIMILARITY * total / (1 + SIMILARITY) - 1e-9))


def _differences(members: DataFrame, contents: DataFrame) -> DataFrame:
    """(main, head, node, size, head_size, values, linked) of (main, head, node): in which labelled shingles a node and the head of its family
    differ, the sizes of both, and whether they are similar."""
    left = contents.select(F.col("node").alias("head"), F.col("words").alias("left"))

    def differing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pairs = [(shingle_values(np.asarray(x)), shingle_values(np.asarray(y))) for x, y in zip(frame["left"], frame["words"])]
            yield pd.DataFrame({
                "main": frame["main"], "head": frame["head"], "node": frame["node"],
                "size": [len(y) for _, y in pairs], "head_size": [len(x) for x, _ in pairs],
                "values": [np.setxor1d(labelled_values(x), labelled_values(y)).view(np.int64) for x, y in pairs],
                "linked": [similar(x, y) for x, y in pairs],
            })

    met = members.join(left, "head").join(contents.select("node", "words"), "node").select("main", "head", "node", "left", "words")
    schema = "main long, head long, node long, size long, head_size long, values array<long>, linked boolean"
    return written(map_frames(met, differing, schema), "differences")


def index_reach(distance: int, size: int, head_size: int, far: bool) -> int:
    """The last place at which the prefix of a difference may have to hold an element of a far partner's.

    A pair must share o = (x + y - allowed(a + b)) / 2 elements, so one stands at a place of at most y - o in this one. The partner is
    far, x > allowed(a + p), and allowed(a + b) exceeds allowed(a + p) by at most ``extra``; of two far ones the partner has x >= y,
    and sizes a factor 0.8 apart allow b / 4 at most. The fractions are those of 0.8."""
    more = size - head_size
    extra = more - 2 * (4 * more // 9) if more >= 0 else more + 2 * -(4 * more // 9)
    reach = (distance - 1 + extra) // 2
    return min(reach, size // 8) if far else reach


def _difference_prefixes(found: DataFrame) -> DataFrame:
    """(main, node, size, distance, far, bucket, place, indexed, probing) of differences. A node is far when its difference alone tells that
    it is not similar to the head."""
    of = lambda frame: [np.asarray(v, np.int64).view(np.uint64) for v in frame["values"]]
    shared = found.sparkSession.sparkContext.broadcast(_counts(found, of))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = of(frame)
            kinds = []
            for v, size, head_size in zip(values, frame["size"], frame["head_size"]):
                far = len(v) > allowed(size + head_size)
                kinds.append((size, len(v), far, index_reach(len(v), size, head_size, far), size // 4 if far else -1))
            lengths = [min(distance, max(reach, probe) + 1) for _, distance, _, reach, probe in kinds]
            orders = [np.lexsort((v, shared.value[v % np.uint64(SLOTS)]))[:n] for v, n in zip(values, lengths)]
            size, distance, far, reach, probe = (np.repeat(np.array(x), lengths) for x in zip(*kinds))
            place = np.concatenate([np.arange(n) for n in lengths])
            yield pd.DataFrame({
                "main": np.repeat(frame["main"].to_numpy(), lengths), "node": np.repeat(frame["node"].to_numpy(), lengths),
                "size": size, "distance": distance, "far": far, "place": place, "indexed": place <= reach, "probing": place <= probe,
                "bucket": np.concatenate([v[o] for v, o in zip(values, orders)]).view(np.int64),
            })

    schema = "main long, node long, size long, distance long, far boolean, place long, indexed boolean, probing boolean, bucket long"
    return written(map_frames(found, cut, schema), "difference-prefixes")


def _across_far(prefixes: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b), a < b: pairs of one family in different components, one of them far from the head, whose differences can share enough."""
    named = prefixes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    columns = ("node", "component", "size", "distance", "far", "place")
    left = named.where("probing").select("main", "bucket", *[F.col(c).alias(f"{c}_x") for c in columns])
    right = named.where("indexed").select(F.col("main").alias("family"), F.col("bucket").alias("at"), *[F.col(c).alias(f"{c}_y") for c in columns])
    total = F.col("size_x") + F.col("size_y")
    need = F.ceil(total * (SIMILARITY / (1 + SIMILARITY)) - 1e-9)
    share = (F.col("distance_x") + F.col("distance_y") - total + 2 * need) / 2
    first = F.struct("distance_y", "node_y") < F.struct("distance_x", "node_x")
    able = (F.col("component_x") != F.col("component_y")) & (~F.col("far_y") | first)
    able &= (F.col("place_x") + share <= F.col("distance_x")) & (F.col("place_y") + share <= F.col("distance_y"))
    met = left.join(right, (F.col("main") == F.col("family")) & (F.col("bucket") == F.col("at")) & able)
    return met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def _by_centres(rows: DataFrame, groups: DataFrame, tried: DataFrame, found: DataFrame, contents: DataFrame) -> DataFrame:
    """The components by ``groups`` and the links across components of the open prefix buckets ``rows``. ``found`` are the links so far."""
    few = _across(rows.where(F.col("members") <= SMALL)).join(tried, ["a", "b"], "left_anti")
    more = _verified(few, contents)
    rows = rows.where(F.col("members") > SMALL)
    if rows.isEmpty():
        return components(written(more, "links"), groups)
    degrees = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count()
    heads = degrees.join(groups, "node").groupBy("component").agg(F.max_by("node", F.struct("count", "node")).alias("head"))
    mains = rows.select("main").distinct().join(heads.withColumnRenamed("component", "main"), "main", "left")
    # a component without links is one node, and named by it
    families = mains.select("main", F.coalesce("head", "main").alias("head"))
    members = written(rows.select("main", "node").distinct().join(families, "main"), "families")
    apart = _differences(members, contents)
    linked = apart.where("linked AND head <> node").select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b"))
    groups = components(written(more.unionByName(linked).distinct(), "links"), groups)
    prefixes = _difference_prefixes(apart)
    total = F.col("size") + F.col("head_size")
    near = F.size("values") <= total - 2 * F.ceil(total * (SIMILARITY / (1 + SIMILARITY)) - 1e-9)
    near_ones = written(apart.where(near).select("main", "node", F.col("linked").alias("settled")), "near-heads")
    across = _across_far(prefixes, groups)
    if not near_ones.where("NOT settled").isEmpty():
        now = rows.drop("component", "outside").join(near_ones, ["main", "node"]).join(groups, "node", "left")
        across = across.unionByName(_across(now.withColumn("component", F.coalesce("component", "node")).withColumn("outside", ~F.col("settled"))))
    more = _verified(across.distinct().join(tried, ["a", "b"], "left_anti"), contents)
    return components(written(more, "links"), groups)


def connected(sequences: DataFrame) -> DataFrame:
    """(node, component) of every node that is similar to another."""
    close, shared = _shared(_prefixes(_short(sequences))), _shared(_buckets(sequences, SKETCHES, PER_SKETCH))
    every = shared.unionByName(close.select(shared.columns))
    pairs = written(_star_pairs(every), "pairs")
    used = written(every.select("node").distinct(), "nodes")
    some = sequences.join(broadcast_if_small(used, BROADCAST_ROWS), "node", "left_semi")
    needed = written(some.dropDuplicates(["node"]).select("node", "n", "words"), "contents")
    found = written(_verified(pairs, needed), "links")
    groups = components(found)
    rest = written(_open(shared, groups), "open")
    across = _across(rest.where(F.col("members") <= SMALL))
    large = written(rest.where(F.col("members") > SMALL).select("node").distinct(), "large")
    if not large.isEmpty():
        # members of large buckets meet again by their prefixes, among themselves: another order, so buckets of other names
        near = _shared(_prefixes(needed.join(large, "node", "left_semi").select("node", "words")))
        close = close.unionByName(near.withColumn("bucket", F.xxhash64("bucket", F.lit(1))))
        across = across.unionByName(_star_pairs(near))
    again = written(across.join(pairs, ["a", "b"], "left_anti").distinct(), "pairs")
    more = written(_verified(again, needed), "links")
    groups = components(more, groups)
    apart = written(_open(close, groups), "open")
    return _by_centres(apart, groups, pairs.unionByName(again), found.unionByName(more), needed)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, tie, key): the smallest id of the row's group; ``tie`` is the hash of its text, ``key`` names the group
    (NULL for a row without words, which is its own)."""
    rows = texts(docs, id_col, text_col)
    sequences = _sequences(rows)
    groups = connected(sequences)
    named = sequences.select("doc_id", "tie", "node", "check")
    # two sequences that meet in ``node`` by chance are told apart by ``check``: only the first is in the graph
    one = named.where("node IS NOT NULL").groupBy("node", "check").agg(F.min("doc_id").alias("first"))
    real = one.groupBy("node").agg(F.min("check").alias("real"))
    placed = one.join(real, "node").join(groups, "node", "left")
    group = F.when(F.col("check") == F.col("real"), F.coalesce("component", "node"))
    placed = placed.select("node", "check", "first", F.struct(group.alias("g"), F.when(group.isNull(), F.col("check")).alias("c")).alias("key"))
    least = placed.groupBy("key").agg(F.min("first").alias("class_id"))
    by_node = written(placed.join(least, "key").select("node", "check", "class_id", "key"), "classes")
    return named.join(by_node, ["node", "check"], "left").select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "tie", "key"
    )


def deduped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id, NULL last, then of the smallest text hash. All rows without words
    stay, and all columns."""
    found = classes(docs, id_col, text_col)
    rows = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("row"), col(id_col).alias("id"),
        F.xxhash64(F.coalesce(col(text_col), F.lit(""))).alias("t"),
    )
    best = F.min_by(F.struct("doc_id", "tie"), F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("best")
    keep = found.where("key IS NOT NULL").groupBy("key").agg(best).select("best.*")
    bare = found.where("key IS NULL").select("doc_id", "tie").distinct()
    same = lambda other: rows["id"].eqNullSafe(other["doc_id"]) & (rows["t"] == other["tie"])
    one = rows.join(keep, same(keep), "left_semi").dropDuplicates(["id", "t"])
    return one.unionByName(rows.join(bare, same(bare), "left_semi")).select("row.*")
