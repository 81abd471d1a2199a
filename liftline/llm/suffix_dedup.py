"""Removal of long repeated byte strings, found by a bounded breadth-first search on Burrows-Wheeler transforms.

Every 400-byte window of a document belongs to an anchor: the place of the smallest hash among the 32-byte strings in it, the leftmost
of equals. Equal windows have equal anchors at equal distances, so windows can be compared anchor by anchor. The windows of one place
form a context, a stretch of 400 to 768 bytes. Only hashes of contexts are shuffled at first; those whose anchor occurs once
are done, and equal contexts become one with a count. The bytes of all others, plain copies included, are fetched and dealt into shards
of about ``SHARD_BYTES``, whole anchors each.

Windows at nearby distances from the anchor share a core of bytes. Where a core occurs once with its anchor, no window around it can be
repeated; what is left of a context are the stretches whose cores occur again, and these are indexed.

In a shard the suffixes are sorted by their first 512 bytes and the Burrows-Wheeler transform is taken. Intervals are expanded
breadth first, from the empty string on: the string w with an interval is extended backward by each byte c in it, and the end of the
interval of cw, if nothing is known of it yet, is a place where neighbouring suffixes share exactly as many bytes as w has. Common prefixes
come in increasing order; the search stops at the minimum length, and what is still open are the suffixes that share 400 bytes or
more. A class of windows is repeated when its contexts count two or more.

An anchor with more than ``ANCHOR_CONTEXTS`` different contexts (a passage in very many documents) is split first: its windows
by their distance from the anchor, in ranges of ``RANGES`` bytes, and by the bytes that all windows of a range share. Where a range is still too
large, it is split into narrower ones; at a width of one a part holds equal windows only. So no group outgrows a task and no window is left out.

Defined results: a NULL or empty text has no bytes; texts shorter than the minimum length stay whole; repeated rows are copies of each other; ids may be
NULL; other columns are ignored; no rows give no rows. Kept bytes are returned as bytes: a cut may fall inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from liftline.llm.common import map_batches, map_frames, texts, written
from liftline.llm.tokens import mixed, powers, ranges

LENGTH, ANCHOR = 400, 32
#: Bytes of text handled at once, below 2 ** 20; and of contexts indexed at once.
BLOCK, SHARD_BYTES = 1_000_000, 2_000_000
ANCHOR_CONTEXTS = 2_000
RANGES = (64, 8, 1)
#: A byte that UTF-8 never has.
END = 0xFF
_BASES = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
_POWERS = [(powers(b, BLOCK + 1), powers(np.uint64(pow(int(b), -1, 1 << 64)), BLOCK + 1)) for b in _BASES]
_VALUES = [mixed(np.arange(1, 257) + 1000 * k) for k in range(3)]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def window_contexts(data: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(start, bytes, anchor offset, anchor hash, two context hashes) of the contexts of a block of concatenated texts."""
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    h, span = _VALUES[0][data], 1
    while span < ANCHOR:
        h = h[:-span] * (_BASES[0] + np.uint64(2 * span)) + h[span:]
        span *= 2
    h = mixed(h)
    place = np.uint64((1 << 20) - 1)
    least = sliding_min((h & ~place) | np.arange(len(h), dtype=np.uint64), length - ANCHOR + 1)
    anchor = (least & place).astype(np.int64)
    whole = owner[: n - length + 1] == owner[length - 1 :]
    edge = np.ones(len(anchor), bool)
    edge[1:] = (anchor[1:] != anchor[:-1]) | (owner[1 : len(anchor)] != owner[: len(anchor) - 1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(anchor)) - 1
    first, last = first[whole[first]], last[whole[first]]
    size, offset = last - first + length, anchor[first] - first
    hashes = []
    for values, (power, inverse) in zip(_VALUES[1:], _POWERS):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data] * power[:n], out=sums[1:])
        told = (sums[first + size] - sums[first]) * inverse[first]
        hashes.append(mixed(told ^ mixed(size << 32 | offset)).view(np.int64))
    return first, size, offset, h[anchor[first]].view(np.int64), *hashes


def find_contexts(rows: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """(doc_id, tie, anchor, c1, c2, size, offset, starts) of rows (doc_id, tie, text); equal contexts of a text are one row."""
    id_type = rows.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", id_type), *(T.StructField(c, T.LongType()) for c in ("tie", "anchor", "c1", "c2"))]
        + [T.StructField("size", T.IntegerType()), T.StructField("offset", T.IntegerType())]
        + [T.StructField("starts", T.ArrayType(T.LongType()))]
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(2).cast(pa.large_binary())
            sizes = np.diff(np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8))
            raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            base = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)[:-1]
            # pieces of texts: long ones overlap, so that each window is in one piece
            pieces = [
                (i, a, min(block, int(sizes[i]) - a))
                for i in np.flatnonzero(sizes >= length).tolist()
                for a in range(0, int(sizes[i]) - length + 1, block - length + 1)
            ]
            k = 0
            while k < len(pieces):
                j, held = k, 0
                while j < len(pieces) and (j == k or held + pieces[j][2] <= block):
                    held += pieces[j][2]
                    j += 1
                some = pieces[k:j]
                k = j
                data = np.concatenate([raw[base[i] + a : base[i] + a + m] for i, a, m in some])
                begins = np.cumsum([0] + [m for _, _, m in some])[:-1]
                owner = np.repeat(np.arange(len(some)), [m for _, _, m in some])
                first, size, offset, anchor, c1, c2 = window_contexts(data, owner, length)
                if not len(first):
                    continue
                piece = owner[first]
                doc = np.array([i for i, _, _ in some])[piece]
                start = first - begins[piece] + np.array([a for _, a, _ in some])[piece]
                order = np.lexsort((start, c2, c1, doc))
                doc, c1, c2 = doc[order], c1[order], c2[order]
                new = np.ones(len(order), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])
                at = np.flatnonzero(new)
                starts = pa.ListArray.from_arrays(pa.array(np.append(at, len(order)), pa.int32()), pa.array(start[order], pa.int64()))
                ones = pa.array(doc[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(ones), batch.column(1).take(ones), pa.array(anchor[order][at]), pa.array(c1[at]),
                        pa.array(c2[at]), pa.array(size[order][at], pa.int32()), pa.array(offset[order][at], pa.int32()), starts,
                    ],
                    names=schema.names,
                )

    return map_batches(rows.select("doc_id", "tie", "text"), found, schema)


def burrows_wheeler(data: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array by the first ``order`` bytes or more, transform) of a cyclic string."""
    n = len(data)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key |= np.roll(data, -k).astype(np.uint64) << np.uint64(56 - 8 * k)
    known = 8
    while True:
        array = np.argsort(key)
        ranked = key[array]
        rank = np.empty(n, np.uint64)
        rank[array] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]])).astype(np.uint64)
        largest = int(rank[array[-1]])
        if known >= order or largest == n - 1:
            return array, data[array - 1]
        # as many ranks as a key holds: two of large shards, three or more of small ones
        bits = max(largest.bit_length(), 1)
        key = rank
        for k in range(1, 64 // bits):
            key = key << np.uint64(bits) | np.roll(rank, -known * k)
        known *= 64 // bits


def common_prefixes(transform: np.ndarray, length: int) -> np.ndarray:
    """For each suffix the bytes it shares with the one before, where fewer than ``length``; -1 where that many or more."""
    n = len(transform)
    by_byte = np.argsort(transform, kind="stable")
    last_first = np.empty(n, np.int64)
    last_first[by_byte] = np.arange(n)
    shared = np.full(n + 1, -1, np.int32)
    shared[0] = shared[n] = 0
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for value in range(length):
        width = high - low
        single = width == 1
        begins, ends = [last_first[low[single]]], [last_first[low[single]] + 1]
        low, width = low[~single], width[~single]
        if len(low):
            at = ranges(low, width)
            told = np.repeat(np.arange(len(low)), width) << 8 | transform[at]
            # bytes of an interval: runs of one byte first, then equal bytes together
            run = np.ones(len(told), bool)
            run[1:] = told[1:] != told[:-1]
            heads = np.flatnonzero(run)
            lengths = np.diff(np.append(heads, len(told)))
            sort = np.argsort(told[heads])
            key, first, lengths = told[heads][sort], at[heads][sort], lengths[sort]
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            begin = last_first[np.minimum.reduceat(first, new)]
            begins.append(begin)
            ends.append(begin + np.add.reduceat(lengths, new))
        low, high = np.concatenate(begins), np.concatenate(ends)
        fresh = shared[high] == -1
        if value == 0:
            fresh |= high == n
        low, high = low[fresh], high[fresh]
        shared[high] = np.where(high == n, shared[high], value)
        # the interval at the very end has no boundary of its own but is extended once, at the start
        if not len(low):
            break
    return shared[:n]


def range_width(length: int) -> int:
    """The widest range of distances whose windows share enough bytes."""
    return next(w for w in RANGES if w <= max(length // 4, 1))


def open_stretches(
    data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, groups: np.ndarray, counts: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first byte, bytes) of the stretches that hold every window whose core occurs twice or more with its anchor.

    Windows at a distance of ``part * width`` to ``part * width + width - 1`` bytes before the anchor share their core. Cores are compared
    by hashes: equal ones stay equal, so no repeated window is left out."""
    width = range_width(length)
    near, far = (offsets - sizes + length) // width, offsets // width
    number = far - near + 1
    owner = np.repeat(np.arange(len(sizes)), number)
    part = ranges(near, number)
    at = offsets[owner] - part * width
    core, span = length - width + 1, 1
    h = _VALUES[0][data]
    while span * 2 <= core:
        h = h[:-span] * (_BASES[0] + np.uint64(2 * span)) + h[span:]
        span *= 2
    place = begins[owner] + at
    key = mixed(h[place] ^ mixed(h[place + core - span] ^ mixed(groups[owner].view(np.uint64) + part.astype(np.uint64))))
    _, same = np.unique(key, return_inverse=True)
    held = np.flatnonzero(np.bincount(same, weights=counts[owner])[same] >= 2)
    if not len(held):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    # the larger the part, the earlier its windows; those of neighbouring parts are one stretch
    owner, part = owner[held], part[held]
    low, high = np.maximum(at[held] - width + 1, 0), np.minimum(at[held], sizes[owner] - length)
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (part[1:] != part[:-1] + 1)]))
    last = np.append(new[1:], len(held)) - 1
    return owner[new], low[last], high[new] - low[last] + length


def repeated_windows(contexts: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """Per context the starts of its windows that occur at least twice, counting each context ``counts`` times."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(bytes([END]).join(contexts) + bytes([END]), np.uint8)
    begins = np.cumsum(sizes + 1) - sizes - 1
    array, transform = burrows_wheeler(data, length)
    shared = common_prefixes(transform, length)
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)
    place = np.arange(len(data)) - begins[owner]
    starts = place <= sizes[owner] - length
    group = np.cumsum(shared >= 0)
    weight = np.where(starts, counts[owner], 0)[array]
    often = np.bincount(group, weights=weight)[group] >= 2
    hit = np.zeros(len(data), bool)
    hit[array] = often
    hit &= starts
    at = np.flatnonzero(hit)
    return np.split(place[at], np.searchsorted(owner[at], np.arange(1, len(contexts))))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of ranges; those that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]])) if len(starts) else np.zeros(0, np.int64)
    return starts[new], reach[np.append(new[1:], len(starts)) - 1] if len(new) else new


SPANS = "array<struct<a:int,b:int>>"


def _indexed(contexts: DataFrame, length: int) -> DataFrame:
    """(c1, c2, spans) of contexts (group, c1, c2, count, offset, bytes): the repeated stretches of each, by the search above."""

    def shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def flush() -> pd.DataFrame:
            some = pd.concat(held, ignore_index=True)
            contexts, counts = some["bytes"].tolist(), some["count"].to_numpy()
            sizes = some["bytes"].map(len).to_numpy(np.int64)
            data = np.frombuffer(b"".join(contexts), np.uint8)
            owner, low, n = open_stretches(
                data, np.cumsum(sizes) - sizes, sizes, some["offset"].to_numpy(np.int64), some["group"].to_numpy(), counts, length
            )
            if not len(owner):
                return pd.DataFrame({"c1": [], "c2": [], "spans": []})
            stretches = [contexts[i][a : a + m] for i, a, m in zip(owner.tolist(), low.tolist(), n.tolist())]
            windows = repeated_windows(stretches, counts[owner], length)
            spans: dict[int, list[dict[str, int]]] = {}
            for i, start, found in zip(owner.tolist(), low.tolist(), windows):
                if len(found):
                    a, b = merged(found + start, found + start + length)
                    spans.setdefault(i, []).extend({"a": x, "b": y} for x, y in zip(a.tolist(), b.tolist()))
            at = list(spans)
            return pd.DataFrame({"c1": some["c1"].to_numpy()[at], "c2": some["c2"].to_numpy()[at], "spans": list(spans.values())})

        last = None
        for frame in frames:
            groups = frame["group"].to_numpy()
            told = np.append(0, np.cumsum(frame["bytes"].map(len).to_numpy(np.int64)))
            begin = 0
            # shards end between groups only
            for at in np.flatnonzero(np.append(groups[:1] != last, groups[1:] != groups[:-1])).tolist():
                if size + told[at] - told[begin] >= SHARD_BYTES:
                    held.append(frame.iloc[begin:at])
                    yield flush()
                    held, size, begin = [], 0, at
            held.append(frame.iloc[begin:])
            size += int(told[-1] - told[begin])
            last = groups[-1]
        if held:
            yield flush()

    dealt = contexts.select("group", "c1", "c2", "count", "offset", "bytes").repartition("group").sortWithinPartitions("group", "c1", "c2")
    return map_frames(dealt, shards, f"c1 long, c2 long, spans {SPANS}")


def _settled(contexts: DataFrame, length: int, limit: int, level: int = 0) -> DataFrame:
    """(c1, c2, spans) of contexts (group, c1, c2, count, offset, bytes) that hold repeated windows."""
    widths = [w for w in RANGES if w <= length // 4]
    if level == len(widths):
        return _indexed(contexts, length)
    large = written(contexts.groupBy("group").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > limit).select("group"), "large")
    found = _indexed(contexts.join(large, "group", "left_anti"), length)
    if large.isEmpty():
        return found
    many = contexts.join(large, "group")
    # windows by their distance from the anchor, in ranges, and by the bytes that all windows of a range share
    width = widths[level]
    far, near = F.floor(F.col("offset") / width), F.floor((F.col("offset") - F.length("bytes") + length) / width)
    parts = many.withColumn("part", F.explode(F.sequence(near, far)))
    low = F.greatest(F.lit(0), F.col("offset") - F.col("part") * width - (width - 1)).cast("int")
    high = F.least(F.length("bytes") - length, F.col("offset") - F.col("part") * width).cast("int")
    parts = parts.withColumns({"low": low, "high": high})
    core = F.expr(f"substring(bytes, cast(offset - part * {width} + 1 as int), {length - (width - 1)})")
    cut = F.expr(f"substring(bytes, low + 1, high - low + {length})")
    parts = parts.select(
        "c1", "c2", "count", "low", F.xxhash64("group", "part", core).alias("subgroup"), cut.alias("cut"),
        (F.col("offset") - F.col("low")).alias("cut_offset"),
    ).withColumns({"k1": F.xxhash64("subgroup", "cut"), "k2": F.xxhash64("subgroup", "cut", F.lit(1))})
    parts = written(parts, "windows")
    smaller = parts.groupBy(F.col("subgroup").alias("group"), F.col("k1").alias("c1"), F.col("k2").alias("c2")).agg(
        F.sum("count").alias("count"), F.first("cut_offset").alias("offset"), F.first("cut").alias("bytes")
    )
    below = written(_settled(written(smaller, "contexts"), length, limit, level + 1), "spans")
    below = below.select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), "spans")
    back = parts.select("c1", "c2", "low", "k1", "k2").join(below, ["k1", "k2"]).select(
        "c1", "c2", F.transform("spans", lambda x: F.struct((x["a"] + F.col("low")).alias("a"), (x["b"] + F.col("low")).alias("b"))).alias("spans")
    )
    return found.unionByName(back.groupBy("c1", "c2").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def repeated_spans(rows: DataFrame, length: int = LENGTH, limit: int = ANCHOR_CONTEXTS) -> DataFrame:
    """(doc_id, tie, spans) of the rows (doc_id, tie, text) that have bytes to remove; spans may overlap."""
    all_contexts = written(find_contexts(rows, length), "contexts")
    # stored, so that each join below is of two plain shuffles, whose hot keys Spark can split
    often = written(all_contexts.groupBy("anchor").agg(F.sum(F.size("starts")).alias("n")).where("n > 1").select("anchor"), "often")
    open_ones = written(all_contexts.join(often, "anchor"), "open")
    one = open_ones.groupBy("anchor", "c1", "c2", "size", "offset").agg(
        F.sum(F.size("starts")).alias("count"), F.min(F.struct("doc_id", "tie", F.col("starts")[0].alias("start"))).alias("at")
    )
    wanted = one.select(
        F.col("at.doc_id").alias("d"), F.col("at.tie").alias("t"), F.col("at.start").alias("start"),
        F.col("anchor").alias("group"), "c1", "c2", "size", "offset", "count",
    )
    # the bytes of one context of each kind, cut from its document
    fields = ["start", "group", "c1", "c2", "size", "offset", "count"]
    per_doc = wanted.groupBy("d", "t").agg(F.collect_list(F.struct(*fields)).alias("cuts"))
    fetched = rows.join(per_doc, rows["doc_id"].eqNullSafe(per_doc["d"]) & (rows["tie"] == per_doc["t"])).select(
        F.encode("text", "utf-8").alias("raw"), F.explode("cuts").alias("c")
    ).select(*[F.col(f"c.{f}") for f in fields], F.expr("substring(raw, cast(c.start as int) + 1, c.size)").alias("bytes"))
    contexts = written(fetched.dropDuplicates(["c1", "c2"]), "fetched")
    found = written(_settled(contexts, length, limit), "spans")
    placed = open_ones.join(found, ["c1", "c2"]).select("doc_id", "tie", F.explode("starts").alias("start"), "spans")
    shifted = F.transform("spans", lambda x: F.struct((x["a"] + F.col("start")).alias("a"), (x["b"] + F.col("start")).alias("b")))
    return placed.groupBy("doc_id", "tie").agg(F.flatten(F.collect_list(shifted)).alias("spans"))


def dedupe(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", limit: int = ANCHOR_CONTEXTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of every row: the maximal removed runs and the bytes left."""
    rows = texts(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    spans = repeated_spans(rows, length, limit).select(F.col("doc_id").alias("d"), F.col("tie").alias("t"), "spans")
    both = rows.join(spans, rows["doc_id"].eqNullSafe(spans["d"]) & (rows["tie"] == spans["t"]), "left")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text, spans in zip(frame["doc_id"], frame["text"], frame["spans"]):
                raw = text.encode("utf-8")
                if spans is None or not len(spans):
                    out.append((doc_id, len(raw), 0, [], raw))
                    continue
                a, b = merged(np.array([s["a"] for s in spans], np.int64), np.array([s["b"] for s in spans], np.int64))
                kept = b"".join(raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)]))
                runs = [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())]
                out.append((doc_id, len(raw), int((b - a).sum()), runs, kept))
            if out:
                done = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
                yield done.assign(doc_id=pd.Series([r[0] for r in out], dtype=object))

    schema = "doc_id string, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    done = map_frames(both.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "spans"), cut, schema)
    return done.withColumn("doc_id", F.col("doc_id").cast(id_type))
