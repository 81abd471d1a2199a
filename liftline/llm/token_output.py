"""Token ids in compact files: each shard is compressed by its own Re-Pair grammar and can be read at any place.

Writing: documents are range-partitioned and sorted by id; each task cuts the ids of its documents into shards
of about ``shard_ids`` ids. In each round a shard replaces its most frequent pairs of neighbouring symbols by new ones
(nonterminals); pairs replaced in one round share no symbol in opposite roles, so none overlap. Rounds end when one
would save under ``least_gain`` of the shard. A row of the stored table is a shard: its rules, the
expanded length of each rule, the compressed sequence and where its documents begin. Spark commits the files, so a lost
task leaves nothing half-written, and column pruning reads the index without the ids.

Reading: a shard is expanded by itself. ``Shard.slice`` decodes any range of ids from the expansion
lengths without expanding the rest.

Defined results: a NULL or empty text is the end id alone. Documents are ordered by id, NULL first, then by the
hash and by the text itself, so repeated rows each keep their place. Other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from liftline.llm import tokens
from liftline.llm.common import map_frames, texts
from liftline.llm.tokens import ranges

SHARD = (
    "part int, shard int, before long, n_tokens long, doc_ids array<string>, doc_starts binary, first_symbol long, "
    "rules binary, lengths binary, symbols binary"
)


#: Chosen pairs are looked up by a hash of that many bits.
SLOT_BITS = 18


def re_pair(
    ids: np.ndarray, first_symbol: int, per_round: int = 4096, least_count: int = 8, least_gain: float = 0.01
) -> tuple[np.ndarray, np.ndarray]:
    """(rules as pairs of symbols, compressed sequence). Symbol ``first_symbol + i`` stands for rule i."""
    seq, rules, n_rules = ids.astype(np.uint32), [], 0
    while len(seq) > 1:
        # two symbols in one number, of 32 bits while they fit: half the bytes to sort
        kind, half, odd = (np.uint32, 16, 0x9E3779B1) if first_symbol + n_rules <= 1 << 16 else (np.uint64, 32, 0x9E3779B97F4A7C15)
        pairs = seq[:-1].astype(kind) << kind(half) | seq[1:]
        keys, counts = np.unique(pairs, return_counts=True)
        keys, counts = keys[counts >= least_count], counts[counts >= least_count]
        order = np.argsort(-counts, kind="stable")[:per_round]
        firsts, seconds = keys[order] >> kind(half), keys[order] & kind((1 << half) - 1)
        left, right, chosen = set(), set(), []
        for k, (a, b) in enumerate(zip(firsts.tolist(), seconds.tolist())):
            if a != b and a not in right and b not in left:
                left.add(a)
                right.add(b)
                chosen.append(k)
        if not chosen:
            chosen = np.flatnonzero(firsts == seconds)[:1].tolist()  # runs of one symbol, pairs from the left
        if not chosen:
            break
        ranked = np.argsort(order[chosen])  # keys ascend
        table = keys[order[chosen]][ranked]
        numbers = np.arange(len(table), dtype=np.int32)
        place = table * kind(odd) >> kind(2 * half - SLOT_BITS)
        slot = np.full(1 << SLOT_BITS, -1, np.int32)
        slot[place] = numbers
        slot[place[slot[place] != numbers]] = len(table)  # several pairs: searched for in the table
        found = slot[pairs * kind(odd) >> kind(2 * half - SLOT_BITS)]
        at = np.flatnonzero(found >= 0)
        found, pairs = found[at], pairs[at]
        several = np.flatnonzero(found == len(table))
        found[several] = np.minimum(np.searchsorted(table, pairs[several]), len(table) - 1)
        hit = np.flatnonzero(table[found] == pairs)
        at, found = at[hit], found[hit]
        if firsts[chosen[0]] == seconds[chosen[0]]:
            run = np.cumsum(np.diff(at, prepend=at[:1] - 2) != 1) - 1
            even = (at - at[np.searchsorted(run, run)]) % 2 == 0
            at, found = at[even], found[even]
        if len(at) < least_gain * len(seq):
            break
        seq[at] = first_symbol + n_rules + ranked[found]
        stays = np.ones(len(seq), bool)
        stays[at + 1] = False
        seq = seq[np.flatnonzero(stays)]
        rules.append(np.stack([firsts[chosen], seconds[chosen]], axis=1).astype(np.int64))
        n_rules += len(chosen)
    return (np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)), seq.astype(np.int64)


def levels(rules: np.ndarray, first_symbol: int) -> Iterator[slice]:
    """Slices of the rules, in order: no rule of a slice is made of another of the same slice."""
    last, start = rules.max(axis=1, initial=0) - first_symbol, 0
    while start < len(rules):
        later = np.flatnonzero(last[start:] >= start)
        end = start + int(later[0]) if len(later) else len(rules)
        if end == start:
            raise ValueError(f"rule {start} is made of a later one")
        yield slice(start, end)
        start = end


def rule_lengths(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    out = np.ones(len(rules) + 1, np.int64)  # the last one stands for every id
    for part in levels(rules, first_symbol):
        out[part] = out[np.where(rules[part] < first_symbol, -1, rules[part] - first_symbol)].sum(axis=1)
    return out[:-1]


def packed_bytes(x: np.ndarray) -> bytes:
    """The width of a value in bytes, then the values in little-endian order."""
    width = next(w for w in range(1, 9) if w == 8 or not len(x) or int(x.max()) < 1 << 8 * w)
    return bytes([width]) + np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel().astype(np.int64)


class Shard:
    """A stored shard, decoded as a whole or at any place."""

    def __init__(self, row) -> None:
        self.first = int(row.first_symbol)
        self.rules = unpacked(row.rules).reshape(-1, 2)
        self.lengths = unpacked(row.lengths)
        self.symbols = unpacked(row.symbols)

    def _sizes(self, symbols: np.ndarray) -> np.ndarray:
        sizes = np.ones(len(symbols), np.int64)
        rule = symbols >= self.first
        sizes[rule] = self.lengths[symbols[rule] - self.first]
        return sizes

    def ids(self) -> np.ndarray:
        """All ids: rules expanded once each, in order, then gathered. The pool holds each id by itself, then the expansions."""
        ends = self.first + np.cumsum(self.lengths)
        pool = np.arange(int(ends[-1]) if len(ends) else self.first, dtype=np.uint32)
        starts = np.concatenate([np.arange(self.first), ends - self.lengths])
        sizes = np.concatenate([np.ones(self.first, np.int64), self.lengths])
        for part in levels(self.rules, self.first):
            symbols = self.rules[part].ravel()
            pool[starts[self.first + part.start] : ends[part.stop - 1]] = pool[ranges(starts[symbols], sizes[symbols])]
        return pool[ranges(starts[self.symbols], sizes[self.symbols])]

    def slice(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on; only symbols that reach into the range are expanded."""
        ends = np.cumsum(self._sizes(self.symbols))
        k = int(np.searchsorted(ends, start, side="right"))
        out: list[int] = []
        at = int(ends[k - 1]) if k else 0
        stack: list[int] = []
        stop = start + n
        while at < stop and (stack or k < len(self.symbols)):
            if not stack:
                stack.append(int(self.symbols[k]))
                k += 1
            symbol = stack.pop()
            size = 1 if symbol < self.first else int(self.lengths[symbol - self.first])
            if at + size <= start:
                at += size
            elif symbol < self.first:
                out.append(symbol)
                at += 1
            else:
                a, b = self.rules[symbol - self.first].tolist()
                stack += [b, a]
        return np.array(out, np.uint32)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard_ids: int = 1 << 19, id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Store the ids of all documents at ``path``, in ascending order of their ids."""
    rows = texts(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, before, n = TaskContext.get().partitionId(), 0, 0
        first_symbol = tokens.encoder(tokenizer).library.get_vocab_size()
        doc_ids, arrays, held = [], [], 0

        def shard() -> pd.DataFrame:
            nonlocal before, n
            ids = np.concatenate(arrays)
            sizes = np.array([len(x) for x in arrays], np.int64)
            rules, symbols = re_pair(ids, first_symbol)
            row = (
                part, n, before, len(ids), list(doc_ids), packed_bytes(np.cumsum(sizes) - sizes), first_symbol,
                packed_bytes(rules.ravel()), packed_bytes(rule_lengths(rules, first_symbol)), packed_bytes(symbols),
            )
            before, n = before + len(ids), n + 1
            return pd.DataFrame([row], columns=[x.split()[0] for x in SHARD.split(", ")])

        for some_ids, some in tokens.batches(frames, tokenizer, end_id):
            for doc_id, ids in zip(some_ids, some):
                doc_ids.append(doc_id)
                arrays.append(ids)
                held += len(ids)
                if held >= shard_ids:
                    yield shard()
                    doc_ids, arrays, held = [], [], 0
        if arrays:
            yield shard()

    stored = map_frames(ordered.selectExpr("CAST(doc_id AS STRING) AS doc_id", "text"), shards, SHARD)
    stored.write.option("compression", "uncompressed").parquet(path)


def stored_shards(spark: SparkSession, path: str) -> DataFrame:
    """The stored shards with ``start``: the ids of all shards before each. Only totals of write tasks are summed in order,
    one row per task, and joined back by broadcast: their number is bounded by the tasks of the write."""
    shards = spark.read.schema(SHARD).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    above = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("all").over(above), F.lit(0)).alias("part_start"))
    return shards.join(F.broadcast(starts), "part").withColumn("start", F.col("part_start") + F.col("before"))


def read_documents(spark: SparkSession, path: str, id_type: str = "bigint", with_ids: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` and,
    if asked for, ``ids`` as little-endian unsigned 32-bit integers."""
    schema = "doc_id string, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                ids = Shard(row).ids().astype("<u4")
                starts = unpacked(row.doc_starts)
                ends = np.append(starts[1:], len(ids))
                parts = [ids[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
                out = {
                    "doc_id": pd.Series(list(row.doc_ids), dtype=object),
                    "start": starts + row.start,
                    "n_tokens": ends - starts,
                    "ids_crc32": [zlib.crc32(x) for x in parts],
                }
                yield pd.DataFrame(out | ({"ids": parts} if with_ids else {}))

    done = map_frames(stored_shards(spark, path).drop("part_start"), documents, schema)
    return done.withColumn("doc_id", F.col("doc_id").cast(id_type))
