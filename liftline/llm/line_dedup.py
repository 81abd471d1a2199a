"""Reversible line deduplication: sharded cuckoo filters backed by exact reference counts.

A stored index holds three tables. ``postings``: every line that counts, as (document, line number, key). ``counts``:
per key the number of its lines and the smallest and the largest document, the exact reference counts.
``filters``: per shard of the key space a cuckoo filter of the keys that at least two documents hold. Adding and
deleting documents changes the counts of the keys concerned and inserts or deletes those keys in the filters, so a
deletion takes back everything an insertion did.

Lines are looked up in the filters first; only hits, true or by chance, are joined with the exact counts. The filters
of a shard are repeated for ``SALTS`` parts of its lines, so a line that a third of all documents hold is
looked up by several tasks; counting combines lines before the shuffle and the join with the counts has one row per key on one side.

Defined results: ids are whole numbers; a NULL id is one document that comes after all others; rows with the same id are one
document in the counts, each with its own lines; a NULL or empty text is one empty line, too short to count; all
columns are kept; no rows give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from liftline.llm.common import col, map_frames, ship_package
from liftline.llm.tokens import mixed
from liftline.session import scratch_path

#: What is stripped at both ends of a line, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 10
NO_ID = (1 << 63) - 1
SALTS = 16
#: Keys a shard's filter is laid out for.
SHARD_KEYS = 1 << 16
SLOTS = 4


class CuckooFilter:
    """A set of 64-bit hashes that may answer yes by chance (about once in 8,000) and supports deletion."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        buckets = 1 << max(3, int(np.ceil(np.log2(max(1, len(hashes)) / (0.8 * SLOTS)))))
        while not (out := cls(buckets)).insert(hashes):
            buckets *= 2
        return out

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(table), table)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mixed(hashes.view(np.uint64) if hashes.dtype == np.int64 else hashes)
        mark = (h >> np.uint64(48)).astype(np.uint16)
        return np.where(mark == 0, np.uint16(1), mark), (h & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mixed(mark) & np.uint64(self.buckets - 1)).astype(np.int64)

    def insert(self, hashes: np.ndarray, rounds: int = 300) -> bool:
        """Whether all found room; if not, the filter is to be built anew with more buckets."""
        mark, bucket = self._places(hashes)
        tries = np.zeros(len(mark), np.int64)
        for k in range(rounds):
            if not len(mark):
                return True
            order = np.argsort(bucket, kind="stable")
            mark, bucket, tries = mark[order], bucket[order], tries[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            free = (self.table[bucket] == 0).sum(axis=1)
            fits = rank < free
            slots = np.argsort(self.table[bucket[fits]] != 0, axis=1, kind="stable")
            self.table[bucket[fits], slots[np.arange(len(slots)), rank[fits]]] = mark[fits]
            mark, bucket, tries, rank = mark[~fits], bucket[~fits], tries[~fits] + 1, rank[~fits]
            kicks = np.flatnonzero((tries >= 2) & (np.diff(bucket, prepend=-1) != 0))
            slot = (mark[kicks].astype(np.int64) + k) % SLOTS
            victims = self.table[bucket[kicks], slot].copy()
            self.table[bucket[kicks], slot] = mark[kicks]
            mark[kicks] = victims
            bucket = self._other(mark, bucket)
        return not len(mark)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        mark, bucket = self._places(hashes)
        here = (self.table[bucket] == mark[:, None]).any(axis=1)
        return here | (self.table[self._other(mark, bucket)] == mark[:, None]).any(axis=1)

    def delete(self, hashes: np.ndarray) -> None:
        """Only hashes that were inserted may be deleted."""
        marks, buckets = self._places(hashes)
        for mark, bucket, other in zip(marks, buckets, self._other(marks, buckets)):
            for b in (bucket, other):
                at = np.flatnonzero(self.table[b] == mark)
                if len(at):
                    self.table[b, at[0]] = 0
                    break


def whole_id(id_col: str) -> Column:
    return F.coalesce(col(id_col).cast("long"), F.lit(NO_ID))


def line_postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tie, line, key, hash) of every line long enough to count."""
    text = F.coalesce(col(text_col), F.lit(""))
    keys = F.transform(F.split(F.translate(text, UPPER, LOWER), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))
    lines = docs.select(whole_id(id_col).alias("doc"), F.xxhash64(text).alias("tie"), F.posexplode(keys).alias("line", "k"))
    counted = lines.where(F.char_length("k") >= MIN_CHARS)
    return counted.select("doc", "tie", "line", F.unhex(F.md5("k")).alias("key")).withColumn("hash", F.xxhash64("key"))


def reference_counts(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key", "hash").agg(
        F.count(F.lit(1)).alias("lines"), F.min("doc").alias("first"), F.max("doc").alias("last")
    )


def repeated(counts: DataFrame) -> DataFrame:
    return counts.where("first <> last")


class LineIndex:
    """The stored index at ``path``. Each change writes a version of its own beside the present one, which stays as it is."""

    def __init__(self, spark: SparkSession, path: str, version: str = "first", shards: int = 1):
        self.spark, self.path, self.version, self.shards = spark, path.rstrip("/"), version, shards

    def _at(self, name: str) -> str:
        return f"{self.path}/{self.version}/{name}"

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._at(name))

    @property
    def postings(self) -> DataFrame:
        return self._read("postings")

    @property
    def counts(self) -> DataFrame:
        return self._read("counts")

    @property
    def filters(self) -> DataFrame:
        return self._read("filters")

    def _shard(self) -> Column:
        return F.pmod(F.shiftright("hash", 20), F.lit(self.shards)).cast("int")

    @classmethod
    def build(
        cls, docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", shard_keys: int = SHARD_KEYS
    ) -> LineIndex:
        spark = docs.sparkSession
        index = cls(spark, path or scratch_path(spark, "line-index"))
        line_postings(docs, id_col, text_col).write.parquet(index._at("postings"))
        reference_counts(index.postings).write.parquet(index._at("counts"))
        index.shards = max(1, -(-repeated(index.counts).count() // shard_keys))
        keys = repeated(index.counts).select(index._shard().alias("shard"), "hash")

        def built(frame: pd.DataFrame) -> pd.DataFrame:
            hashes = frame["hash"].to_numpy()
            return pd.DataFrame({"shard": [frame["shard"].iloc[0]], "filter": [CuckooFilter.of(hashes).to_bytes()]})

        ship_package(spark)
        keys.groupBy("shard").applyInPandas(built, "shard int, filter binary").write.parquet(index._at("filters"))
        return index

    def _changed(self, postings: DataFrame, counts: DataFrame) -> LineIndex:
        """Another version, with the filters changed by what became or ceased to be repeated."""
        following = LineIndex(self.spark, self.path, uuid.uuid4().hex, self.shards)
        postings.write.parquet(following._at("postings"))
        counts.write.parquet(following._at("counts"))
        before, after = repeated(self.counts).select("key", "hash"), repeated(following.counts).select("key", "hash")
        more = after.join(before, "key", "left_anti").withColumn("add", F.lit(True))
        less = before.join(after, "key", "left_anti").withColumn("add", F.lit(False))
        changes = more.union(less).select(self._shard().alias("shard"), "hash", "add")

        def merged(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
            shard = int((old if len(old) else new)["shard"].iloc[0])
            add = new.loc[new["add"].astype(bool), "hash"].to_numpy(np.int64)
            gone = new.loc[~new["add"].astype(bool), "hash"].to_numpy(np.int64)
            if len(old):
                kept = CuckooFilter.from_bytes(old["filter"].iloc[0])
                kept.delete(gone)
                if kept.insert(add):
                    return pd.DataFrame({"shard": [shard], "filter": [kept.to_bytes()]})
            else:
                return pd.DataFrame({"shard": [shard], "filter": [CuckooFilter.of(add).to_bytes()]})
            return pd.DataFrame({"shard": [shard], "filter": [b""]})  # full: built anew below

        ship_package(self.spark)
        filters = (
            self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(merged, "shard int, filter binary")
        )
        kept = following._at("filters-kept")
        filters.write.parquet(kept)
        kept = self.spark.read.schema("shard int, filter binary").parquet(kept)
        full = kept.where(F.length("filter") == 0).select("shard")
        keys = after.select(self._shard().alias("shard"), "hash").join(full, "shard", "left_semi")

        def built(frame: pd.DataFrame) -> pd.DataFrame:
            hashes = frame["hash"].to_numpy()
            return pd.DataFrame({"shard": [frame["shard"].iloc[0]], "filter": [CuckooFilter.of(hashes).to_bytes()]})

        anew = keys.groupBy("shard").applyInPandas(built, "shard int, filter binary")
        kept.where(F.length("filter") > 0).union(anew).write.parquet(following._at("filters"))
        return following

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """With more documents. Those must not be in the index yet."""
        batch = line_postings(docs, id_col, text_col)
        both = self.counts.unionByName(reference_counts(batch))
        counts = both.groupBy("key", "hash").agg(
            F.sum("lines").alias("lines"), F.min("first").alias("first"), F.max("last").alias("last")
        )
        return self._changed(self.postings.unionByName(batch), counts)

    def delete(self, ids: DataFrame) -> LineIndex:
        """Without the documents whose ids the first column of ``ids`` holds (NULL: those without an id)."""
        gone = ids.select(whole_id(ids.columns[0]).alias("doc")).distinct()
        left = self.postings.join(gone, "doc", "left_anti")
        touched = self.postings.join(gone, "doc", "left_semi").select("key").distinct()
        same = self.counts.join(touched, "key", "left_anti")
        fewer = reference_counts(left.join(touched, "key", "left_semi"))
        return self._changed(left, same.unionByName(fewer))

    def repeats(self) -> DataFrame:
        """(doc, tie, line) of every indexed line that a document with a smaller id holds too."""
        parts = self.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc", "line"), F.lit(SALTS)).cast("int")
        lines = self.postings.withColumns({"shard": self._shard(), "salt": salt})
        both = parts.unionByName(lines, allowMissingColumns=True)
        ordered = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("filter").isNull())

        def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shard, at = None, None
            for frame in frames:
                new = frame["filter"].notna().to_numpy()
                shards = frame["shard"].to_numpy()
                edges = np.flatnonzero(new | (np.diff(shards, prepend=-1 if shard is None else shard) != 0))
                for a, b in zip([0, *edges], [*edges, len(frame)]):
                    if a == b:
                        continue
                    piece = frame.iloc[a:b]
                    if new[a]:
                        shard, at = shards[a], CuckooFilter.from_bytes(piece["filter"].iloc[0])
                        piece = piece.iloc[1:]
                    elif shards[a] != shard:
                        continue  # a shard without repeated keys has no filter
                    if len(piece):
                        found = piece[at.contains(piece["hash"].to_numpy().astype(np.int64))]
                        yield found[["doc", "tie", "line", "key"]]

        wide = ordered.select("shard", "filter", "doc", "tie", "line", "key", "hash")
        # whole numbers of 64 bits must not turn into doubles where a row of filters has none
        wide = wide.na.fill(0, ["doc", "tie", "line", "hash"])
        maybe = map_frames(wide, hits, "doc long, tie long, line int, key binary")
        exact = repeated(self.counts).select("key", "first")
        return maybe.join(exact, "key").where("doc <> first").select("doc", "tie", "line")

    def dedupe(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``docs`` (all indexed) without their repeated lines: (row, text, n_lines, n_dropped), ``row`` as it came in."""
        text = F.coalesce(col(text_col), F.lit(""))
        rows = docs.select(
            F.struct(*[col(c) for c in docs.columns]).alias("row"), whole_id(id_col).alias("doc"), F.xxhash64(text).alias("tie")
        )
        text = F.coalesce(F.col("row").getField(text_col), F.lit(""))  # a text is shuffled once
        # a repeated row has each of its lines found once per copy
        drops = self.repeats().groupBy("doc", "tie").agg(F.collect_set("line").alias("gone"))
        both = rows.join(drops, ["doc", "tie"], "left").withColumn("lines", F.split(text, "\n"))
        gone = F.coalesce("gone", F.array().cast("array<int>"))
        left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
        kept = F.when(F.size(gone) == 0, text).otherwise(
            F.concat_ws("\n", F.transform(left, lambda i: F.get("lines", i)))
        )
        return both.select(
            "row", kept.alias("text"), F.size("lines").cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped")
        )


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """An index of all of ``docs`` and, from it, (row, text, n_lines, n_dropped) of each."""
    return LineIndex.build(docs, path, id_col, text_col).dedupe(docs, id_col, text_col)
