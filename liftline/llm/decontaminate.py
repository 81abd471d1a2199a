"""Short test items inside long documents: MinHash containment search by size classes, verified exactly.

A document of n distinct five-word shingles belongs to the size class of the next power of two u >= n. Its
one-permutation MinHash sketch cuts the hash range into 2u bins and keeps the smallest shingle hash of each, so the sketch
grows with the document and a shingle shared with an item survives with about the same chance (0.79 or more) in every
class. An item is sketched once per class, with the bins of that class. Sketches meet in an equi-join on the hash; a pair
with enough equal minima is a candidate: at least a quarter of the item's shingles, and one. At a containment of
0.8 an item of 8 shingles is missed about once in 10,000 times and one of 16 once in a million. Items of
fewer than 8 shingles skip the sketch on both sides: all their shingles are joined.

Candidates are verified by the exact share of the item's shingles, as texts, in the document. All of it is column
expressions. Only (document, item) pairs that share a hash are shuffled; an item table over ``BROADCAST_ROWS`` rows is joined by shuffle.

Defined results: one row per document and item whose containment is 0.8 or more. Items of fewer than five words, NULL
or empty ones have no shingles and are never found, and neither is anything in such documents. NULL ids are kept as ids; rows with
the same id and text count once; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from liftline.llm.common import broadcast_if_small, col, texts, written
from liftline.llm.words import shingle_hashes, shingles, word_hashes, words

THRESHOLD = 0.8
#: Items below this many shingles are searched by all of them.
TINY = 8
CANDIDATE_SHARE = 0.25
#: Size classes are powers of two up to 2 ** LARGEST; longer documents share the last one, with its bins.
LARGEST = 30
#: Rows of 24 bytes of the item table that may be broadcast, and of the candidates' ids.
BROADCAST_ROWS = 500_000


def _item_rows(items: DataFrame, item_id: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """(names: item_id and key; contents: key, shingle texts and hashes), one content per different word sequence."""
    named = items.select(
        col(item_id).alias("item_id"), words(F.coalesce(col(item_text), F.lit(""))).alias("w"),
    ).withColumn("key", F.md5(F.concat_ws(" ", "w")))
    found = written(
        named.where(F.size("w") >= 5).groupBy("key").agg(F.first("w").alias("w"), F.collect_set("item_id").alias("item_ids"),
                                                       F.max(F.col("item_id").isNull()).alias("unnamed")),
        "items",
    )
    names = found.select("key", F.explode(F.when(F.col("unnamed"), F.concat("item_ids", F.array(F.lit(None)))).otherwise(
        F.col("item_ids"))).alias("item_id"))
    contents = found.select("key", shingles("w").alias("item_shingles"), F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    return names, contents.select("key", "item_shingles", F.sort_array(F.array_distinct(shingle_hashes("h"))).alias("s"))


def _item_sketches(contents: DataFrame) -> DataFrame:
    """(hash, key, size, from_class): the hash is a minimum of the item in all size classes from ``from_class`` on, where it
    and the next smaller hash lie in different bins: where the highest bit in which they differ counts."""
    each = contents.select("key", F.size("s").alias("size"), F.posexplode("s").alias("i", "hash"), "s")
    differ = F.col("hash").bitwiseXOR(F.get("s", F.col("i") - 1))
    first = F.when(F.col("i") == 0, F.lit(0)).otherwise(64 - F.length(F.bin(differ)))
    return each.select("hash", "key", "size", first.alias("from_class"))


def _document_sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, hash, size_class, is_min) of every distinct shingle of every document."""
    hashed = docs.select("doc_id", F.xxhash64("text").alias("tie"), word_hashes(F.col("text")).alias("h"))
    sets = hashed.select("doc_id", "tie", F.sort_array(F.array_distinct(shingle_hashes("h"))).alias("s"))
    sized = sets.select("doc_id", "tie", "s", F.least(F.ceil(F.log2(F.size("s"))), F.lit(LARGEST)).cast("int").alias("size_class"))
    pairs = F.arrays_zip("s", F.concat(F.array(F.lit(None).cast("long")), F.col("s")).alias("before"))
    rows = sized.select("doc_id", "tie", "size_class", F.inline(pairs)).toDF(
        "doc_id", "tie", "size_class", "hash", "before"
    )
    bits = 63 - F.col("size_class")
    is_min = F.col("before").isNull() | (
        F.call_function("shiftright", "hash", bits) != F.call_function("shiftright", "before", bits)
    )
    return rows.where(F.col("hash").isNotNull()).select("doc_id", "tie", "hash", "size_class", is_min.alias("is_min"))


def candidates(docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """(doc_id, tie, key) of pairs whose sketches share enough minima."""
    met = _document_sketches(docs).join(sketches, "hash").where(
        (F.col("size") < TINY) | (F.col("is_min") & (F.col("size_class") >= F.col("from_class")))
    )
    hits = met.groupBy("doc_id", "tie", "key", "size").agg(F.count(F.lit(1)).alias("hits"))
    enough = F.greatest(F.lit(1), F.floor(F.col("size") * CANDIDATE_SHARE))
    return hits.where(F.col("hits") >= enough).select("doc_id", "tie", "key")


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, tie, item_id, n_shingles, n_shared, containment); ``tie`` is the hash of the document's text."""
    rows = texts(docs, id_col, text_col)
    names, contents = _item_rows(items, item_id, item_text)
    sketches = written(_item_sketches(contents), "item-sketches")
    found = written(candidates(rows, broadcast_if_small(sketches, BROADCAST_ROWS)), "candidates")
    tied = rows.withColumn("tie", F.xxhash64("text"))
    pair = broadcast_if_small(found.select(F.col("doc_id").alias("d"), F.col("tie").alias("t"), "key"), BROADCAST_ROWS)
    texts_of = tied.join(pair, tied["doc_id"].eqNullSafe(pair["d"]) & (tied["tie"] == pair["t"]))
    both = texts_of.dropDuplicates(["doc_id", "tie", "key"]).join(contents.select("key", "item_shingles"), "key")
    parts = both.select("doc_id", "tie", "key", "item_shingles", words(F.col("text")).alias("w"))
    shared = parts.select(
        "doc_id", "tie", "key", F.size("item_shingles").cast("long").alias("n_shingles"),
        F.size(F.array_intersect(shingles("w"), "item_shingles")).cast("long").alias("n_shared"),
    ).withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    # stored before it is filtered: a filter moved below would split a text again for each of its words
    return written(shared, "pairs").where(F.col("containment") >= threshold).join(names, "key").select(
        "doc_id", "tie", "item_id", "n_shingles", "n_shared", "containment"
    )


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones; all columns stay."""
    bad = contaminated(docs, items, id_col=id_col, text_col=text_col).select(
        F.col("doc_id").alias("d"), F.col("tie").alias("t")
    ).distinct()
    rows = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("row"), col(id_col).alias("id"),
        F.xxhash64(F.coalesce(col(text_col), F.lit(""))).alias("tie"),
    )
    bad = broadcast_if_small(written(bad, "contaminated"), BROADCAST_ROWS)
    return rows.join(bad, rows["id"].eqNullSafe(bad["d"]) & (rows["tie"] == bad["t"]), "left_anti").select("row.*")
