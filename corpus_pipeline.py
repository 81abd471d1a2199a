"""A corpus, stage by stage: toxic documents go, repeated lines go, one document of each group of near copies stays, documents
that hold test items go, and what is left is packed into windows of tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``documents``. Between stages a
frame is stored in the shared scratch folder, so each stage reads what the one before has kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from liftline.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from liftline.llm.common import table, written
from liftline.llm.queries import TOKENIZER

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; the lexicon is learnt from all labelled rows of ``docs`` up to its bound."""
    sample = toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", F.lit(True), toxicity.PER_LABEL)
    return toxicity.scored(docs, toxicity.learn(sample)).where("score < 0.5").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that one of a smaller id has; ``n_chars`` follows the text."""
    kept = line_dedup.dedupe_lines(docs)
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars"))
    text = F.when(F.col("row.text").isNotNull(), F.col("text"))
    return kept.select(
        "row.doc_id", text.alias("text"), "row.lang", "row.source", n_chars.alias("n_chars")
    )


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduped(docs).select(*COLUMNS)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_near_copies),
    ("decontamination", without_test_items),
    ("packing", packed),
]

#: A learnt lexicon and an order of packing have no SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
