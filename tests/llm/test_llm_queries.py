"""Registered queries against their SQL or a brute-force version, nearest neighbours, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter

import compare
import corpus_pipeline
import numpy as np
import pytest
from llm_rows import plain_classes, plain_kept_lines, plain_shingles
from pyspark.sql import functions as F

from liftline.llm import queries as q, toxicity, vector_search
from liftline.llm.common import table, written

SF = "/root/testdata/sf0.001"
PYTHON = ["PythonUDF", "EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    frame = q.queries()[name](spark, SF)
    wanted = compare.duck(SF).sql(q.oracle_sql()[name])
    assert compare.difference(frame.toPandas(), wanted.df()) is None
    assert compare.type_difference(dict(frame.dtypes), dict(zip(wanted.columns, map(str, wanted.types)))) is None


@pytest.mark.parametrize("name", ["op4_decontamination", "op10_secret_scan"])
def test_native_plans_run_no_python(spark, name):
    plan = q.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert [x for x in PYTHON if x in plan] == []


@pytest.mark.parametrize("name,columns", [
    ("op2_suffix_dedup", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    ("op3_token_output", ["doc_id", "start", "n_tokens", "ids_crc32"]),
    ("op5_toxicity", ["doc_id", "held_out", "score", "predicted"]),
    ("op6_quality", ["doc_id", "held_out", "score", "predicted"]),
    ("op8_near_dedup", ["doc_id", "class_id"]),
    ("op10_secret_scan", ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]),
])
def test_query_returns_a_row_per_document(spark, name, columns):
    frame = q.queries()[name](spark, SF)
    assert frame.columns == columns
    ids = [r["doc_id"] for r in frame.collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in table(spark, SF, "documents").collect())


@pytest.mark.parametrize("name,label,least", [("op5_toxicity", "toxic", 0.9), ("op6_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    scored = q.queries()[name](spark, "/root/testdata/sf0.1").join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id")
    got = scored.where("held_out").agg(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
    assert got[0] >= least and got[1] > 300


# --- nearest neighbours ---


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "-", "-", 0) for i, v in rows], "vec_id long, embedding array<float>, id string, v string, slab int")


def plain_nearest(rows, queries, k=10):
    usable = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        usable[i] = min(usable.get(i, v), v)
    out = {}
    for i in queries & usable.keys():
        near = sorted((float(np.sqrt(((np.array(v, float) - np.array(usable[i], float)) ** 2).sum())), j)
                      for j, v in usable.items() if j != i and len(v) == len(usable[i]))
        out[i] = near[:k]
    return out


def test_nearest_of_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    exact = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, exact(rng.standard_normal(16))) for i in range(600)]
    rows += [(1_000 + i, rows[7][1]) for i in range(300)]  # one vector in a third of the rows
    rows += [(0, exact(rng.standard_normal(16))), (None, rows[1][1]), (700, None), (800, [0.0] * 16), (900, [float("nan")] * 16)]
    rows += [(901, [None] * 16), (902, [float("inf")] * 16), (2_000, [1.0, 2.0]), (2_100, [1.0, 3.0]), (2_200, [])]
    found = vector_search.search(vectors(spark, rows), F.col("vec_id") % 100 == 0, slab=128).collect()
    got: dict = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = plain_nearest(rows, set(range(0, 3_000, 100)))
    want = {i: v for i, v in want.items() if v}
    assert got.keys() == want.keys()
    hits = sum(len(set(got[i]) & set(want[i])) for i in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert got[2_000] == want[2_000]
    assert vector_search.search(vectors(spark, []), F.lit(True)).count() == 0


def test_recall_on_the_given_vectors(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in table(spark, SF, "embeddings").collect()]
    got: dict = {}
    for r in q.op1_vector_search(spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = plain_nearest(rows, {i for i, _ in rows if i % 100 == 0})
    assert sum(len(got[i] & {j for _, j in v}) for i, v in want.items()) >= 0.9 * sum(map(len, want.values()))


# --- the pipeline ---


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], SF), f"test-{name}"))
    assert [f.columns for f in frames[:-1]] == [list(corpus_pipeline.COLUMNS)] * 5
    rows = [[(r["doc_id"], r["text"]) for r in f.collect()] for f in frames[:-1]]

    sample = toxicity.labelled_sample(docs, table(spark, SF, "labels"), "toxic", F.lit(True), toxicity.PER_LABEL)
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, toxicity.learn(sample)).collect()}
    assert Counter(rows[1]) == Counter((i, t) for i, t in rows[0] if score[i] < 0.5)

    assert Counter(rows[2]) == Counter({(i, t): n for (i, _, _, t), n in plain_kept_lines(rows[1]).items()})
    assert all(r["n_chars"] == len(r["text"]) for r in frames[2].collect())

    classes = plain_classes(rows[2])
    wordless = {i for i, t in rows[2] if not t.strip()}
    assert {i for i, _ in rows[3]} == set(classes.values()) | wordless and set(rows[3]) <= set(rows[2])

    items = [plain_shingles(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    leaks = lambda t: any(x and len(x & plain_shingles(t)) >= 0.8 * len(x) for x in items)
    assert Counter(rows[4]) == Counter((i, t) for i, t in rows[3] if not leaks(t))

    pieces = frames[5].collect()
    tokens = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert tokens.keys() == {i for i, _ in rows[4]}
    assert sum(r["length"] for r in pieces) == sum(tokens.values())
