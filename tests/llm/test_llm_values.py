"""Rows of registered queries, value by value, against plain versions; and each pipeline stage on awkward rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from llm_rows import CLASHING, TEXTS, plain_classes, plain_kept_lines, plain_shingles, plain_suffix
from tokenizers import Tokenizer

from liftline.llm import queries as q
from liftline.llm.common import table

SF = "/root/testdata/sf0.001"


def given(spark) -> list[tuple[int, str]]:
    return sorted((r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect())


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# --- queries ---


def test_removed_bytes_of_the_given_documents(spark):
    got = Counter(tuple(r) for r in q.op2_suffix_dedup(spark, SF).collect())
    want = Counter()
    for (i, n, gone, runs, kept), copies in plain_suffix(given(spark), 400).items():
        want[(i, n, gone, runs, sha(kept))] += copies
    assert got == want


def test_token_files_of_the_given_documents(spark):
    library, start, want = Tokenizer.from_file(str(q.TOKENIZER)), 0, {}
    for i, text in given(spark):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = q.op3_token_output(spark, SF).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want


def test_near_copies_of_the_given_documents(spark):
    got = {r["doc_id"]: r["class_id"] for r in q.op8_near_dedup(spark, SF).collect()}
    assert got == plain_classes(given(spark))


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)


def plain_secrets(text: str) -> list[tuple[int, int, str, int]]:
    """(start, place of the kind, kind, end) in order."""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_secrets_of_the_given_documents(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = {r["doc_id"]: r for r in q.op10_secret_scan(spark, path).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, path, "documents").collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        base = plain_secrets(text)
        told = [f"{kind}:{a}:{b}" for a, _, kind, b in base]
        counts = Counter(kind for _, _, kind, _ in base)
        assert (rows[i]["n_assign"], rows[i]["n_access"], rows[i]["n_hex"]) == (counts["assign"], counts["access"], counts["hex"])
        assert rows[i]["base_sha256"] == sha(",".join(told).encode())
        assert [s for s in rows[i]["spans"].split(",") if s and not s.startswith("markov:")] == told


# --- stages of the pipeline on rows with NULLs, empty and very long texts, repeated rows and clashing extra columns ---

STAGE = dict(corpus_pipeline.STAGES)


def corpus(spark, rows=TEXTS):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    filled = [(i, t, None, "hot", None if t is None else len(t), *("-" for _ in CLASHING)) for i, t in rows]
    return spark.createDataFrame(filled, schema)


def pairs(frame) -> Counter:
    return Counter((r["doc_id"], r["text"]) for r in frame.collect())


@pytest.mark.parametrize("name", list(STAGE))
def test_stages_of_no_rows(spark, name):
    frame = STAGE[name](spark, corpus(spark, []), SF)
    assert frame.count() == 0
    assert name == "packing" or frame.columns == list(corpus_pipeline.COLUMNS)


def test_toxicity_stage_of_awkward_rows(spark):
    kept = STAGE["toxicity"](spark, corpus(spark), SF)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert pairs(kept) == Counter(TEXTS)  # nothing in them is toxic


def test_line_stage_of_awkward_rows(spark):
    kept = STAGE["line_dedup"](spark, corpus(spark), SF)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    want = Counter()
    for (i, _, _, text), n in plain_kept_lines(TEXTS).items():
        want[(i, text)] += n
    rows = kept.collect()
    assert Counter((r["doc_id"], r["text"] or "") for r in rows) == want
    assert sum(r["text"] is None for r in rows) == sum(t is None for _, t in TEXTS)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)


def test_near_copy_stage_of_awkward_rows(spark):
    kept = STAGE["near_dedup"](spark, corpus(spark), SF)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert pairs(kept) <= Counter(TEXTS)
    rows = [(k, t) for k, (_, t) in enumerate(TEXTS)]
    stay = {r["doc_id"] for r in STAGE["near_dedup"](spark, corpus(spark, rows), SF).collect()}
    assert stay == set(plain_classes(rows).values())


def test_decontamination_stage_of_awkward_rows(spark):
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    longest = max(items, key=lambda t: len(plain_shingles(t)))
    rows = [*TEXTS, (20, f"Before it. {longest} After it."), (20, longest), (None, longest)]
    kept = STAGE["decontamination"](spark, corpus(spark, rows), SF)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    tests = [x for x in map(plain_shingles, items) if x]
    assert pairs(kept) == Counter((i, t) for i, t in rows if not any(len(x & plain_shingles(t)) >= 0.8 * len(x) for x in tests))


def test_packing_stage_of_awkward_rows(spark):
    library = Tokenizer.from_file(str(q.TOKENIZER))
    pieces = STAGE["packing"](spark, corpus(spark), SF).collect()
    want = Counter()
    for i, t in TEXTS:
        want[i] += len(library.encode(t or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in pieces:
        got[r["doc_id"]] += r["length"]
    assert got == want
    filled: dict = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 1024
