"""Line, suffix and near-duplicate operators against plain versions."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pytest
from llm_rows import TEXTS, documents, empty, plain_aligned, plain_classes, plain_kept_lines, plain_suffix, random_texts

from liftline.llm import line_dedup, near_dedup, suffix_dedup
from liftline.llm.line_dedup import CuckooFilter, LineIndex

# --- lines ---


def kept_lines(frame) -> Counter:
    return Counter((r["id"], r["n_lines"], r["n_dropped"], r["text"]) for r in frame.selectExpr(
        "row.doc_id AS id", "n_lines", "n_dropped", "text").collect())


def test_lines_of_awkward_rows(spark):
    assert kept_lines(line_dedup.dedupe_lines(documents(spark))) == plain_kept_lines(TEXTS)


def test_lines_keep_all_columns(spark):
    docs = documents(spark)
    assert line_dedup.dedupe_lines(docs).select("row.*").columns == docs.columns


def test_lines_of_no_rows(spark):
    assert line_dedup.dedupe_lines(empty(spark)).count() == 0


def test_a_line_in_a_third_of_documents(spark):
    rows = [(i, f"own line number {i}\nthe very same line\n" + "the very same line" * (i % 2)) for i in range(300)]
    assert kept_lines(line_dedup.dedupe_lines(documents(spark, rows))) == plain_kept_lines(rows)


def test_insertions_and_deletions_are_reversible(spark, tmp_path):
    first, second = TEXTS[:9], [(20, "A shared line of text.\nFirst line here."), (21, "a new line of its own\nFirst line here.")]
    built = LineIndex.build(documents(spark, first), str(tmp_path / "a"))
    grown = built.insert(documents(spark, second))
    both = first + second
    assert kept_lines(grown.dedupe(documents(spark, both))) == plain_kept_lines(both)
    shrunk = grown.delete(documents(spark, second).select("doc_id"))
    assert kept_lines(shrunk.dedupe(documents(spark, first))) == plain_kept_lines(first)
    state = lambda index: Counter(index.counts.collect())
    assert state(shrunk) == state(built)
    left = [r for r in both if r[0] not in (7, None)]
    fewer = grown.delete(spark.createDataFrame([(7,), (None,)], "doc_id long"))
    assert kept_lines(fewer.dedupe(documents(spark, left))) == plain_kept_lines(left)


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    inside, outside = rng.integers(-(1 << 62), 1 << 62, 5_000), rng.integers(-(1 << 62), 1 << 62, 5_000)
    some = CuckooFilter.of(inside)
    assert some.contains(inside).all() and some.contains(outside).mean() < 0.01
    again = CuckooFilter.from_bytes(some.to_bytes())
    again.delete(inside[:2_500])
    assert again.contains(inside[2_500:]).all() and again.contains(inside[:2_500]).mean() < 0.01
    assert not CuckooFilter(1).insert(np.arange(100))
    assert not CuckooFilter.of(np.zeros(0, np.int64)).contains(inside).any()


# --- repeated byte strings ---


def removed(frame) -> Counter:
    return Counter(
        (r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in frame.collect()
    )


def test_common_prefixes_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(40):
        data = np.append(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(30, 200)), 255).astype(np.uint8)
        length = int(rng.integers(3, 12))
        array, transform = suffix_dedup.burrows_wheeler(data, length)
        shared = suffix_dedup.common_prefixes(transform, length)
        for k in range(1, len(array)):
            differ = np.flatnonzero(np.roll(data, -array[k - 1]) != np.roll(data, -array[k]))
            want = int(differ[0]) if len(differ) else len(data)
            assert shared[k] == (want if want < length else -1)


@pytest.mark.parametrize("limit", [2_000, 2, 1])
def test_suffixes_of_random_texts(spark, limit):
    rows = random_texts(50) + [(100, "ab" * 200), (101, "ab" * 150 + "c"), (102, "z" * 300)]
    assert removed(suffix_dedup.dedupe(documents(spark, rows), 48, limit=limit)) == plain_suffix(rows, 48)


def test_open_stretches_hold_every_repeated_window():
    rng = np.random.default_rng(6)
    length, dropped = 48, 0
    for _ in range(30):
        # contexts of two anchors, cut around the same place of texts that differ in a few bytes
        text, contexts, groups, offsets = rng.integers(97, 123, 200).astype(np.uint8), [], [], []
        for _ in range(8):
            own = text.copy()
            own[rng.integers(0, 200, rng.integers(1, 5))] = 65 + rng.integers(0, 26)
            low, size = int(rng.integers(70, 90)), int(rng.integers(length, length + 16))
            contexts.append(own[low : low + size])
            groups.append(int(rng.integers(0, 2)))
            offsets.append(100 - low)
        sizes = np.array([len(c) for c in contexts])
        counts = rng.integers(1, 3, 8) if rng.random() < 0.5 else np.ones(8, np.int64)
        owner, start, n = suffix_dedup.open_stretches(
            np.concatenate(contexts), np.cumsum(sizes) - sizes, sizes, np.array(offsets), np.array(groups), counts, length
        )
        held = {(i, a + k) for i, a, m in zip(owner.tolist(), start.tolist(), n.tolist()) for k in range(m - length + 1)}
        windows = {(i, k): (groups[i], offsets[i] - k, c[k : k + length].tobytes()) for i, c in enumerate(contexts) for k in range(len(c) - length + 1)}
        seen = Counter()
        for (i, _), w in windows.items():
            seen[w] += counts[i]
        repeated = {at for at, w in windows.items() if seen[w] >= 2}
        assert repeated <= held <= windows.keys()
        dropped += len(windows) - len(held)
    assert dropped > 0


def test_suffixes_of_awkward_rows(spark):
    rows = [(i, t[:3_000] if t else t) for i, t in TEXTS]
    assert removed(suffix_dedup.dedupe(documents(spark, rows))) == plain_suffix(rows, 400)
    assert suffix_dedup.dedupe(empty(spark)).count() == 0


def test_long_texts_are_cut_into_overlapping_blocks():
    from liftline.llm.suffix_dedup import window_contexts

    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 5_000).astype(np.uint8)
    first, size, offset, *_ = window_contexts(data, np.zeros(len(data), int), 400)
    starts = np.concatenate([np.arange(a, a + n - 399) for a, n in zip(first, size)])
    assert sorted(starts.tolist()) == list(range(len(data) - 399))
    assert ((offset >= size - 400) & (offset <= 368)).all()


# --- near copies ---


def test_alignment_by_brute_force():
    rnd = random.Random(4)
    for _ in range(300):
        a = [rnd.randint(0, 5) for _ in range(rnd.randint(0, 30))]
        b = [x for x in a if rnd.random() < 0.8] + [rnd.randint(0, 5) for _ in range(rnd.randint(0, 4))]
        x, y = np.array(a, np.int64), np.array(b, np.int64)
        assert near_dedup.aligned(x, y, 60) == plain_aligned(a, b)
        m = plain_aligned(a, b)
        if a and b:
            assert near_dedup.similar(x, y) == (m >= 0.8 * (len(a) + len(b) - m) - 1e-9)


def test_classes_of_random_texts(spark):
    rows = random_texts(80)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(spark, rows)).collect()}
    assert got == plain_classes(rows)


def test_classes_of_awkward_rows(spark):
    got = Counter((r["doc_id"], r["class_id"]) for r in near_dedup.classes(documents(spark)).collect())
    want = Counter(
        {(1, 1): 1, (2, 2): 1, (3, 3): 1, (None, None): 2, (4, 4): 1, (5, 4): 2, (6, 6): 1, (7, 7): 1, (8, 8): 1, (9, 9): 1,
         (10, 9): 1, (10, 10): 1, (11, 11): 1, (12, 11): 1}
    )
    assert got == want
    assert near_dedup.classes(empty(spark)).count() == 0


def test_one_row_of_each_class_stays(spark):
    docs = documents(spark)
    kept = near_dedup.deduped(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter({1: 1, 2: 1, 3: 1, None: 2, 4: 1, 6: 1, 7: 1, 8: 1, 9: 1, 10: 1, 11: 1})


def test_a_large_group_of_near_copies_and_a_shared_passage(spark, monkeypatch):
    rnd = random.Random(8)
    base = [f"base{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        words[rnd.randrange(60)] = f"edit{i}"
        rows.append((i, " ".join(words)))
    passage = " ".join(f"passage{i}" for i in range(40))
    rows += [(1_000 + i, passage + " " + " ".join(f"own{i}x{k}" for k in range(25))) for i in range(60)]
    rows += [(2_000 + i, rows[120 + i][1] + " more") for i in range(5)]
    monkeypatch.setattr(near_dedup, "SMALL", 10)  # so that members of large buckets meet by their prefixes
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(spark, rows)).collect()}
    assert got == plain_classes(rows)


def test_long_texts_of_many_edits_in_large_buckets(spark, monkeypatch):
    """Copies of one long text with few and many edits: not all are similar to a centre, and some only to one another."""
    monkeypatch.setattr(near_dedup, "SMALL", 10)
    rnd = random.Random(12)
    base = [f"long{i}" for i in range(200)]
    rows = []
    for i in range(90):
        words = list(base)
        for k in rnd.sample(range(200), rnd.randint(1, 9)):
            words[k] = f"edit{i}x{k}"
        rows.append((i, " ".join(words)))
        if i % 10 == 0:  # a copy of the copy
            words[rnd.randrange(200)] = f"again{i}"
            rows.append((1_000 + i, " ".join(words)))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(spark, rows)).collect()}
    assert got == plain_classes(rows) and len(set(got.values())) > 5


def test_alignment_of_long_texts_is_linear():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 40, 300_000)
    b = a.copy()
    b[[0, -1]] = 1, 2
    started = time.time()
    assert near_dedup.aligned(a, b, 4) == 299_998
    same = np.zeros(20_000, np.int64)
    assert near_dedup.similar(np.append(same, 1), np.append(same[:18_000], 2))
    assert time.time() - started < 20


def test_short_texts_in_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 10)
    rows = []
    for g in range(3):  # two texts of 13 words with 8 of 9 shingles in common, and many that have the 8 among 11
        core = " ".join(f"core{g}x{k}" for k in range(12))
        rows += [(1_000 * g + i, f"{core} own{g}x{i}") for i in range(2)]
        rows += [(1_000 * g + i, f"{core} a{g}x{i} b{g}x{i} c{g}x{i}") for i in range(2, 200)]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(spark, rows)).collect()}
    assert got == plain_classes(rows)
    assert [got[1], got[1_001], got[2_001]] == [0, 1_000, 2_000] and len(set(got.values())) == len(rows) - 3


def test_short_texts_of_unequal_length(spark):
    rows = []
    for g, n in enumerate([8, 9, 12, 13, 40, 100, 103, 104, 105, 110, 128, 129]):  # a fifth of the shingles added, and one more
        words = [f"word{g}x{k}" for k in range(n)]
        more = [f"more{g}x{k}" for k in range((n - 4) // 4 + 1)]
        rows += [(10 * g, " ".join(words)), (10 * g + 1, " ".join(words + more[:-1])), (10 * g + 2, " ".join(more + words))]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(spark, rows)).collect()}
    assert got == plain_classes(rows)
    assert (got[0], got[1], got[2]) == (0, 0, 2)  # 8 words, the same and one more, the same and two more


def edited(rnd: random.Random, words: list[str], edits: int, tag: str) -> list[str]:
    """A copy with words replaced, put in, left out, or a block moved, mostly near one another."""
    out, at = list(words), rnd.randrange(len(words))
    for k in range(edits):
        i = min(len(out) - 1, max(0, at + rnd.randint(-4, 4))) if rnd.random() < 0.6 else rnd.randrange(len(out))
        kind = rnd.choice(["replace", "replace", "insert", "delete", "move"])
        if kind == "replace":
            out[i] = f"{tag}e{k}" if rnd.random() < 0.7 else f"often{rnd.randint(0, 3)}"
        elif kind == "insert":
            out.insert(i, f"{tag}e{k}")
        elif kind == "delete" and len(out) > 20:
            del out[i]
        elif kind == "move":
            out = out[i:] + out[:i]
    return out


def test_similar_texts_meet_by_their_differences_from_any_head():
    """The places that the prefixes of differences must reach, against every pair, whatever text is the head."""
    rnd = random.Random(31)
    of = lambda words: near_dedup.shingle_values(np.array([hash(w) for w in words], np.int64))
    met = 0
    for n in (20, 45, 80, 140):
        base = [f"base{n}x{i}" for i in range(n)]
        family = [of(edited(rnd, base, rnd.randint(0, 4), f"t{i}")) for i in range(60)]
        for head in family[:6]:
            sets = [set(near_dedup.labelled_values(x).tolist()) for x in family]
            differ = [sorted(x ^ set(near_dedup.labelled_values(head).tolist())) for x in sets]
            far = [len(d) > near_dedup.allowed(len(x) + len(head)) for d, x in zip(differ, family)]
            reach = [near_dedup.index_reach(len(d), len(x), len(head), f) for d, x, f in zip(differ, family, far)]
            for i in range(60):
                for j in range(60):
                    first = not far[j] or (len(differ[j]), j) < (len(differ[i]), i)
                    if i != j and far[i] and first and near_dedup.similar(family[i], family[j]):
                        met += 1
                        assert set(differ[i][: len(family[i]) // 4 + 1]) & set(differ[j][: reach[j] + 1])
    assert met > 200


def test_families_of_edited_texts_by_differences(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    met = []
    real = near_dedup._by_centres
    monkeypatch.setattr(near_dedup, "_by_centres", lambda rows, *rest: met.append(rows.where("members > 3").count()) or real(rows, *rest))
    rnd = random.Random(17)
    rows = []
    for g, n in enumerate([14, 30, 60, 100, 150]):
        base = [f"base{g}x{i}" for i in range(n)]
        for i in range(60):
            rows.append((1_000 * g + i, " ".join(edited(rnd, base, rnd.randint(0, 5), f"t{g}x{i}"))))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(spark, rows)).collect()}
    assert got == plain_classes(rows) and len(set(got.values())) > 50 and max(met) > 100


def test_components_of_links_found_later(spark, monkeypatch, tmp_path):
    """Later links are contracted between known components, and nothing of the rounds stays on disk but the result, in few files."""
    at = lambda _, label: f"{tmp_path}/{label}-{len(list(tmp_path.iterdir()))}"
    monkeypatch.setattr("liftline.llm.common.scratch_path", at)
    monkeypatch.setattr("liftline.session.scratch_path", at)
    monkeypatch.setattr(near_dedup, "TASK_ROWS", 100)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda _: 2))
    rnd = random.Random(5)
    first = [(k, k + 1) for k in range(1_000, 1_030)] + [(2_000, 2_000 + k) for k in range(1, 40)]
    first += [tuple(sorted(rnd.sample(range(300), 2))) for _ in range(120)]
    later = [tuple(sorted(rnd.sample(range(400), 2))) for _ in range(60)] + [(1_005, 2_007), (1_029, 3_000)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    names: dict[int, int] = {}
    for links, known in ((first, None), (later, near_dedup.components(frame(first)))):
        got = near_dedup.components(frame(links), known)
        for a, b in links:
            a, b = sorted(names.get(x, x) for x in (a, b))
            names |= {x: a for x in [a, b, *names] if names.get(x, x) == b or x == a}
        assert {r["node"]: r["component"] for r in got.collect()} == names and got.count() == len(names)
    left = list(tmp_path.iterdir())
    assert {p.name.split("-")[0] for p in left} == {"components"}
    assert max(len(list(p.glob("part-*"))) for p in left) <= 5
