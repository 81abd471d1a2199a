"""Personal data, vector codes and the manifest against plain versions, with every awkward row."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from llm_rows import CLASHING, LONG, TEXTS, documents, empty
from pyspark.sql import functions as F

from liftline.llm import merkle, personal_data as pd_, queries as q, vector_codes as vc
from liftline.llm.common import table

SF = "/root/testdata/sf0.001"

# --- personal data ---


def plain_found(t: str) -> list[tuple[int, int, int]]:
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        doubled = [x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(reversed(d))]
        if 12 <= len(d) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@pytest.mark.parametrize("alphabet,longest", [("ab1.@-+ 9(5", 40), ("12345 -0.", 60)])
def test_base_spans_of_random_texts(alphabet, longest):
    rnd = random.Random(3)
    for _ in range(20_000):
        t = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest)))
        assert pd_.found_in(t) == plain_found(t), t


def added(t: str) -> list[tuple[str, str]]:
    base, more = pd_.spans_of(t)
    assert base == plain_found(t)
    return [(pd_.KINDS[k], t[a:b]) for a, k, b in more]


@pytest.mark.parametrize("text,kind", [
    ("joe (at) example [dot] com", "email"),
    ("joe.smith at mail dot example dot com", "email"),
    ("john dot doe at example dot com", "email"),
    ("user[at]host[.]org", "email"),
    ("joe @ example dot com", "email"),
    ("jоe@ехаmple.com", "email"),
    ("joe＠example。com", "email"),
    ("joe​.smith@exa­mple.com", "email"),
    ("10 dot 0 dot 0 dot 1", "ip"),
    ("１０.２０.３０.４０", "ip"),
    ("4111 1111 1111​ 1111", "card"),
    ("four one one one-１１１１ 1111 1111", "card"),
    ("plus four nine one five one two three four five six seven eight", "phone"),
    ("+49 151 null eins zwei drei vier fünf sechs", "phone"),
    ("+49 151 ٠١٢ ٣٤٥", "phone"),
])
def test_disguises_lead_back_to_their_source(text, kind):
    assert added(text) == [(kind, text)]
    around = f"Bitte, é: {text}, \U0001f600 ok."
    assert added(around) == [(kind, text)]


@pytest.mark.parametrize("text", [
    "look at example.com", "one two three go", "a at b", "ten dot one", "x (at) y", "m² and ½ at noon", "one two 3 four 5 six",
    "mail joe@example.com from 10.0.0.1", "she came at nine dot", "é ü ß 日本", "",
])
def test_plain_texts_get_nothing_added(text):
    assert added(text) == []


def test_long_runs_end_soon():
    parts = ["a", "1", "1.", "1 ", "@", "a@", "+1", "one ", "dot ", " at ", "a at a ", "a dot ", "( at", "<", " ", "one.1-", "zero", "９", "x​", "a (at) b [dot] c "]
    started = time.time()
    for x in parts:
        pd_.spans_of(x * (300_000 // len(x)))
    assert time.time() - started < 60


def test_awkward_rows_keep_their_spans(spark):
    rows = [*TEXTS, (20, "joe (at) example [dot] com, +1 (017) 555-7713"), (20, "joe (at) example [dot] com, +1 (017) 555-7713"), (None, "1.2.3.4")]
    got = Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["spans"]) for r in pd_.scan(documents(spark, rows)).collect())
    want = Counter()
    for i, t in rows:
        base, more = pd_.spans_of(t or "")
        assert base == plain_found(t or "")
        spans = ",".join(f"{pd_.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base + more))
        want[(i, *(sum(x[1] == k for x in base) for k in range(4)), spans)] += 1
    assert got == want and got[(20, 0, 0, 0, 1, "email:0:26,phone:28:45")] == 2
    assert pd_.scan(empty(spark)).count() == 0


def test_personal_data_query_equals_plain_version(spark):
    frame = q.op11_personal_data(spark, SF)
    assert frame.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    got = {r["doc_id"]: r for r in frame.collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        base = plain_found(t)
        named = ",".join(f"{pd_.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert got[i]["base_sha256"] == hashlib.sha256(named.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pd_.KINDS] == [sum(x[1] == n for x in base) for n in range(4)]
        assert set(filter(None, named.split(","))) <= set(got[i]["spans"].split(","))


# --- vector codes ---


@pytest.mark.parametrize("n,m,dim,high", [(1, 1, 1, 5), (5, 3, 2, 3), (200, 64, 4, 4), (3000, 64, 4, 60), (4096, 63, 4, 100), (17, 64, 4, 2), (100, 1, 4, 9)])
def test_dual_trees_equal_all_distances(n, m, dim, high):
    rng = np.random.default_rng(n)
    points, entries = rng.integers(-high, high, (n, dim)), rng.integers(-high, high, (m, dim))
    points[: n // 3] = points[0]
    order = vc.tree_order(points, vc.part_depth(n))
    counts, sums, at, chosen = vc.nearest(vc.Tree(points[order], vc.part_depth(n)), vc.EntryTree(entries))
    got = np.full(n, -1)
    got[order[np.concatenate(at)]] = np.concatenate(chosen)
    want = ((points[:, None] - entries[None]) ** 2).sum(-1).argmin(1)
    assert (got == want).all()
    total = np.zeros((m, dim), np.int64)
    np.add.at(total, want, points)
    assert (counts == np.bincount(want, minlength=m)[: len(counts)]).all() and (sums == total[: len(sums)]).all()


def plain_codes(rows, parts: int, entries: int, rounds: int):
    kept = [(i, tuple(v), c) for i, v, c in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max([len(v) for _, v, _ in kept] + [1]) // parts) * parts
    limit = 1 << 27
    ints = [[min(limit, max(-limit, int(np.floor(256 * x)))) if abs(x) < 1e30 else limit * int(np.sign(x)) for x in v] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, ints[k]))
    x = np.array([v + [0] * (width - len(v)) for v in ints], object).reshape(len(kept), parts, width // parts)
    books = [[list(x[k][j]) for k in order[:entries]] for j in range(parts)]
    far = lambda a, b: sum((p - r) ** 2 for p, r in zip(a, b))
    codes: list = []
    for turn in range(rounds + 1):
        codes = [[min((far(v[j], b), e) for e, b in enumerate(books[j])) for j in range(parts)] for v in x]
        for j in range(parts if turn < rounds else 0):
            for e in range(len(books[j])):
                mine = [v[j] for v, c in zip(x, codes) if c[j][1] == e]
                if mine:
                    books[j][e] = [sum(col) // len(mine) for col in zip(*mine)]
    errors = Counter()
    for (_, _, label), c in zip(kept, codes):
        errors[label] += sum(d for d, _ in c)
    return Counter(
        (i, "".join(f"{e:02x}" for _, e in c), sum(d for d, _ in c), errors[label]) for (i, _, label), c in zip(kept, codes)
    ), [[[int(y) for y in b] for b in book] for book in books]


def vectors(spark, rows):
    extra = [*CLASHING, "v", "code", "error", "other"]
    schema = "vec_id long, embedding array<double>, label int, " + ", ".join(f"`{c}` string" for c in extra)
    return spark.createDataFrame([(*r, *["-"] * len(extra)) for r in rows], schema)


def test_codes_of_awkward_vectors(spark):
    rng = np.random.default_rng(8)
    exact = lambda n: [float(np.float32(x)) for x in rng.standard_normal(n)]
    rows = [(i, exact(8), i % 3 if i % 5 else None) for i in range(90)]
    rows += [(100 + i, rows[7][1], 7) for i in range(60)]  # one vector in a third of the rows
    rows += [(3, rows[4][1], 1), (3, rows[3][1], 1), (None, exact(8), 2), (200, None, 1), (201, [1.0, None], 1), (202, [float("nan")] * 8, 1)]
    rows += [(203, [float("inf")] * 8, 1), (204, [], None), (205, [0.0] * 8, 2), (206, [1e300, -1e300, 9e8], 2), (207, exact(5), 2)]
    found, books = vc.compress(vectors(spark, rows), parts=4, entries=12)
    want, want_books = plain_codes(rows, 4, 12, 2)
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found.collect()) == want
    assert books.tolist() == want_books
    none, books = vc.compress(vectors(spark, []))
    assert none.count() == 0 and books.size == 0
    few, _ = vc.compress(vectors(spark, rows[:3]), parts=4, entries=12)
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in few.collect()) == plain_codes(rows[:3], 4, 12, 2)[0]


# --- the manifest ---


def hashed(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows) -> Counter:
    """(id, leaf, subroot, root, proof, folded root) of rows (id, source, lang, n_chars, text, tampered)."""
    one = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    small = lambda t: t if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([hashed(out[-1][k : k + 16]) for k in range(0, len(out[-1]), 16)])
        return out

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            out.append((i % 16, level[i - i % 16 : i - i % 16 + 16]))
            i //= 16
        return out

    groups: dict = {}
    for i, source, lang, n, text, bad in rows:
        leaf = lambda t: hashed(map(one, (i, source, lang, n, t)))  # noqa: E731, B023
        groups.setdefault(source, []).append(((i is not None, i or 0), leaf(text), i, leaf(small(text)) if bad else leaf(text)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(groups[s], key=lambda r: r[:2]) for s in names}
    trees = {s: tree([r[1] for r in leaves[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = Counter()
    for k, s in enumerate(names):
        for i, (_, leaf, doc_id, digest) in enumerate(leaves[s]):
            steps = path(trees[s], i) + path(top, k)
            proof = hashed(x for at, run in steps for j, x in enumerate(run) if j != at)
            for at, run in steps:
                digest = hashed([*run[:at], digest, *run[at + 1 :]])
            out[(doc_id, leaf, trees[s][-1][0], top[-1][0], proof, digest)] += 1
    return out


MANIFEST_SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, bad boolean, " + ", ".join(
    f"`{c}` string" for c in [*CLASHING, "pos", "block", "path", "tag", "leaf", "part", "local"]
)


def manifest_rows(spark, rows):
    extra = MANIFEST_SCHEMA.count("string") - 3
    return spark.createDataFrame([(*r, *["-"] * extra) for r in rows], MANIFEST_SCHEMA)


def check_manifest(spark, rows):
    tree = merkle.documents_manifest(manifest_rows(spark, rows), F.col("bad"))
    found = merkle.verified(tree).collect()
    columns = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    assert Counter(tuple(r[c] for c in columns) for r in found) == plain_manifest(rows)
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in found)
    assert all(r["copies"] is None or (r["copies"] or [r["folded_root"]])[-1] == r["folded_root"] for r in found)
    return found


def test_manifest_of_awkward_rows(spark):
    rows = [(i, "hot" if n % 3 else None, "en", len(t or ""), t, bool(n % 2)) for n, (i, t) in enumerate(TEXTS)]
    rows += [(5, "hot", "en", 3, "Abc", True)] * 40 + [(None, "", None, None, None, True), (7, "Ünï", "de", 1, LONG, True), (8, "é", None, None, "x", None)]
    rows += [(100 + i, f"s{i}", "en", 2, "Ab", True) for i in range(40)]  # groups of one, enough for a second level of groups
    found = check_manifest(spark, rows)
    assert any(r["copies"] is not None and not r["verified"] for r in found)
    assert merkle.verified(merkle.documents_manifest(manifest_rows(spark, []), F.lit(True))).count() == 0
    check_manifest(spark, rows[-1:])  # a lone leaf is the root


def test_manifest_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)  # blocks of 16, so that paths pass several tables
    rows = [(i, "hot" if i % 4 else f"s{i % 3}", "en", i, f"Text {i}", i % 5 == 0) for i in range(1_400)]
    check_manifest(spark, rows)


def test_a_version_shares_what_it_does_not_copy(spark):
    rows = [(i, "a", "en", i, f"Text {i}", i == 700) for i in range(1_000)]
    copies = [r["copies"] for r in check_manifest(spark, rows) if r["copies"] is not None]
    assert len(copies) == 1 and len(copies[0]) == merkle.levels(1_000)
