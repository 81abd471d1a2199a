"""Small tables with every awkward row, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter

LONG = " ".join(f"word{i % 997} of{i}" for i in range(9_000)) + "\n" + "x" * 3_000
PASSAGE = " ".join(f"common{i}" for i in range(70))
TEXTS = [
    (1, None),
    (2, ""),
    (3, "short"),
    (None, "This one has no id but some words, and a line that others share.\nA shared line of text."),
    (None, None),
    (4, LONG),
    (5, LONG),
    (5, LONG),
    (6, " \t\n\n \n"),
    (7, "First line here.\n  A SHARED line of text. \nLast of seven."),
    (8, "Ünïcode ñandú 日本語 text with é and ß\nA shared line of text.\n\n"),
    (9, PASSAGE + " and its own ending number nine"),
    (10, PASSAGE + " and its own ending number ten"),
    (10, "The second row of the tenth id.\nA shared line of text."),
    (11, "same same same same same same same same same same same same same same"),
    (12, "same same same same same same same same same same same same same same"),
]
#: Names that operators use inside.
CLASHING = ["tie", "key", "line", "row", "node", "score", "start", "spans", "doc", "hash", "d", "t", "id", "n", "w.x"]


def documents(spark, rows=TEXTS):
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, *("-" for _ in CLASHING)) for i, t in rows], schema)


def empty(spark):
    return documents(spark, [])


def random_texts(n: int = 60, seed: int = 5) -> list[tuple[int, str]]:
    """Texts with copies, near copies and shared passages."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 6)))
    shared = [" ".join(word() for _ in range(40)) for _ in range(3)]
    out = []
    for i in range(n):
        if i % 4 == 1 and out:
            words = rnd.choice(out)[1].split(" ")
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = word()
            out.append((i, " ".join(words)))
        else:
            parts = [" ".join(word() for _ in range(rnd.randint(0, 60)))]
            if i % 3 == 0:
                parts.insert(rnd.randint(0, 1), rnd.choice(shared))
            out.append((i, " ".join(parts)))
    return out


def plain_words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def plain_shingles(text: str | None) -> set[tuple]:
    w = plain_words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def plain_kept_lines(rows) -> Counter:
    """(doc_id, lines, dropped, text) of each row."""
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: (i is None, i)
    holders: dict[str, set] = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                holders.setdefault(key(x), set()).add(order(i))
    gone = {k: min(v) for k, v in holders.items() if len(v) > 1}
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), order(i)) == order(i)]
        out[(i, len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    return out


def plain_suffix(rows, length: int) -> Counter:
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(r[k : k + length] for _, r in raws for k in range(len(r) - length + 1))
    out = Counter()
    for i, r in raws:
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if seen[r[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[(i, len(r), sum(gone), runs, kept)] += 1
    return out


def plain_aligned(a, b) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def plain_classes(rows) -> dict:
    """Class of each id, for texts with different ids: linked where equal or similar in their aligned shingles."""
    words = {i: plain_words(t) for i, t in rows}
    seqs = {i: [tuple(w[k : k + 5]) for k in range(len(w) - 4)] for i, w in words.items()}
    group = {i: i for i in words}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(words)
    for n, x in enumerate(ids):
        for y in ids[n + 1 :]:
            a, b = seqs[x], seqs[y]
            same = bool(words[x]) and words[x] == words[y]
            if not same and a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and set(a) & set(b):
                m = plain_aligned(a, b)
                same = m >= 0.8 * (len(a) + len(b) - m)
            if same:
                p, q = sorted((top(x), top(y)))
                group[q] = p
    return {i: top(i) for i in ids}
