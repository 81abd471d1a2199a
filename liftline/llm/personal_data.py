"""Personal data in texts, also where it is disguised: transducers normalise a text, and what is found goes back to its source characters.

A transducer reads a text and writes another, piece by piece, and keeps for each piece where it came from. Three run one after another.
``folded`` replaces homoglyphs (full-width and styled letters, Cyrillic and Greek look-alikes, digits of other scripts, odd blanks and dashes) and
drops characters without width. ``undisguised`` reads ``(at)``, ``[dot]`` and, where an address or a number of dotted digits needs them, bare ``at``
and ``dot`` as the signs they stand for. ``in_digits`` reads spelled digits, three or more next to each other, and ``plus`` before them. The four kinds of identifiers
are looked for in the text itself (base spans) and in what the transducers made of it; a find that rests on something rewritten is mapped back to the
characters it came from and added. Nothing is rewritten in most texts; those are searched once.

Every search is linear in the text: runs are taken whole and never tried again from inside.

Defined results: one row per input row; a NULL or empty text has no spans; positions count code points and ends are exclusive; base spans are
leftmost and do not overlap within a kind; spans are ordered by start, kind, end, and an added span equal to a base span of its kind is not
repeated; repeated rows give repeated rows; ids may be NULL; other columns are ignored. A bare ``at`` counts only where a disguised dot follows
the next word, so that "look at example.com" is no address.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from liftline.llm.common import map_frames, texts

KINDS = ("email", "ip", "card", "phone")

#: The base patterns, written so that a failed run is not tried again from inside.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile("[0-9]+")
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)

#: Look-alikes that compatibility forms do not cover, by the character they are read as.
LOOKALIKES = {
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іıι", "j": "ј", "k": "κ", "l": "ӏⅼ", "m": "ⅿ", "n": "ոո",
    "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "τ", "u": "υս", "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уγ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙӀ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ",
    "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
    "-": "‐‑‒–—―−⁃﹘", ".": "。․", "@": "＠﹫",
}
#: Characters without width.
NO_WIDTH = "­​‌‍⁠﻿"
#: Digits as words, English, German, French and Spanish.
SPELLED = {
    "0": "zero oh null zéro cero", "1": "one eins un uno", "2": "two zwei deux dos", "3": "three drei trois tres", "4": "four vier quatre cuatro",
    "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete", "8": "eight acht huit ocho", "9": "nine neun neuf nueve",
}
WORDS = {word: digit for digit, words in SPELLED.items() for word in words.split()}
#: Words for the two signs.
AT, DOT, PLUS = ("at", "arroba"), ("dot", "punkt", "punto", "point"), "plus"
#: Spelled digits in a row that are read as digits.
IN_A_ROW = 3


class Transduced:
    """A text written by a transducer from another: pieces copied, and pieces rewritten. Places in it lead back to the source."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        """``edits``: (start, end, replacement) in order, not overlapping."""
        out, at, length = [], 0, 0
        #: Per piece: where it begins, where its source begins and ends, and whether it was rewritten.
        self.begins: list[int] = []
        self.pieces: list[tuple[int, int, bool]] = []

        def add(text: str, start: int, end: int, rewritten: bool) -> None:
            nonlocal length
            if text:
                self.begins.append(length)
                self.pieces.append((start, end, rewritten))
                out.append(text)
                length += len(text)

        for start, end, text in edits:
            add(source[at:start], at, start, False)
            add(text, start, end, True)
            at = end
        add(source[at:], at, len(source), False)
        self.text = "".join(out)
        #: Places where something was dropped.
        self.dropped = [start for start, _, text in edits if not text]

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """The source of [start, end), and whether any of it was rewritten or dropped."""
        i, j = bisect_right(self.begins, start) - 1, bisect_right(self.begins, end - 1) - 1
        first, last = self.pieces[i], self.pieces[j]
        a = first[0] if first[2] else first[0] + start - self.begins[i]
        b = last[1] if last[2] else last[0] + end - self.begins[j]
        changed = any(p[2] for p in self.pieces[i : j + 1]) or bisect_right(self.dropped, a) < bisect_right(self.dropped, b - 1)
        return a, b, changed


@lru_cache(maxsize=1)
def fold_table() -> dict[str, str]:
    """Characters read as another: those whose compatibility form is one ASCII character, decimal digits, and the look-alikes."""
    table = {}
    for c in range(128, 0x1FBFA):
        x = chr(c)
        plain = unicodedata.normalize("NFKC", x)
        if len(plain) == 1 and plain.isascii():
            table[x] = plain
        elif unicodedata.decimal(x, None) is not None:
            table[x] = str(unicodedata.decimal(x))
    table |= {x: plain for plain, many in LOOKALIKES.items() for x in many}
    return table | dict.fromkeys(NO_WIDTH, "")


def folded(text: str) -> Transduced | None:
    table = fold_table()
    if text.isascii() or table.keys().isdisjoint(text):
        return None
    there = re.compile("[" + re.escape("".join(table.keys() & set(text))) + "]")
    return Transduced(text, [(m.start(), m.end(), table[m[0]]) for m in there.finditer(text)])


def _either(words: tuple) -> str:
    return "|".join(words)


#: A disguised sign with the blanks around it: in brackets, or bare between blanks.
SIGN = re.compile(
    rf"[ \t]{{0,2}}[\[({{<][ \t]{{0,2}}(?:(?P<at>{_either(AT)}|@)|(?P<dot>{_either(DOT)}|\.))[ \t]{{0,2}}[\])}}>][ \t]{{0,2}}"
    rf"|[ \t]{{1,2}}(?:(?P<bare_at>{_either(AT)}|@)|(?P<bare_dot>{_either(DOT)}))(?=[ \t])[ \t]{{1,2}}",
    re.IGNORECASE,
)
BRACKETED = re.compile(rf"[\[({{<][ \t]{{0,2}}(?:{_either(AT)}|@|{_either(DOT)}|\.)[ \t]{{0,2}}[\])}}>]", re.IGNORECASE)
WORD = re.compile(r"[A-Za-z0-9._%+-]{1,64}")


def undisguised(text: str) -> Transduced | None:
    """Signs are taken in chains, linked by single words: ``a at b dot c`` is one. In a chain an at in brackets counts, a bare one if a
    dot comes next; with it the dots that follow and those before; without any at, three dots or more between digits."""
    small = text.lower()
    if not any(word in small for word in DOT) and not BRACKETED.search(text):
        return None
    signs = [(m.start(), m.end(), m.lastgroup) for m in SIGN.finditer(text)]
    edits = []
    k = 0
    while k < len(signs):
        chain = [signs[k]]
        while k + 1 < len(signs) and WORD.fullmatch(text, signs[k][1], signs[k + 1][0]):
            k += 1
            chain.append(signs[k])
        k += 1
        edits += _read(text, chain)
    return Transduced(text, edits) if edits else None


def _read(text: str, chain: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    kinds = [kind[-3:] == "dot" for _, _, kind in chain]
    taken = set()
    for i, (_, _, kind) in enumerate(chain):
        if kind == "at" or kind == "bare_at" and i + 1 < len(chain) and kinds[i + 1]:
            taken.add(i)
            for step in (1, -1):
                j = i + step
                while 0 <= j < len(chain) and kinds[j] and j not in taken:
                    taken.add(j)
                    j += step
    if not taken and len(chain) >= 3 and all(kinds):
        inner = all(DIGITS.fullmatch(text, a[1], b[0]) for a, b in zip(chain, chain[1:]))
        if inner and text[chain[0][0] - 1 : chain[0][0]].isdigit() and text[chain[-1][1] : chain[-1][1] + 1].isdigit():
            taken = set(range(len(chain)))
    # dots in brackets stand between words anyway: "example[.]com"
    taken |= {i for i, (_, _, kind) in enumerate(chain) if kind == "dot"}
    return [(chain[i][0], chain[i][1], "." if kinds[i] else "@") for i in sorted(taken)]


_WORD = "|".join(sorted(WORDS, key=len, reverse=True))
ROW = re.compile(
    rf"(?<![^\W_])(?:(?P<plus>{PLUS})[ -])?(?P<row>(?:{_WORD}|[0-9]{{1,19}}+)(?:[ .-](?:{_WORD}|[0-9]{{1,19}}+)){{{IN_A_ROW - 1},64}})(?![^\W_])",
    re.IGNORECASE,
)
SPELLED_WORD = re.compile(_WORD, re.IGNORECASE)
SEPARATOR = re.compile("[ .-]")
LETTERS = re.compile(r"[^\W\d_]+")


def in_digits(text: str) -> Transduced | None:
    marks = "".join(["1" if word in WORDS else " " for word in LETTERS.findall(text.lower())])
    if "1" * IN_A_ROW not in marks:
        return None
    edits = []
    for m in ROW.finditer(text):
        marks = "".join(["1" if word in WORDS else " " for word in SEPARATOR.split(m["row"].lower())])
        if "1" * IN_A_ROW in marks:
            if m["plus"]:
                edits.append((m.start("plus"), m.start("row"), "+"))
            edits += [(w.start(), w.end(), WORDS[w[0].lower()]) for w in SPELLED_WORD.finditer(text, *m.span("row"))]
    return Transduced(text, edits) if edits else None


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def found_in(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the identifiers in a text, leftmost and not overlapping per kind."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, 0, domain.end()))
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", last)
    for m in DOTTED.finditer(text):
        if m[0].count(".") >= 3:
            parts, start = m[0].split("."), m.start()
            for i in range(0, len(parts) - 3, 4):  # four by four from the left
                four = parts[i : i + 4]
                end = start + sum(map(len, four)) + 3
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                    out.append((start, 1, end))
                start = end + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = m[0].replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= sum(map(len, DIGITS.findall(m[0]))) <= PHONE_DIGITS[1]:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, added) spans, each (start, kind, end) in the text."""
    base = found_in(text)
    written: list[Transduced] = []
    now = text
    for transducer in (folded, undisguised, in_digits):
        done = transducer(now)
        if done:
            written.append(done)
            now = done.text
    if not written:
        return base, []
    known, added = set(base), set()
    for start, kind, end in found_in(now):
        rewritten = False
        for step in reversed(written):
            start, end, changed = step.back(start, end)
            rewritten |= changed
        if rewritten and (start, kind, end) not in known:
            added.add((start, kind, end))
    return base, sorted(added)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of each row: how many base spans of each kind, the base spans and all spans."""
    rows = texts(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType

    def scanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [spans_of(t) for t in frame["text"]]
            counts = {f"n_{k}": [sum(x[1] == i for x in base) for base, _ in found] for i, k in enumerate(KINDS)}
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], **counts, "base": [joined(b) for b, _ in found], "spans": [joined(b + a) for b, a in found],
            })

    schema = "doc_id string, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string"
    # ids pass as text: a NULL would turn a block of long ids into doubles
    done = map_frames(rows.withColumn("doc_id", F.col("doc_id").cast("string")), scanned, schema)
    return done.withColumn("doc_id", F.col("doc_id").cast(id_type))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the hash of the base spans, and all spans."""
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")
