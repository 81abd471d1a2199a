"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded texts, normalised by length.

Folding maps homoglyphs, accents, digits and signs that stand for letters onto one letter each, so ``1d!0t``, ``ïdiot`` and ``idiot``
meet. The lexicon holds whole words and word beginnings that labelled toxic texts have far more often than clean ones;
a weight is the smoothed log-odds. Exception phrases are a lexicon word with the word before or after it where that pair belongs to
clean texts; a match inside one does not count, and weights are taken again without them. Per text the weights of matched words
(the largest where several match) give a total, and the total per word; a logistic curve over both turns them into a score.

Learning uses at most ``PER_LABEL`` labelled rows of each class, those with the smallest hashes of their ids. Everything
learnt is bounded by that: at most ``TERMS`` terms and as many exceptions. Scoring covers every row and shuffles nothing.

Defined results: a NULL or empty text is scored like one without matches; labels that are NULL do not count, of several
labels of a document the largest does; repeated rows are scored alike; other columns stay; without labels of both classes every score is
the share of the class there is, or 0.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from liftline.llm.common import col, map_frames, ship_package, texts, written

PER_LABEL = 6_000
TERMS = 2_000
LEAST_WEIGHT = 2.0
#: A term or exception stands in so many sample texts of its class at least, and in that share of them.
LEAST_SUPPORT, LEAST_SHARE = 8, 0.005
#: Total weight beyond which more matches say nothing new.
CERTAIN = 30.0
#: Lengths of word beginnings that can become terms.
BEGINNINGS = (4, 5, 6, 7)

#: Characters that look like a letter, by that letter; digits and signs read as letters. l, I and 1
#: are one class.
LOOKALIKES = {
    "a": "аαａ@4ɑ", "b": "вβｂ8Ь", "c": "сϲｃ¢", "d": "ԁｄ", "e": "еεｅ3€ё", "g": "ɡｇ9", "h": "һнｈ", "i": "іιｉ1!|lӏｌ", "j": "јｊ",
    "k": "кκｋ", "m": "мｍ", "n": "ոｎ", "o": "оοｏ0", "p": "рρｐ", "q": "ԛｑ", "r": "гｒ", "s": "ѕｓ5$", "t": "тτｔ7+", "u": "υｕ",
    "v": "νѵｖ", "w": "ԝｗ", "x": "хχｘ", "y": "уγｙ", "z": "ｚ2",
}


@lru_cache(maxsize=1)
def fold_table() -> dict[int, str]:
    table = {c: unicodedata.normalize("NFKD", chr(c))[0] for c in range(0xC0, 0x250)}
    table |= {c: chr(c).lower() for c in range(65, 91)}
    table |= {c: x.lower() for c, x in table.items()}
    table |= {c: None for c in range(0x300, 0x370)}  # combining accents
    return table | {ord(x): letter for letter, many in LOOKALIKES.items() for x in many}


APART = re.compile(r"[^a-zͰ-\U0010ffff]+")
#: Signs that end a word are punctuation, not letters.
ENDING_SIGNS = re.compile(r"[!|@$+]+(?![^\W_])")


def folded(text: str) -> str:
    """The words of a text, folded, one blank around each; signs are letters only where a letter follows."""
    return " " + APART.sub(" ", ENDING_SIGNS.sub(" ", text).lower().translate(fold_table())).strip() + " "


@dataclass
class Lexicon:
    """``terms``: pattern to weight, a blank before each word or beginning and after each whole word."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (0.0, 0.0, -30.0)

    @property
    def key(self) -> tuple:
        return tuple(sorted(self.terms.items())), tuple(sorted(self.exceptions))


@lru_cache(maxsize=4)
def automaton(key: tuple):
    import ahocorasick

    found = ahocorasick.Automaton()
    for term, weight in key[0]:
        found.add_word(term, (term, weight))
    for phrase in key[1]:
        found.add_word(phrase, (phrase, None))
    if len(found):
        found.make_automaton()
    return found


def matches(text: str, key: tuple) -> dict[int, float]:
    """Weight per matched word, by where the word begins in the folded text."""
    search = automaton(key)
    if not len(search):
        return {}
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (pattern, weight) in search.iter(text):
        start = end - len(pattern) + 1
        if weight is None:
            excused.append((start, end))
        else:
            best[start] = max(best.get(start, 0.0), weight)
    if not excused:
        return best
    # where the furthest end among the phrases that begin up to a match lies beyond the match, one of them holds it
    excused.sort()
    starts, reach = [a for a, _ in excused], list(accumulate((b for _, b in excused), max))
    held = lambda s: (k := bisect_right(starts, s)) and s < reach[k - 1]
    return {s: w for s, w in best.items() if not held(s)}


def features(text: str, key: tuple) -> tuple[float, float]:
    """The total weight, up to where it is beyond doubt, and the weight per word."""
    plain = folded(text or "")
    total = sum(matches(plain, key).values())
    return min(total, CERTAIN) / 10, 10 * total / max(1, plain.count(" ") - 1)


def curve_of(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression by Newton's steps."""
    a = np.column_stack([x, np.ones(len(x))])
    b = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        slope = a.T @ (y - p) - ridge * b
        bend = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge * np.eye(len(b))
        step = np.linalg.solve(bend, slope)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in b)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_label: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(text, y): at most ``per_label`` labelled documents of each class, stored. Only ids of the sample are broadcast. Equal
    texts are one row, of the largest label: else the words of a text copied often would look typical of its class."""
    marks = labels.select(col("doc_id").alias("doc_id"), col(label).alias("y")).where(usable & F.col("y").isNotNull())
    one = marks.groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = one.where("y = 1").orderBy(*order).limit(per_label).union(one.where("y = 0").orderBy(*order).limit(per_label))
    rows = texts(docs, id_col, text_col)
    return written(rows.join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.max("y").alias("y")), "labelled")


def _counted(sample: DataFrame, terms_of) -> DataFrame:
    """(term, bad, good): in how many texts of each class a term stands."""

    def counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = (Counter(), Counter())
            for text, y in zip(frame["text"], frame["y"]):
                found[y].update(terms_of(folded(text)))
            terms = list(found[0].keys() | found[1].keys())
            if terms:
                named = pd.Series(terms, dtype=object)
                yield pd.DataFrame({"term": named, "bad": [found[1][t] for t in terms], "good": [found[0][t] for t in terms]})

    each = map_frames(sample, counts, "term string, bad long, good long")
    return each.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _weight(bad: int, good: int) -> Column:
    return F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))


def learn(sample: DataFrame) -> Lexicon:
    """A lexicon from a bounded frame (text, y)."""
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Lexicon(curve=(0.0, 0.0, 30.0 if bad else -30.0))

    least_bad, least_good = (max(LEAST_SUPPORT, LEAST_SHARE * n) for n in (bad, good))

    def terms_of(text: str) -> set[str]:
        words = set(text.split())
        return {f" {w} " for w in words if len(w) >= 3} | {f" {w[:k]}" for w in words for k in BEGINNINGS if len(w) > k}

    def chosen(counts: DataFrame) -> dict[str, float]:
        weighed = counts.where(F.col("bad") >= least_bad).withColumn("w", _weight(bad, good)).where(F.col("w") >= LEAST_WEIGHT)
        best = weighed.orderBy(F.desc(F.col("w") * F.sqrt("bad")), "term").limit(TERMS)
        return {r["term"]: r["w"] for r in best.collect()}

    first = _counted(sample, terms_of)
    # words worth a look although clean texts have them too: their exceptions may explain those
    mixed_words = first.where((F.col("bad") >= least_bad) & (_weight(bad, good) > 1)).where(F.col("term").endswith(" "))
    suspects = {r["term"].strip() for r in mixed_words.orderBy(F.desc("bad"), "term").limit(TERMS).collect()}

    def phrases_of(text: str) -> set[str]:
        words = text.split()
        return {f" {a} {b} " for a, b in zip(words, words[1:]) if a in suspects or b in suspects}

    phrases = _counted(sample, phrases_of).where((F.col("good") >= least_good) & (_weight(bad, good) < 0))
    exceptions = [r["term"] for r in phrases.orderBy(F.desc("good"), "term").limit(TERMS).collect()]

    def terms_beyond(text: str) -> set[str]:
        for phrase in exceptions:
            text = text.replace(phrase, "  ")
        return terms_of(text)

    lexicon = Lexicon(chosen(_counted(sample, terms_beyond) if exceptions else first), exceptions)
    key = lexicon.key

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array([features(t, key) for t in frame["text"]]).reshape(-1, 2)
            yield pd.DataFrame({"total": x[:, 0], "rate": x[:, 1], "y": frame["y"].to_numpy()})

    points = map_frames(sample, measured, "total double, rate double, y int").toPandas()  # two rows per labelled pair at most
    lexicon.curve = curve_of(points[["total", "rate"]].to_numpy(), points["y"].to_numpy())
    return lexicon


def scored(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1."""
    ship_package(docs.sparkSession)
    key, curve = lexicon.key, lexicon.curve

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        x = np.array([features(t, key) for t in text]).reshape(-1, 2)
        z = np.clip(x @ np.array(curve[:2]) + curve[2], -30, 30)
        return pd.Series(1 / (1 + np.exp(-z)))

    return docs.withColumn(name, score(col(text_col)))
