"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text becomes counts of terms: character trigrams, trigrams of character shapes (runs of letters as one), words that repeat one of the
words just before, and how varied its words are, hashed to ``DIMENSIONS``. Logarithmic counts are weighted by inverse document frequency
and projected on the ``RANK`` leading singular vectors of the labelled sample. Every document's vector is multiplied
with all labelled vectors, a block of documents at a time, and the ``NEIGHBOURS`` of the largest cosines vote with their label, each
weighing as a power of its cosine.

Learning uses at most ``PER_LABEL`` labelled rows of each class, those with the smallest hashes of their ids, so what is
broadcast is bounded: two matrices of a few megabytes. Scoring covers every row and shuffles nothing.

Defined results: a NULL or empty text has no neighbours and gets the share of label 1 in the sample; ties between neighbours go to
the row that comes first in the sample, ordered by text hash; labels that are NULL do not count; repeated rows are scored alike; other
columns stay; without labels every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from liftline.llm.common import col, ship_package
from liftline.llm.tokens import BASE, mixed, powers

PER_LABEL = 4_000
RANK = 48
NEIGHBOURS = 15
SHAPES, CONTENT, REPEATS, VARIETY = 1024, 1000, 8, 16
DIMENSIONS = SHAPES + CONTENT + REPEATS + VARIETY
#: Characters handled at once.
BLOCK = 1_000_000
#: Votes weigh as the cosine to this power.
SHARPNESS = 4
LETTER_LOWER, LETTER_UPPER, DIGIT, WIDE = 1, 2, 3, 4


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shape and lower-case form of each character up to 0x3000, powers for word hashes and their inverses, hash of shape triples)."""
    shape, lower = np.full(0x3000, WIDE, np.int64), np.arange(0x3000, dtype=np.int64)
    for c in range(0x3000):
        x = chr(c)
        if x.islower() or x.isupper():
            shape[c] = LETTER_LOWER if x.islower() else LETTER_UPPER
            lower[c] = ord(x.lower()[0])
        elif x.isdigit():
            shape[c] = DIGIT
        elif c < 128:
            shape[c] = 5 + c % 64  # each sign by itself
    n = BLOCK + 1
    hashed = (mixed(np.arange(70**3)) % np.uint64(SHAPES)).astype(np.int64)
    return shape, lower, powers(BASE, n), powers(np.uint64(pow(int(BASE), -1, 1 << 64)), n), hashed


def term_counts(texts: list[str]) -> np.ndarray:
    """Counts of the hashed terms, a row per text. Texts are cut where they exceed a block; their counts add up."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    parts: list[str] = []
    owners: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        for k in range(0, max(1, len(text)), BLOCK):
            part = text[k : k + BLOCK]
            if parts and held + len(part) > BLOCK:
                _count(parts, owners, out)
                parts, owners, held = [], [], 0
            parts.append(part)
            owners.append(i)
            held += len(part)
    _count(parts, owners, out)
    return out


def _count(parts: list[str], owners: list[int], out: np.ndarray) -> None:
    whole = "".join(parts)
    if not whole:
        return
    shape_of, lower_of, power, inverse, hashed = _tables()
    chars = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    known = np.minimum(chars, len(shape_of) - 1)  # characters beyond the table have the shape of its last
    shape, lower = shape_of[known], np.where(chars < len(lower_of), lower_of[known], chars)
    n = len(parts)
    counts = np.zeros((n, DIMENSIONS), np.float32)

    def add(rows: np.ndarray, terms: np.ndarray) -> None:
        counts.reshape(-1)[:] += np.bincount(rows * DIMENSIONS + terms, minlength=n * DIMENSIONS)

    # shapes, runs of letters and digits as one
    kept = np.ones(len(chars), bool)
    kept[1:] = (shape[1:] != shape[:-1]) | (shape[1:] > WIDE) | (owner[1:] != owner[:-1])
    s, o = shape[kept], owner[kept]
    if len(s) > 2:
        same = o[2:] == o[:-2]
        add(o[2:][same], hashed[(s[:-2] * 70 + s[1:-1]) * 70 + s[2:]][same])
    if len(lower) > 2:
        same = owner[2:] == owner[:-2]
        code = mixed((lower[:-2] << 42 | lower[1:-1] << 21 | lower[2:])[same]) % np.uint64(CONTENT)
        add(owner[2:][same], SHAPES + code.astype(np.int64))
    # words by their hashes
    blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
    edge = np.ones(len(chars), bool)
    edge[1:] = blank[1:] != blank[:-1]
    edge[1:] |= owner[1:] != owner[:-1]
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(chars))
    word = ~blank[starts]
    starts, ends = starts[word], ends[word]
    if not len(starts):
        out += 0
    else:
        sums = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum(mixed(lower + 1) * power[: len(chars)], out=sums[1:])
        words, o = (sums[ends] - sums[starts]) * inverse[starts], owner[starts]
        for k in range(1, REPEATS + 1):
            again = (words[k:] == words[:-k]) & (o[k:] == o[:-k])
            add(o[k:][again], np.full(int(again.sum()), SHAPES + CONTENT + k - 1))
        total = np.bincount(o, minlength=n)
        different = np.bincount(o[np.unique(mixed(words ^ mixed(o)), return_index=True)[1]], minlength=n)
        some = np.flatnonzero(total)
        share = np.minimum(VARIETY - 1, different[some] / total[some] * VARIETY).astype(np.int64)
        counts[some, SHAPES + CONTENT + REPEATS + share] += total[some]
    np.add.at(out, owners, counts)


@dataclass
class Neighbours:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def share(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.0

    def project(self, counts: np.ndarray) -> np.ndarray:
        return unit(unit(np.log1p(counts) * self.idf) @ self.axes)

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.labels):
            return np.zeros(len(texts))
        out = []
        for k in range(0, len(texts), 512):
            cosine = self.project(term_counts(texts[k : k + 512])) @ self.vectors.T
            m = min(NEIGHBOURS, cosine.shape[1])
            nearest = np.argpartition(-cosine, m - 1, axis=1)[:, :m]
            weight = np.maximum(np.take_along_axis(cosine, nearest, axis=1), 0).astype(float) ** SHARPNESS
            total = weight.sum(axis=1)
            votes = (weight * self.labels[nearest]).sum(axis=1)
            out.append(np.where(total > 0, votes / np.where(total > 0, total, 1), self.share))
        return np.concatenate(out)


def unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(length > 0, length, 1)).astype(np.float32)


def learn(sample: DataFrame, rank: int = RANK) -> Neighbours:
    """Vectors of a bounded frame (text, y); its texts are counted by the executors."""
    ship_package(sample.sparkSession)

    @F.pandas_udf("binary")
    def counted(text: pd.Series) -> pd.Series:
        return pd.Series([x.astype(np.float16).tobytes() for x in np.log1p(term_counts(text.tolist()))])

    rows = sample.orderBy(F.xxhash64("text"), "text").select(counted("text").alias("x"), "y").toPandas()
    labels = rows["y"].to_numpy(float)
    if not len(rows):
        return Neighbours(np.zeros(DIMENSIONS, np.float32), np.zeros((DIMENSIONS, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    logs = np.stack([np.frombuffer(x, np.float16) for x in rows["x"]]).astype(np.float32)
    idf = (np.log((1 + len(logs)) / (1 + (logs > 0).sum(axis=0))) + 1).astype(np.float32)
    weighted = unit(logs * idf)
    values, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    axes = np.ascontiguousarray(vectors[:, ::-1][:, : min(rank, int((values > 1e-9).sum()) or 1)]).astype(np.float32)
    return Neighbours(idf, axes, unit(weighted @ axes), labels)


def scored(docs: DataFrame, model: Neighbours, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by PER_LABEL, DIMENSIONS and RANK

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score([t or "" for t in text]))

    return docs.withColumn(name, score(col(text_col)))
