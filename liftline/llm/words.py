"""Words and word shingles as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SHINGLE = 5


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def shingle_hashes(hashes: str, n: int = SHINGLE) -> Column:
    """One hash per ``n`` words in a row, from a column of word hashes; none if there are fewer words."""
    h = F.col(hashes)
    each = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, n)]))
    return F.slice(each, 1, F.greatest(F.size(h) - (n - 1), F.lit(0)))


def shingles(words_col: str, n: int = SHINGLE) -> Column:
    """The distinct texts of ``n`` words in a row."""
    w = F.col(words_col)
    each = F.transform(w, lambda x, i: F.concat_ws(" ", F.slice(w, i + 1, F.lit(n))))
    return F.array_distinct(F.slice(each, 1, F.greatest(F.size(w) - (n - 1), F.lit(0))))
