"""Secrets in texts: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Base spans come from three patterns. The models are two first-order character chains, trained on labelled samples of tokens taken
from the corpus itself: strings inside base spans are labelled random, words and identifiers outside of them that no
pattern touches are labelled ordinary. Each class is a bounded sample (``SAMPLE`` tokens, those of the
smallest hashes, so it does not depend on the order of rows); every text is scored. Every token of 16 or more
characters, whatever it holds and whatever base spans it touches, becomes a span of the kind ``markov`` when its
log-likelihood ratio per transition exceeds ``THRESHOLD``. A chain learns only from what the corpus has; with no
sample of one class the ratio is zero and nothing is added.

All of it is column expressions. Positions come from splitting a text by the pattern that also extracts the matches: the lengths
of both, in code points, add up to where each match starts.

Defined results: one row per input row; a NULL or empty text has no spans; positions count code points and ends are
exclusive; spans are ordered by start, then assign, access, hex, markov; repeated rows give repeated rows; ids
may be NULL; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from liftline.llm.common import texts, written

#: The base patterns; a case-insensitive group lists both cases of each letter.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
KINDS = ("assign", "access", "hex", "markov")
#: What the chains judge, and their alphabet in natural order; 0 stands for any other character.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1
SAMPLE = 20_000
THRESHOLD = 0.5
#: Ordinary tokens shorter than this say little about transitions.
ORDINARY_CHARS = 6

#: Rows whose words make the ordinary sample: those of the smallest text hashes.
SAMPLE_TEXTS = 2_000

SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"
#: Fixed parts of the base patterns with the least length, where a length may stand in the pattern: a greedy run
#: is too short as a whole or not at all.
PATTERNS = {
    "assign": ASSIGN,
    "access": "AKIA[A-Z0-9]{%d,}" % (ACCESS_CHARS - 4),
    "hex": "[0-9a-f]{%d,}" % HEX_CHARS,
    "markov": TOKEN,
}


def _placed(matches: str, kind: str) -> Column:
    """Spans of the already extracted ``matches`` of a kind: gaps between them and their own lengths add up."""
    gaps = F.split(F.col("text"), PATTERNS[kind])
    zipped = F.zip_with(gaps, F.col(matches), lambda gap, value: F.struct(F.char_length(gap).alias("gap"), value.alias("value")))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["gap"]
        end = begin + F.coalesce(F.char_length(piece["value"]), F.lit(0))
        span = F.struct(
            begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), piece["value"].alias("value")
        )
        spans = F.when(piece["value"].isNotNull(), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    empty = F.array().cast(SPAN)
    found = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda state: state["spans"])
    return F.when(F.size(matches) > 0, found).otherwise(empty)


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, base, token) of rows (doc_id, text): spans of the three base kinds, and every token long enough to judge."""
    found = docs.select(
        "doc_id", "text", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in PATTERNS.items()]
    )
    placed = found.select("doc_id", F.xxhash64("text").alias("tie"), *[_placed(f"m_{k}", k).alias(k) for k in PATTERNS])
    base = placed.withColumn(
        "assign", F.filter("assign", lambda x: F.char_length(F.regexp_extract(x["value"], ASSIGN, 2)) >= ASSIGN_CHARS)
    ).withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    return base.select("doc_id", "tie", "base", F.col("markov").alias("token"))


def _bounded(tokens: DataFrame) -> DataFrame:
    """The ``SAMPLE`` different tokens of the smallest hashes."""
    return tokens.distinct().orderBy(F.xxhash64("value"), "value").limit(SAMPLE)


def random_sample(found: DataFrame) -> DataFrame:
    """Strings of base spans; of an assignment what stands after the sign."""
    value = F.when(F.col("x.rank") == 0, F.regexp_extract("x.value", ASSIGN, 2)).otherwise(F.col("x.value"))
    return _bounded(found.select(F.explode("base").alias("x")).select(value.alias("value")))


def ordinary_sample(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Words and identifiers of a bounded number of texts, less what the base spans hold."""
    some = found.select("tie").distinct().orderBy("tie").limit(SAMPLE_TEXTS)
    chosen = docs.join(F.broadcast(some), F.xxhash64("text") == F.col("tie"), "left_semi")
    bare = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), PATTERNS["access"] + "|" + PATTERNS["hex"], " ")
    words = F.regexp_extract_all(bare, F.lit("[A-Za-z_][A-Za-z0-9_]{%d,}" % (ORDINARY_CHARS - 1)), F.lit(0))
    return _bounded(chosen.select(F.explode(words).alias("value")))


def _symbols(value: Column) -> Column:
    return F.transform(F.split(value, ""), lambda c: F.call_function("locate", c, F.lit(ALPHABET)) )


def transition_counts(tokens: DataFrame) -> dict[tuple[int, int], int]:
    """How often one symbol follows another: at most as many pairs as the square of the alphabet."""
    pairs = tokens.select(_symbols(F.col("value")).alias("s")).select(
        F.explode(F.arrays_zip(F.col("s").alias("a"), F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))).alias("b"))).alias("p")
    )
    counted = pairs.where("p.b IS NOT NULL").groupBy("p.a", "p.b").count()
    return {(r["a"], r["b"]): r["count"] for r in counted.collect()}


def log_ratios(random: dict, ordinary: dict) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) at a * SYMBOLS + b, each chain smoothed by one of each pair."""
    if not random or not ordinary:
        return [0.0] * SYMBOLS**2
    after = [{a: sum(n for (x, _), n in chain.items() if x == a) for a in range(SYMBOLS)} for chain in (random, ordinary)]
    log = lambda chain, rows, a, b: math.log((chain.get((a, b), 0) + 1) / (rows[a] + SYMBOLS))
    return [log(random, after[0], a, b) - log(ordinary, after[1], a, b) for a in range(SYMBOLS) for b in range(SYMBOLS)]


def ratio(value: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a token, per transition."""
    # one literal, folded by the optimiser: an array of a fixed size
    ratios = F.split(F.lit(" ".join(map(repr, table))), " ").cast("array<double>")
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))

    def step(state: Column, symbol: Column) -> Column:
        gain = F.when(state["last"] == 0, 0.0).otherwise(F.get(ratios, state["last"] * SYMBOLS + symbol))
        return F.struct(symbol.alias("last"), (state["sum"] + gain).alias("sum"))

    total = F.aggregate(_symbols(value), start, step, lambda state: state["sum"])
    return total / F.greatest(F.char_length(value) - 1, F.lit(1))


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added, spans) of each row: ``base`` and ``added`` as structs, ``spans`` as text."""
    rows = texts(docs, id_col, text_col)
    found = written(scanned(rows), "secret-spans")
    table = log_ratios(transition_counts(random_sample(found)), transition_counts(ordinary_sample(rows, found)))
    judged = found.withColumn("added", F.filter("token", lambda x: ratio(x["value"], table) > THRESHOLD))
    return judged.select("doc_id", "base", "added", _joined(F.array_sort(F.concat("base", "added"))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans."""
    count = lambda k: F.size(F.filter("base", lambda x: x["rank"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), "spans")
