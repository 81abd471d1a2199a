"""Reproducible Poisson(1) weights: the same unit, replicate and seed always give the same weight,
however the data is partitioned or recomputed."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

DRAWS_PER_DIGEST = 4


def poisson_cut_points() -> list[str]:
    """Cumulative Poisson(1) probabilities as 8-digit hexadecimal fractions of 2**32."""
    cuts, total, k = [], 0.0, 0
    while True:
        total += math.exp(-1) / math.factorial(k)
        scaled = round(total * 2**32)
        if scaled >= 2**32:
            return cuts
        cuts.append(f"{scaled:08x}")
        k += 1


def draw_digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *parts))


def digest_draws(digest: Column) -> Column:
    """Four independent uniform draws of a digest, as 8-digit hexadecimal text."""
    return F.array(*[F.substring(digest, 1 + 8 * i, 8) for i in range(DRAWS_PER_DIGEST)])


def has_weight(draw: Column) -> Column:
    return draw >= poisson_cut_points()[0]


def poisson_weight(draw: str) -> Column:
    """Inverse-CDF Poisson(1) weight of a draw; equal-length hexadecimal text compares as numbers."""
    cuts = poisson_cut_points()
    steps = " ".join(f"WHEN {draw} < '{cut}' THEN {k}" for k, cut in enumerate(cuts))
    return F.expr(f"CASE {steps} ELSE {len(cuts)} END")


def hashed_bucket(seed: int, key: Column, buckets: int) -> Column:
    """Bucket number of a key, unrelated to any pattern in the key values."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(buckets)
