"""Column helpers for zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def plus_days(ts: Column, days: int) -> Column:
    """``days`` periods of exactly 24 hours after a TIMESTAMP_NTZ."""
    return ts + F.expr(f"INTERVAL '{int(days)}' DAY")


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours with fractions, exact to the microsecond."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)


def week_label(ts: Column) -> Column:
    """``2024-12-30/2025-01-05``: the Monday-to-Sunday week holding the timestamp."""
    monday = F.trunc(F.to_date(ts), "week")
    return F.concat_ws("/", monday.cast("string"), F.date_add(monday, 6).cast("string"))
