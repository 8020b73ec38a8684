"""Small column expressions shared by the jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_MINUTE = 60_000_000


def as_column(value: Column | datetime | str | int | None) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def age_minutes(now: Column, since: Column) -> Column:
    """Whole minutes elapsed, cut off (the health check's age)."""
    elapsed = F.unix_micros(now) - F.unix_micros(since)
    return (elapsed / F.lit(_MICROS_PER_MINUTE)).cast("bigint")


def freshness_minutes(recorded_at: Column, since: Column) -> Column:
    """Minutes elapsed, rounded half up (the operations view's freshness)."""
    elapsed = F.unix_micros(recorded_at) - F.unix_micros(since)
    return F.round(elapsed / F.lit(_MICROS_PER_MINUTE)).cast("bigint")


def mean_money(total: Column, n: Column) -> Column:
    """``total / n`` rounded once to pence.

    ``avg`` of a decimal keeps only four more digits and rounds on the way; a wide
    quotient keeps sixteen, so the rounding to pence sees the exact half.
    """
    quotient = total.cast("decimal(24,2)") / n.cast("decimal(14,0)")
    return F.round(quotient, 2).cast("decimal(14,2)")
