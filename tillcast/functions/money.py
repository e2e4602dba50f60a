"""Exact decimal arithmetic. Nothing here passes through a double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(12,2)"
TOTAL = "decimal(20,2)"
SHARE = "decimal(7,2)"
# Money in the source log counts tens of roubles.
SOURCE_UNIT = 10


def price(money: Column, multiplier: Column) -> Column:
    return (money * SOURCE_UNIT * multiplier).cast(AMOUNT)


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Null instead of an error when the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0).cast("int"))


def ratio_2dp(total: Column, count: Column) -> Column:
    """``total / count`` rounded half away from zero to kopecks."""
    return F.round(safe_div(total.cast(TOTAL), count), 2).cast(TOTAL)


def mean_16dp(total: Column, count: Column) -> Column:
    """Average with 16 decimals. ``decimal(20,2) / decimal(13,0)`` has scale 16,
    so the quotient is rounded once."""
    return safe_div(total.cast(TOTAL), count.cast("decimal(13,0)")).cast("decimal(38,16)")


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage with two decimals. Both sides are narrowed first: wider sums
    would leave the quotient too few digits to round from."""
    percent = part.cast(TOTAL) * F.lit(100).cast("decimal(4,1)")
    return F.round(safe_div(percent, whole.cast(TOTAL)), 2).cast(SHARE)
