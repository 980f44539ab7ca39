"""Rounding and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, digits: int) -> Column:
    """Half-to-even rounding on doubles, kept on primitive arithmetic (no BigDecimal per row)."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def steady(total: Column) -> Column:
    """Drop the last-bit noise of a sum of doubles, which depends on the order of partitions.

    Report values are rounded after this; without it a tie could round either way between runs.
    """
    return round_to(total, 6)


def not_nan(value: Column) -> Column:
    """NaN as null."""
    return F.nanvl(value, F.lit(None).cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else 0.0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))
