"""Rounding and ratios with the result types of exact numerics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, digits: int) -> Column:
    """Half away from zero on a decimal, never on the binary double."""
    return F.round(x.cast("decimal(28,8)"), digits).cast(f"decimal(18,{digits})")


def ratio(num: Column, den: Column, digits: int, scale: float = 1.0) -> Column:
    """``num / den`` rounded; NULL where the denominator is zero."""
    value = num.cast("double")
    if scale != 1.0:
        value = value * scale
    return rounded(value / F.nullif(den.cast("double"), F.lit(0.0)), digits)


def percent(num: Column, den: Column, digits: int = 1) -> Column:
    return ratio(num, den, digits, 100.0)
