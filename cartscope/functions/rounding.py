"""Rounding and percentage helpers.

The source engine rounds floats half-to-even, so ``bround`` (not ``round``)
is used everywhere. Rates are computed with DOUBLE literals: a SQL ``100.0``
literal is DECIMAL in Spark and would turn the rate into ``decimal(26,1)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def rate_pct(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    """``round(numerator * 100.0 / denominator, digits)`` in DOUBLE."""
    return F.bround(numerator.cast("double") * F.lit(100.0) / denominator, digits)


def ratio_pct(mean: Column, digits: int = 1) -> Column:
    """``round(avg(flag) * 100, digits)`` in DOUBLE."""
    return F.bround(mean * F.lit(100.0), digits)
