"""Means that don't depend on the order of their rows.

A sum of doubles depends on the order in which tasks add it up, so a mean on a
rounding edge can come out either way. Here a value is split into its whole part and
its fraction in units of 2^-30, and both are summed as whole numbers: the same result
under any partitioning, mergeable from partial sums, and plain long arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = 1 << 30


def whole_part(c: Column) -> Column:
    return F.floor(c.cast("double")).cast("long")


def fraction_units(c: Column) -> Column:
    """Up to 2^30; a group of 2^33 rows fits a long."""
    d = c.cast("double")
    return F.rint((d - F.floor(d)) * F.lit(float(UNIT))).cast("long")


def mean_of_parts(whole: Column, units: Column, n: Column) -> Column:
    """The mean from sums of both parts; NULL without values."""
    total = whole.cast("double") + units.cast("double") / F.lit(float(UNIT))
    return F.try_divide(total, n)


def exact_mean(c: Column) -> Column:
    """Aggregate: the mean of the non-null values of ``c``."""
    return mean_of_parts(F.sum(whole_part(c)), F.sum(fraction_units(c)), F.count(c))
