"""Tolerant numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_or_zero(c: Column, kind: str) -> Column:
    """0 for a missing or unreadable number."""
    return F.coalesce(c.try_cast(kind), F.lit(0).cast(kind))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    """top / bottom, and 0 where the bottom is not positive."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def ratio_or_null(top: Column, bottom: Column) -> Column:
    return F.when(bottom != 0, top / bottom)


def varies(x: str) -> Column:
    """Aggregate: does the series have two different values? Asked of the values,
    as a merged variance of equal values need not come out as exactly 0."""
    return F.min(x) < F.max(x)


def safe_corr(x: str, y: str) -> Column:
    """Pearson correlation as an aggregate; NULL for a constant series."""
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when(varies(x) & varies(y), r)
