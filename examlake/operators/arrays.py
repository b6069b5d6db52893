"""Reductions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def mean(values: Column) -> Column:
    return total(values) / F.size(values)


def share(values: Column, hit) -> Column:
    """Share of the values for which hit holds."""
    return F.size(F.filter(values, hit)) / F.size(values)


def levels(values: Column, step: float) -> Column:
    """Distinct values after rounding down to steps."""
    return F.size(F.array_distinct(F.transform(values, lambda x: F.floor(x / step))))
