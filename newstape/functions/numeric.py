"""Numeric column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_even(value: Column, places: int) -> Column:
    """Round half to even, which is what the published figures use."""
    return F.bround(value, places)


def null_if_nan(value: Column) -> Column:
    """NaN never enters a table: it becomes NULL."""
    return F.when(~F.isnan(value), value)


def pct_change(current: Column, previous: Column) -> Column:
    """``current / previous - 1``; signed infinity from a zero base, NULL for 0 to 0."""
    unbounded = F.when(current > 0, F.lit(float("inf"))).when(current < 0, F.lit(float("-inf")))
    return F.when(previous != 0, F.try_divide(current, previous) - 1).when(previous == 0, unbounded)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is NULL for a zero denominator."""
    return F.try_divide(numerator, denominator)
