"""Sums and means.

The type of a column decides: decimals are summed as decimals, which is exact, doubles as
doubles, which keeps every magnitude and never fails on a single large value. The last
digits of a sum of doubles depend on how rows were split over tasks; a report rounds its
final result with ``settled``.

NaN is no reading: it is left out of sums, means and counts of readings alike. Infinity is
a number like any other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GUARD_PLACES = 12  # what lies behind is noise of binary sums


def given(value: Column) -> Column:
    """The value, null where it is NaN."""
    return F.when(~F.isnan(value), value)


def finite(value: Column) -> Column:
    """The value, null where it is NaN or infinite."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def total(amount: Column) -> Column:
    """Sum as double."""
    return F.sum(given(amount)).cast("double")


def line_total(quantity: Column, price: Column) -> Column:
    """Sum of quantity times price as double."""
    return total(quantity * price)


def mean(value: Column) -> Column:
    """Sum divided by the number of values it has, as double; null without any."""
    return total(value) / F.count(given(value))


def settled(value: Column, places: int = 6) -> Column:
    """A final result in ``places`` decimals, half up in decimal (a binary 2.675 is read as the
    2.675 it was written as)."""
    return F.round(F.round(value.cast("double"), GUARD_PLACES), places)


def round_2dp(value: Column) -> Column:
    return settled(value, 2)


def mean_2dp(value: Column) -> Column:
    """Mean rounded half up to two places."""
    return round_2dp(mean(value))
