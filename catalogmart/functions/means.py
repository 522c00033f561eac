"""Means that do not depend on the order in which rows are added up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(30,20)"


def exact(value: Column) -> Column:
    """The value as a decimal, in the shortest form that denotes the double; sums of it commute.

    Holds ten digits before the point, or ANSI mode fails the job, and twenty after it; finer ones are rounded away,
    alike in any order.
    """
    return value.cast(EXACT)


def mean_of(total: Column, count: Column) -> Column:
    """Mean from a sum of ``exact`` values; NULL for an empty group."""
    return F.when(count > 0, total.cast("double") / count.cast("double"))


def exact_mean(value: Column) -> Column:
    """Aggregate: mean of the non-null values."""
    return mean_of(F.sum(exact(value)), F.count(value))
