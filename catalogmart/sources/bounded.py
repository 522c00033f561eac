"""Reads that refuse to exceed their published size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def require_at_most(df: DataFrame, maximum: int, name: str) -> DataFrame:
    """Fail at run time when ``df`` has more than ``maximum`` rows.

    Only ``maximum + 1`` rows are looked at, so the counting window is bounded
    however large a faulty input is.
    """
    counted = df.limit(maximum + 1).withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy()))
    too_many = F.raise_error(F.lit(f"{name} has more than {maximum} rows"))
    return counted.filter(F.when(F.col("_rows") > maximum, too_many.cast("boolean")).otherwise(True)).drop("_rows")


def bounded_select(
    df: DataFrame,
    name: str,
    columns: Sequence[tuple[str, str | Column]],
    order: Sequence[Column] = (),
    where: Column | None = None,
    maximum: int = 1,
) -> DataFrame:
    """Exact columns under public names, in a stated order, never truncated.

    One row more than the maximum is read, so an oversized input fails instead
    of losing rows.
    """
    rows = df if where is None else df.filter(where)
    rows = rows.orderBy(*order) if order else rows
    picked = rows.select(*[(F.col(c) if isinstance(c, str) else c).alias(public) for public, c in columns])
    return require_at_most(picked, maximum, name)
