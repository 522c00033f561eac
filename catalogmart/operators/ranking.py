"""Deterministic ranking, top-k and latest-row operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogmart.sources.tables import KeptTables


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order.

    Spark limits each key to its best row inside every map task before the
    shuffle, so a key that holds a large share of the rows sends one row per
    task and no task sorts the whole group.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int, rank: str) -> DataFrame:
    """Best ``k`` rows of every group with their rank; pruned per map task as above."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col(rank) <= k)


def top_rows(df: DataFrame, order: Sequence[Column], k: int, rank: str) -> DataFrame:
    """Best ``k`` rows overall with their rank.

    The limit runs as a per-task top-k and a merge; only ``k`` rows reach the
    unpartitioned window that numbers them.
    """
    best = df.orderBy(*order).limit(k)
    return best.withColumn(rank, F.row_number().over(Window.partitionBy().orderBy(*order)))


def numbered(df: DataFrame, by: str | Sequence[Column], number: str, kept: KeptTables) -> DataFrame:
    """Rows numbered 1..n in a total order, without sorting them in one task.

    Rows spread over ranges of the order, are numbered inside their range, and
    shift by the size of the ranges before it. The ranges are written first:
    a range split computed twice may differ. Only the range sizes, one row per
    partition, meet in one task and are broadcast.
    """
    order = [F.col(by)] if isinstance(by, str) else list(by)
    ranges = kept.keep(number, df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy().orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = ranges.withColumn("_place", place).join(F.broadcast(shifts), "_range")
    return placed.select((F.col("_place") + F.col("_shift")).alias(number), *df.columns)
