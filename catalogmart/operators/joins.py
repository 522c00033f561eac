"""Join shapes that stay balanced when a key is missing or very frequent, and send no side whole that grows with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.operators.sketches import fits_broadcast, maybe_among, parts_of_hot_keys

#: Values that rows without a key spread over.
SPREAD = 1 << 20


def without(df: DataFrame, ids: DataFrame, key: str, id_filter: DataFrame | None = None) -> DataFrame:
    """Rows whose key is not in the ``ids`` column of the same name; rows with a NULL key stay.

    Given a filter of the ids, rows that it rules out stay where they are; only
    the others meet the ids in the anti join.
    """
    if id_filter is None:
        return df.join(ids, key, "left_anti").select(*df.columns)
    marked = maybe_among(df, id_filter, key)
    surely = marked.filter(~F.col("_maybe")).select(*df.columns)
    left = marked.filter("_maybe").select(*df.columns).join(ids.hint("merge"), key, "left_anti")
    return surely.unionByName(left.select(*df.columns))


def sized_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi join on a column both sides share; the right side is broadcast if it is small in memory, else both are shuffled.

    Left to itself, the planner goes by written bytes and may send either side.
    """
    return left.join(right.hint(_strategy(right)), key, how)


def _strategy(right: DataFrame) -> str:
    return "broadcast" if fits_broadcast(right) else "merge"


def dealt(left: DataFrame, right: DataFrame, key: str, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_part``: rows of a hot key are dealt to its parts in turn, and each part gets its copy of the
    matching rows of the right side. Keys that are not hot have part zero and are not copied.

    ``parts`` (hot_key, parts) is bounded and broadcast.
    """
    few = F.broadcast(parts.select(F.col("hot_key").alias("_hot_key"), F.col("parts").alias("_parts")))
    turn = F.pmod(F.monotonically_increasing_id(), F.col("_parts")).cast("int")
    sided = left.join(few, left[key] == F.col("_hot_key"), "left").withColumn("_part", F.coalesce(turn, F.lit(0)))
    copies = right.join(few, right[key] == F.col("_hot_key"), "left")
    copies = copies.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    return sided.drop("_hot_key", "_parts"), copies.drop("_hot_key", "_parts")


def planned(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame | None, str]:
    """The parts of the left side's hot keys, and how to join; no parts if the right side is broadcast and none does harm."""
    strategy = _strategy(right)
    return None if strategy == "broadcast" else parts_of_hot_keys(left, key), strategy


def balanced_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi join on a column both sides share, whose values may be very frequent on the left.

    A right side small enough to broadcast needs no care. Else hot keys are
    looked for first, and dealt to parts. ``how`` is inner, left or left_semi.
    """
    parts, strategy = planned(left, right, key)
    if parts is None:
        return left.join(right.hint(strategy), key, how)
    sided, copies = dealt(left, right, key, parts)
    return sided.join(copies.hint(strategy), [key, "_part"], how).drop("_part")


def left_join_known(
    left: DataFrame, right: DataFrame, key: str, parts: DataFrame | None = None, strategy: str | None = None
) -> DataFrame:
    """Left equi join on a column both sides share, for keys that are often NULL.

    A NULL key matches nothing, yet hashing sends all such rows to one task. The
    join therefore has a second column: zero for a known key, and for a missing
    one a hash of the row above zero, which spreads the rows and matches nothing.
    The zeros of the right side are computed from its key, or the optimizer would
    fold them into a filter and hash by the key alone. Given the parts of hot
    keys, a hot key has their numbers in place of zero. Without a strategy the
    planner chooses it.
    """
    added = [field.name for field in right.schema if field.name != key]
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(SPREAD)) + 1
    right = right.filter(F.col(key).isNotNull())
    sided, match, part, copy = left, right, F.lit(0), F.pmod(F.xxhash64(key), F.lit(1))
    if parts is not None:
        sided, match = dealt(left, right, key, parts)
        part = copy = F.col("_part")
    sided = sided.withColumn("_spread", F.when(F.col(key).isNull(), spread).otherwise(part))
    known = F.coalesce(F.col(key).cast("string"), F.lit(""))
    sided = sided.withColumn("_key", known)
    match = match.withColumn("_match", copy)
    match = match.withColumn("_known", F.col(key).cast("string")).drop(key)
    match = match.hint(strategy) if strategy else match
    joined = sided.join(match, (sided["_key"] == match["_known"]) & (sided["_spread"] == match["_match"]), "left")
    return joined.select(*left.columns, *added)
