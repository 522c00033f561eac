"""Bounded sketches that tell a join beforehand which rows can meet: id filters and heavy hitters.

Both are ordinary mergeable aggregates: partial results combine in the map
tasks, and the result has a stated greatest size, so it may be broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits a filter spends on an id, and the most 64-bit words it may have: 2^20 words are 8 MB.
FILTER_BITS, FILTER_WORDS = 16, 1 << 20
#: A key is hot from this fraction of a task's fair share on.
GRAIN = 8
#: Types whose values take eight bytes of a row.
EIGHT_BYTES = (T.IntegralType, T.FractionalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
#: Keys a heavy-hitter sketch follows for each it may report, and the most that approx_top_k follows.
FOLLOWED, MOST_FOLLOWED = 8, 1_000_000


def row_bytes(df: DataFrame) -> Column:
    """What a row of df takes in memory: eight bytes and eight per column, and the text of values of no fixed size."""
    texts = [F.col(f"`{field.name}`").cast("string") for field in df.schema if not isinstance(field.dataType, EIGHT_BYTES)]
    return sum([F.coalesce(F.octet_length(text), F.lit(0)) for text in texts], F.lit(8 + 8 * len(df.columns)).cast("long"))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether df is small enough to go to the driver and every task, by the planner's threshold.

    The planner estimates written bytes, and columns of ordered or equal values
    are many times larger in memory. So what it would broadcast is measured, in
    one pass over no more written bytes than the threshold.
    """
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > threshold:
        return False
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= threshold


# Id filters --------------------------------------------------------------------
def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _mask(key: Column) -> Column:
    """Four of 64 bits, by a hash of its own."""
    hashed = F.xxhash64(key, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hashed, 6 * k).bitwiseAND(63).cast("int")) for k in range(4)]
    return reduce(Column.bitwiseOR, bits)


def id_filter(ids: DataFrame, key: str, bits: int = FILTER_BITS, most_words: int = FILTER_WORDS) -> DataFrame:
    """(word, bits, words): a Bloom filter of the ids, each in four bits of one 64-bit word.

    The words grow with the number of ids up to most_words; beyond, more rows
    pass that should not, and no row is lost. Built by ``bit_or`` per word.
    """
    wanted = max(1, ids.count() * bits // 64)
    words = min(most_words, 1 << (wanted - 1).bit_length())
    hashed = ids.filter(F.col(key).isNotNull()).select(_word(F.col(key), words).alias("word"), _mask(F.col(key)).alias("mask"))
    return hashed.groupBy("word").agg(F.bit_or("mask").alias("bits")).withColumn("words", F.lit(words))


def maybe_among(df: DataFrame, ids: DataFrame, key: str, column: str = "_maybe") -> DataFrame:
    """df with a flag: false if the key is surely not among the ids of the filter; an unknown key surely is not.

    The filter joins as a broadcast table of its words, at most as many as it was built with.
    """
    first = ids.select("words").first()
    if first is None:
        return df.withColumn(column, F.lit(False))
    held = F.broadcast(ids.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    joined = df.join(held, _word(F.col(key), first["words"]) == F.col("_word"), "left")
    mask = _mask(F.col(key))
    hit = F.col(key).isNotNull() & F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))
    return joined.withColumn(column, hit).drop("_word", "_bits")


# Heavy hitters -----------------------------------------------------------------
def frequent_keys(df: DataFrame, key: str, most: int) -> DataFrame:
    """(hot_key, estimate, total): keys that may hold a 1/most of the rows with a key; at most ``most`` of them.

    One pass over the key column with the frequent-items sketch of
    ``approx_top_k``. It follows FOLLOWED times as many keys as it reports, so
    every key with at least 1/most of the rows is among them.
    """
    followed = min(MOST_FOLLOWED, FOLLOWED * most)
    top = F.expr(f"approx_top_k({key}, {min(most, followed)}, {followed})").alias("top")
    known = df.filter(F.col(key).isNotNull()).select(key)
    found = known.agg(top, F.count(F.lit(1)).alias("total")).select(F.inline("top"), "total")
    return found.select(F.col("item").alias("hot_key"), F.col("count").alias("estimate"), "total")


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """(key, rows) of every key with at least this share of the rows that have a key.

    Candidates come from the sketch; a second pass counts them exactly.
    """
    candidates = frequent_keys(df, key, int(1 / share) + 1)
    rows = df.select(key).join(F.broadcast(candidates), F.col(key) == F.col("hot_key"))
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.first("total").alias("total"))
    return counted.filter(F.col("rows") >= share * F.col("total")).select(key, "rows")


def parts_of_hot_keys(df: DataFrame, key: str, tasks: int | None = None) -> DataFrame | None:
    """(hot_key, parts): into how many parts the rows of each hot key go, in proportion to their number; None without hot keys.

    A part holds about 1/GRAIN of a task's fair share, so that parts of one key
    that meet in a task do no harm. At most GRAIN * tasks keys are hot; this list
    alone passes through the driver.
    """
    spark = df.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = frequent_keys(df, key, GRAIN * tasks)
    parts = F.ceil(F.col("estimate") * GRAIN * tasks / F.col("total")).cast("int")
    hot = found.select("hot_key", parts.alias("parts")).filter("parts > 1")
    rows = hot.toArrow()  # read back as a local table
    return spark.createDataFrame(rows, hot.schema) if rows.num_rows else None
