"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

A source's words, its documents in seeded order, fall into blocks of equal
length, short enough that the smallest source has many. Seats, one per block of
the mix, go to the sources by their highest quotients target / (2k + 1), never
more than REPEAT times its words to one source; a seat beyond that goes to the
next quotient. The seats of a source are dealt to the shards, and each shard
takes its quota from the source's blocks in turn, after the last one from the
first again. Everything here is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogmart.llm.common import Scratch, unused

WEIGHTS = (5, 2, 1)
#: No source is repeated more often.
REPEAT = 3
#: Blocks of the smallest source that has words, if it has as many words; the block length follows from it.
BLOCKS_PER_SOURCE = 4_096
SHARDS, SEED = 8, 11
#: Hex digits of the ordering hash that cut a source into stretches summed on their own.
STRETCH_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def seeded(seed: int, *parts: Column) -> Column:
    """Ordering hash: MD5 of the seed and the parts; a null part counts as an empty one."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeat: int = REPEAT) -> DataFrame:
    """sources (source, source_size) with rank, weight and target.

    Sources by code point, null last, take the weights in turn and share all
    words; a target stops at repeat times its source's size and the excess is
    shared by weight among the others until none is above.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(order) - 1)
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", turn).withColumn("ceiling", (repeat * F.col("source_size")).cast("double"))
    by_ratio = Window.orderBy(F.col("ceiling") / F.col("weight"), "rank")
    ahead = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole).cast("double")
    level = (total - F.coalesce(F.sum("ceiling").over(ahead), F.lit(0.0))) / F.sum("weight").over(behind)
    ranked = ranked.withColumn("level", level).withColumn("full", F.col("ceiling") < F.col("weight") * F.col("level"))
    share = F.min(F.when(~F.col("full"), F.struct(F.col("ceiling") / F.col("weight"), "rank", "level"))).over(whole)["level"]
    target = F.when(F.col("full"), F.col("ceiling")).otherwise(F.col("weight") * share)
    return ranked.withColumn("target", target).select("source", "rank", "source_size", "weight", "target")


def block_words(sources: DataFrame) -> tuple[int, int, int]:
    """Words of a block, words of all sources, and number of sources."""
    full = F.when(F.col("source_size") > 0, F.col("source_size"))
    facts = sources.agg(F.min(full).alias("least"), F.sum("source_size").alias("total"), F.count("*").alias("n")).first()
    return max(1, (facts["least"] or 0) // BLOCKS_PER_SOURCE), facts["total"] or 0, facts["n"]


def seats(targets: DataFrame, block: int, total_seats: int, total: int, n_sources: int, repeat: int = REPEAT) -> DataFrame:
    """targets with quota: the highest total_seats quotients target / (2k + 1), ties by rank, of a source at most
    repeat times its words.

    With a divisor a little above total / seats every quotient reached is among
    the highest; a little below, all the highest are reached, though full sources
    leave their seats to the others. Only the quotients between the two, a few
    per source, are ranked.
    """
    if total_seats <= 0:
        return targets.withColumn("quota", F.lit(0).cast("long"))
    most = F.floor(repeat * F.col("source_size") / F.lit(block)).cast("long")
    free = targets.agg(F.sum(F.when(F.col("target") < repeat * F.col("source_size") - 2 * block, F.col("target")))).first()[0] or 0
    wide_divisor = total / (total_seats + n_sources / 2 + 1)
    if free:
        wide_divisor = min(wide_divisor, free / (free * total_seats / total + 4 * n_sources + 1))
    sure_divisor = total / (total_seats - n_sources / 2) if total_seats > n_sources / 2 else None
    reached = lambda d: F.least(most, F.floor(F.col("target") / F.lit(d) + 0.5).cast("long"))
    sure = reached(sure_divisor) if sure_divisor else F.lit(0).cast("long")
    ranged = targets.withColumn("sure", sure).withColumn("wide", reached(wide_divisor))
    taken = ranged.agg(F.sum("sure").alias("s")).first()["s"] or 0
    open_ = ranged.where("wide > sure").select("rank", "target", F.explode(F.sequence("sure", F.col("wide") - 1)).alias("k"))
    quotient = F.col("target") / (2 * F.col("k") + 1)
    last = open_.orderBy(quotient.desc(), "rank", "k").limit(max(0, int(total_seats - taken)))
    more = last.groupBy("rank").agg(F.count("*").alias("more"))
    quota = F.col("sure") + F.coalesce("more", F.lit(0))
    return ranged.join(more, "rank", "left").withColumn("quota", quota.cast("long")).drop("sure", "wide", "more")


def shard_quotas(quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """quotas with by_shard: the blocks that each shard takes of the source.

    The seats of all sources form one row, source after source, dealt to the
    shards in turn: shards differ by one block at most, in total and per source.
    """
    ahead = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    based = quotas.withColumn("base", F.coalesce(F.sum("quota").over(ahead), F.lit(0)))
    own = [F.expr(f"(quota + {shards - 1} - pmod({k} - base, {shards})) div {shards}") for k in range(shards)]
    return based.withColumn("by_shard", F.array(*own)).drop("base")


def placed_rows(rows: DataFrame, targets: DataFrame, seed: int, scratch: Scratch) -> DataFrame:
    """rows with the columns of targets and the words of their source up to begin and end of the row, in seeded order."""
    known = scratch.small(targets.withColumnRenamed("source", "s").drop("weight"))
    order = seeded(seed, F.col("doc_id"), F.col("digest"))
    placed = rows.join(known, F.col("source").eqNullSafe(F.col("s"))).withColumn("order", order)
    placed = placed.withColumn("stretch", F.substring("order", 1, STRETCH_DIGITS)).drop("source", "s")
    stretches = placed.groupBy("rank", "stretch").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("rank").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.select(F.col("rank").alias("r"), F.col("stretch").alias("t"), F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("start"))
    within = Window.partitionBy("rank", "stretch").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("upto", F.sum("size").over(within))
    placed = placed.join(starts, (F.col("rank") == F.col("r")) & (F.col("stretch") == F.col("t")))
    return placed.withColumn("end", F.col("start") + F.col("upto")).withColumn("begin", F.col("end") - F.col("size"))


def sized_rows(df: DataFrame, scratch: Scratch, doc_id: str, text: str, source: str) -> tuple[DataFrame, DataFrame]:
    """doc_id, source, size and digest (MD5 of the text) of every row; source and source_size of every source."""
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest")
    rows = scratch.keep(df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), digest))
    return rows, scratch.keep(rows.groupBy("source").agg(F.sum("size").alias("source_size")))


def words_before(place: str) -> str:
    """How many of the first place words, the source's words again and again, are the row's."""
    return f"({place} div source_size * size + greatest(0L, least(size, {place} % source_size - begin)))"


def mix(
    df: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    seed: int = SEED,
    shards: int = SHARDS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """doc_id, size, source_size, target, taken and shard_words of every row.

    taken counts the words of the document that lie in chosen blocks, repeats
    included; shard_words parts them by shard. A source's taken words are its
    quota of whole blocks. A null source is a source of its own, a null text has
    size 0; a mix without words takes nothing. Rows that repeat an id follow the
    hash of their text; rows equal in both follow one another. Further columns
    are ignored.
    """
    scratch = Scratch(df.sparkSession, "mixing")
    rows, sources = sized_rows(df, scratch, doc_id, text, source)
    block, total, n = block_words(sources)
    targets = scratch.keep(source_targets(sources, weights))
    quotas = shard_quotas(scratch.keep(seats(targets, block, total // block, total, n)), shards)
    upto = [F.expr("0L" + "".join(f" + by_shard[{j}]" for j in range(k))) * block for k in range(shards + 1)]
    quotas = scratch.keep(quotas.withColumn("edges", F.array(*upto)).drop("by_shard", "quota"))
    placed = placed_rows(rows, quotas, seed, scratch)
    at_edges = F.when(F.col("source_size") > 0, F.expr(f"transform(edges, e -> {words_before('e')})"))
    placed = placed.withColumn("at_edges", F.coalesce(at_edges, F.expr(f"array_repeat(0L, {shards + 1})")))
    parts = F.expr(f"transform(sequence(1, {shards}), k -> at_edges[k] - at_edges[k - 1])").alias("shard_words")
    return placed.select("doc_id", "size", "source_size", "target", F.col("at_edges")[shards].alias("taken"), parts)


def apply_mix(df: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED, doc_id: str = "doc_id") -> DataFrame:
    """The rows of df as often as the mix takes them, all columns kept; rows without words go.

    Documents stay whole: taken / size is rounded, which changes the one document
    a source at most in which its quota of blocks ends.
    """
    names = unused(df.columns, "id", "times", "copy")
    times = F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int")
    plan = mix(df, weights, seed, doc_id=doc_id).where("size > 0").groupBy(F.col("doc_id").alias(names[0])).agg(times.alias(names[1]))
    kept = df.join(plan.where(F.col(names[1]) > 0), F.col(f"`{doc_id}`").eqNullSafe(F.col(names[0])))
    again = F.explode(F.sequence(F.lit(1), F.col(names[1]))).alias(names[2])
    return kept.select(*[F.col(f"`{c}`") for c in df.columns], again).drop(names[2])
