"""Line dedup: lines that many documents share stay in one document only.

Normalised lines are hashed, the documents of each hash are counted, and a line
over the threshold goes from all documents but the last one that holds it; the
others are put together again by position. Everything here is DataFrame
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import Scratch

#: A line counts from this many code points on, and goes if at least so many documents hold it.
MIN_LENGTH, MIN_DOCUMENTS = 40, 5
#: A key with at least this share of all occurrences is hot; there can be no more than 1 / HOT of them.
HOT = 1 / 2_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "\t\n\x0b\x0c\r "


def body(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(body(text), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A to Z in lower case."""
    bare = F.trim(line, F.lit(_BLANKS))
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def occurrences(df: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, row (MD5 of the text), position and hash (MD5 of the key) of every line whose key is long enough."""
    digest = lambda c: F.unhex(F.md5(c.cast("binary")))
    rows = df.select("doc_id", digest(body(F.col("text"))).alias("row"), F.posexplode(lines_of(F.col("text"))).alias("position", "line"))
    long_enough = rows.where(F.octet_length("line") >= min_length).select("doc_id", "row", "position", line_key(F.col("line")).alias("key"))
    return long_enough.where(F.char_length("key") >= min_length).select("doc_id", "row", "position", digest(F.col("key")).alias("hash"))


def shared_lines(found: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """hash, lines, documents and keeper (largest doc_id) of every key that enough documents hold.

    A hash's documents are counted in two steps, so that a key of very many documents spreads over all tasks.
    """
    held = found.groupBy("hash", "doc_id").agg(F.count("*").alias("lines"))
    counted = held.groupBy("hash").agg(F.sum("lines").alias("lines"), F.count("*").alias("documents"), F.max("doc_id").alias("keeper"))
    return counted.where(F.col("documents") >= min_documents)


def dropped_lines(found: DataFrame, shared: DataFrame, hot: float = HOT) -> DataFrame:
    """doc_id, row and position of the lines that go; found and shared are written tables.

    Hot keys, few by the definition of HOT, are broadcast, and their lines take
    no part in the shuffle of the others.
    """
    least = found.count() * hot
    few = F.broadcast(shared.where(F.col("lines") >= least).select(F.col("hash").alias("h"), F.col("keeper").alias("hot_keeper"), F.lit(True).alias("is_hot")))
    marked = found.join(few, F.col("hash") == F.col("h"), "left").drop("h")
    from_hot = marked.where("is_hot AND NOT doc_id <=> hot_keeper")
    rest = shared.where(F.col("lines") < least).select("hash", "keeper")
    from_rest = marked.where("is_hot IS NULL").join(rest, "hash").where("NOT doc_id <=> keeper")
    places = ["doc_id", "row", "position"]
    return from_hot.select(*places).unionAll(from_rest.select(*places))


def dedup_lines(
    df: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped and text (what stays, joined by line breaks) of every row.

    A null or empty text is one empty line. Rows that repeat an id are one
    document for counting; each of them loses or keeps its lines. A null id
    counts as a document of its own and is the smallest; further columns are
    ignored.
    """
    scratch = Scratch(df.sparkSession, "line_dedup")
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = scratch.keep(occurrences(rows, min_length))
    shared = scratch.keep(shared_lines(found, min_documents))
    going = dropped_lines(found, shared).groupBy(F.col("doc_id").alias("id"), F.col("row").alias("of")).agg(F.collect_set("position").alias("going"))
    going = scratch.keep(going)
    placed = rows.select("doc_id", F.unhex(F.md5(body(F.col("text")).cast("binary"))).alias("row"), body(F.col("text")).alias("body"))
    joined = placed.join(going, (F.col("row") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    counted = joined.select("doc_id", "body", "going", lines_of(F.col("body")).alias("lines"))
    staying = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "going")
    left = F.array_join(F.transform(staying, lambda k: F.get("lines", k)), "\n")
    return counted.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("going"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("going").isNull(), F.col("body")).otherwise(left).alias("text"),
    )


def digest_lines(kept: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every row of dedup_lines."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
