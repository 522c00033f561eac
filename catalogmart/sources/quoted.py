"""Quoted CSV read in byte ranges, so that one large file feeds many tasks.

A line break ends a record only outside quotes, and whether a range of a file
begins inside quotes is known from the number of quotes before it. Lines are read
by ranges as Spark splits the file; a narrow pass counts each range's quotes and
its records under either beginning; sums over the ranges of a file tell which
beginning is true and how many records lie before. Records of one line stay
where they are, only those of several lines are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
OPTIONS = {"quote": QUOTE, "escape": QUOTE, "mode": "FAILFAST"}


def _lines(spark: SparkSession, path) -> DataFrame:
    """Every line with its file, the range it begins in, its order there and its quotes; a record's last line has no line end."""
    found = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"),  # ascends within a range, which one task reads
        F.col("value").alias("line"),
    )
    return found.withColumn("quotes", F.char_length("line") - F.char_length(F.replace("line", F.lit(QUOTE), F.lit(""))))


def _quotes_before() -> Column:
    """Quotes of the range before the line."""
    earlier = Window.partitionBy("file", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("quotes").over(earlier), F.lit(0))


def _is_blank() -> Column:
    return F.col("line").isin("", "\r")


def _ranges(lines: DataFrame) -> DataFrame:
    """file_, range_, inside (the range begins inside quotes) and earlier (records that begin in the ranges before), a row per range."""
    narrow = lines.select("file", "range", "at", "quotes", _is_blank().alias("blank")).withColumn("before", _quotes_before())
    begun = lambda rest: F.count_if((F.col("before") % 2 == rest) & ~F.col("blank"))
    sized = narrow.groupBy("file", "range").agg(F.sum("quotes").alias("quotes"), begun(0).alias("even"), begun(1).alias("odd"))
    ahead = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    known = sized.withColumn("inside", F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2)
    begins = F.sum(F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))).over(ahead)
    return known.select(F.col("file").alias("file_"), F.col("range").alias("range_"), "inside", F.coalesce(begins, F.lit(0)).alias("earlier"))


def _misquoted(record: Column) -> Column:
    """Whether a quote stands where no cell begins or ends; then the number of quotes does not tell where records end.

    Between quotes lie, in turn, text outside and inside of them. Outside there is
    nothing (a doubled quote), or whole cells with the separators around them.
    """
    parts = F.split(record, QUOTE, -1)
    outside = F.filter(parts, lambda _, k: k % 2 == 0)
    last = F.size(outside) - 1
    wrong = F.transform(
        outside,
        lambda part, k: (part != "") & (((k > 0) & ~part.startswith(",")) | ((k < last) & ~part.endswith(","))),
    )
    return F.contains(record, F.lit(QUOTE)) & ((F.size(parts) % 2 == 0) | F.exists(wrong, lambda w: w))


def quoted_records(spark: SparkSession, path) -> DataFrame:
    """file, number (from 1 on) and record of every record of the files, header included; blank lines between records are none.

    A line break inside a cell stays as it is. A record in which a quote stands
    inside an unquoted cell, or whose last cell is not closed, fails the read. Blank
    lines inside a cell are text. A compressed file is one range.
    """
    lines = _lines(spark, path)
    placed = lines.join(_ranges(lines), (F.col("file") == F.col("file_")) & (F.col("range") == F.col("range_")))
    within = Window.partitionBy("file", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    begins = ((F.col("inside") + F.col("before")) % 2 == 0) & ~F.col("between")
    known = placed.withColumn("before", _quotes_before())
    known = known.withColumn("between", ((F.col("inside") + F.col("before")) % 2 == 0) & _is_blank())
    known = known.withColumn("begins", begins).withColumn("number", F.col("earlier") + F.count_if("begins").over(within)).where("NOT between")
    single = F.col("begins") & (F.col("quotes") % 2 == 0)
    alone = known.where(single).select("file", "number", F.col("line").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("range", "at", "line")))
    several = known.where(~single).groupBy("file", "number").agg(F.array_join(F.transform(pieces, lambda p: p.line), "\n").alias("record"))
    records = alone.unionAll(several).withColumn("record", F.regexp_replace("record", "\r\\z", ""))
    refused = F.raise_error(F.concat(F.lit("quotes do not enclose cells in record "), F.col("number").cast("string"), F.lit(" of "), F.col("file")))
    return records.select("file", "number", F.when(_misquoted(F.col("record")), refused.cast("string")).otherwise(F.col("record")).alias("record"))


def scan_ranges(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Rows of quoted CSV files with a header, which must name the columns of the schema in their order."""
    records = quoted_records(spark, path)
    names = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(schema))])
    header = F.from_csv(F.ltrim("record", F.lit("﻿")), names.simpleString()[7:-1].replace(":", " "), OPTIONS)
    given = F.transform(F.array(*[F.coalesce(header[f"c{k}"], F.lit("")) for k in range(len(schema))]), F.lower)
    expected = F.array(*[F.lit(name.lower()) for name in schema.names])
    refused = F.raise_error(F.concat(F.lit("header differs from the schema: "), F.col("record")))
    # The header's record is tested where it is dropped, so that no plan can leave the test out.
    is_row = F.when(F.col("number") > 1, F.lit(True)).when(given == expected, F.lit(False)).otherwise(refused.cast("boolean"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return records.where(is_row).select(F.from_csv("record", ddl, OPTIONS).alias("row")).select("row.*")
