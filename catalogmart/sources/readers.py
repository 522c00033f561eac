"""Scans of landed files with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogmart.sources.quoted import OPTIONS, scan_ranges
from catalogmart.sources.schemas import RAW_SCHEMAS, TSV_RELATIONS


#: Whole-number columns land with their fraction, to be refused rather than cut.
LANDED_WHOLE = T.DecimalType(38, 18)


def _whole(field: T.StructField):
    c = F.col(field.name)
    refused = F.raise_error(F.concat(F.lit(f"{field.name} is no whole number: "), c.cast("string")))
    return F.when(c == F.floor(c), c).when(c.isNotNull(), refused.cast(LANDED_WHOLE)).cast(field.dataType)


def scan_tsv(spark: SparkSession, path, schema: str, partitions: int | None = None) -> DataFrame:
    r"""Tab-separated file(s) with a header; ``\N`` is NULL and quotes are data.

    A header that names other columns, or the same ones in another order, fails the read.

    A gzip member is one input split, so a bulk file is decompressed by a single
    task. Pass ``partitions`` to spread its rows before wide work; a folder of
    many parts needs none.
    """
    df = spark.read.csv(
        path, schema=schema, sep="\t", header=True, nullValue="\\N", quote="", escape="", mode="FAILFAST",
        enforceSchema=False,
    )
    return df.repartition(partitions) if partitions else df


def scan_csv(spark: SparkSession, path, schema: str, partitions: int | None = None, in_ranges: bool = False) -> DataFrame:
    """Quoted CSV whose cells may hold JSON, doubled quotes and line breaks.

    Whole numbers may be written with a zero fraction, as writers do for columns
    that hold gaps; any other fraction fails the read, as does a header that
    differs from the schema. A quoted line break rules out splitting a file at any line, so
    each file is one task; ``partitions`` works as for ``scan_tsv``. With ``in_ranges`` a
    file is read by many tasks, as ``sources.quoted`` tells, and quotes must enclose whole cells.
    """
    target = T.StructType.fromDDL(schema)
    whole = [field.name for field in target if isinstance(field.dataType, T.IntegralType)]
    landed = T.StructType(
        [T.StructField(f.name, LANDED_WHOLE if f.name in whole else f.dataType) for f in target]
    )
    if in_ranges:
        df = scan_ranges(spark, path, landed)
    else:
        df = spark.read.csv(path, schema=landed, header=True, multiLine=True, enforceSchema=False, **OPTIONS)
    df = df.select(*[(_whole(f) if f.name in whole else F.col(f.name)).alias(f.name) for f in target])
    return df.repartition(partitions) if partitions else df


def scan_raw(spark: SparkSession, relation: str, path, partitions: int | None = None, in_ranges: bool = False) -> DataFrame:
    """Scan one of the nine raw relations in its landed format; tab-separated files are read in ranges anyway."""
    schema = RAW_SCHEMAS[relation]
    if relation in TSV_RELATIONS:
        return scan_tsv(spark, path, schema, partitions)
    return scan_csv(spark, path, schema, partitions, in_ranges)
