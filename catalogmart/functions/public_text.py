"""Values in their public text form, and digests of relations that rest on it."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_scalars(df: DataFrame) -> DataFrame:
    """Public text form of every column; NULL stays NULL.

    Integral numbers lose their fraction and no number takes an exponent, but one
    with more than 28 decimals (digits are the shortest that denote the double), dates are ISO, instants
    are UTC with a ``Z``. A NaN or infinite number fails the job; a timestamp
    without a zone is refused when the plan is built.
    """
    return df.select(*[_public_text(field.name, field.dataType.typeName()).alias(field.name) for field in df.schema])


def _plain_digits(c: Column, size: Column) -> Column:
    """A number with a fraction, which a cast would write with an exponent."""
    exact = F.when(size < 1, c.cast("decimal(38,28)").cast("string")).otherwise(c.cast("decimal(38,20)").cast("string"))
    return F.when(exact.cast("double") == c.cast("double"), F.rtrim(exact, F.lit("0"))).otherwise(c.cast("string"))


def _public_text(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind == "timestamp_ntz":
        raise ValueError(f"{name} needs an explicit time zone")
    if kind in ("double", "float"):
        # NaN is greater than any number, so the first two tests hold for finite numbers alone.
        whole, size = F.rint(c) == c, F.abs(c)
        return (
            F.when(whole & (size < 2.0**63), c.cast("bigint").cast("string"))
            .when(whole & (size < 1e38), c.cast("double").cast("decimal(38,0)").cast("string"))
            .when(not_finite(c), F.raise_error(F.lit(f"{name} is not finite")).cast("string"))
            .when((size >= 1e-3) & (size < 1e7), c.cast("string"))
            .otherwise(_plain_digits(c, size))
        )
    if kind == "decimal":
        text = c.cast("string")
        trimmed = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
        return F.when(F.instr(text, ".") > 0, trimmed).otherwise(text)
    if kind == "timestamp":
        utc = F.to_utc_timestamp(c, F.current_timezone())
        text = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.concat(F.replace(text, F.lit(".000000"), F.lit("")), F.lit("Z"))
    return c.cast("string")


def not_finite(c: Column) -> Column:
    return F.isnan(c) | (F.abs(c) == float("inf"))


#: Halves of a row hash add up modulo this.
HALF = Decimal(1 << 64)


def multiset_digest(df: DataFrame, key: str = "") -> DataFrame:
    """(row_count, high, low): a digest of the rows of a relation of any size, whatever their order; repeats count.

    A row is hashed as the fields in name order, each `-` if unknown, else its
    length in bytes, `:` and its public text; the two halves of the hash, MD5 with
    the key in front, add up modulo 2^64. Sums combine in the tasks.
    """
    shown = normalize_scalars(df.select(*sorted(df.columns)))
    field = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    digest = F.md5(F.concat(F.lit(key), *[field(F.col(f"`{c}`")) for c in shown.columns]).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(38,0)")
    added = shown.agg(F.count(F.lit(1)).alias("row_count"), F.sum(half(1)).alias("_high"), F.sum(half(17)).alias("_low"))
    whole = lambda c: (F.coalesce(F.col(c), F.lit(0).cast("decimal(38,0)")) % F.lit(HALF).cast("decimal(38,0)")).cast("decimal(20,0)").cast("string")
    return added.select("row_count", whole("_high").alias("high"), whole("_low").alias("low"))
