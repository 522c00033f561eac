"""Data-quality checks: each returns the violating rows, so empty means pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalogmart.functions.rules import RATING_LIMITS, TOP_BRACKET
from catalogmart.functions.text import has_token, is_label
from catalogmart.operators.exclusion import ExcludedIds
from catalogmart.operators.joins import balanced_join

PERCENTAGE_TOLERANCE = 0.051


def counted(
    found: Mapping[str, DataFrame],
    label: str,
    tallied: Sequence[DataFrame] = (),
    names: Sequence[str] = (),
    given: Mapping[str, int] = {},
) -> DataFrame:
    """(label, violations) of every check by name, counted together in one aggregate; zero for those without any.

    ``tallied`` holds (label, n) rows of further checks, whose names are given;
    ``given`` are checks already counted.
    """
    start = dict.fromkeys([*found, *names], 0) | given
    some = next(iter([*found.values(), *tallied]))
    none = stated(some.sparkSession, start, label, "n")
    rows = [df.select(F.lit(name).alias(label), F.lit(1).cast("bigint").alias("n")) for name, df in found.items()]
    return reduce(DataFrame.unionAll, [*rows, *tallied], none).groupBy(label).agg(F.sum("n").alias("violations"))


def stated(spark: SparkSession, counts: Mapping[str, int], label: str, n: str) -> DataFrame:
    """A row per count that is already known."""
    row = lambda name, count: F.struct(F.lit(name).alias(label), F.lit(count).cast("bigint").alias(n))
    return spark.range(1).select(F.inline(F.array(*[row(*item) for item in counts.items()])))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is unknown."""
    return df.filter(F.col(column).isNull())


def column_counts(
    df: DataFrame, known: Mapping[str, str], unique: Mapping[str, str], keys: Mapping[str, Sequence[str]], label: str
) -> DataFrame:
    """(label, n): violations of the column tests of a relation, by test name, in parts to be summed.

    ``known`` columns must hold a value, the known values of a ``unique`` column
    and the composite ``keys``, unknown parts included, must not repeat. All
    tests meet in one grouping by (test, key): a relation is read once and has one
    exchange, however many tests it has. Rows without a fault of a ``known``
    column add nothing to it.
    """
    entry = lambda name, key: F.struct(F.lit(name).alias(label), key.alias("key"))
    held = [F.when(F.col(column).isNull(), entry(name, F.lit(None).cast("string"))) for name, column in known.items()]
    held += [F.when(F.col(column).isNotNull(), entry(name, F.col(column).cast("string"))) for name, column in unique.items()]
    held += [entry(name, F.to_json(F.struct(*columns))) for name, columns in keys.items()]
    rows = df.select(F.inline(F.array_compact(F.array(*held))))
    grouped = rows.groupBy(label, "key").agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(label, F.when(F.col("key").isNull(), F.col("n")).otherwise((F.col("n") > 1).cast("bigint")).alias("n"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("record_count")).filter("record_count > 1")


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values of a column that occur more than once."""
    return repeated_keys(df.filter(F.col(column).isNotNull()), [column])


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Non-null values outside the accepted list, with their count."""
    outside = df.filter(~F.col(column).isin(list(accepted)))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("record_count"))


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows whose non-null foreign key has no parent."""
    known = child.filter(F.col(column).isNotNull())
    keys = parent.select(F.col(field).alias("_parent")).distinct()
    return known.join(keys, known[column] == keys["_parent"], "left_anti")


def _long_violations(df: DataFrame, identity: str, columns: Sequence[str], invalid) -> DataFrame:
    """(identity, column, value) for every invalid cell, in one pass over ``df``."""
    cells = [
        F.when(invalid(F.col(c)), F.struct(F.lit(c).alias("invalid_column"), F.col(c).alias("invalid_value")))
        for c in columns
    ]
    return df.select(identity, F.inline(F.array_compact(F.array(*cells))))


def outside_range(
    df: DataFrame, identity: str, columns: Sequence[str], limits: tuple[float, float] = RATING_LIMITS
) -> DataFrame:
    """Known values outside the limits."""
    return _long_violations(df, identity, columns, lambda c: ~c.between(*limits))


def negative_values(df: DataFrame, identity: str, columns: Sequence[str]) -> DataFrame:
    """Known values below zero."""
    return _long_violations(df, identity, columns, lambda c: c < 0)


def label_occurrences(relations: Mapping[str, DataFrame], label: str, column: str = "genre_name") -> DataFrame:
    """Rows of any relation that still carry an excluded label."""
    hits = [
        df.filter(is_label(F.col(column), label)).select(F.lit(name).alias("model_name"), column)
        for name, df in relations.items()
    ]
    return reduce(DataFrame.unionByName, hits)


def excluded_occurrences(relations: Mapping[str, DataFrame], excluded: ExcludedIds) -> DataFrame:
    """Rows of any relation that still hold an excluded id of either source.

    Matching on "either id" would pair every row with every excluded id, so all
    relations together meet each id set in one hash semi join, in which a
    frequent id is dealt to many tasks. A row caught by both ids shows up twice.
    """
    columns = ["model_name", "imdb_id", "tmdb_id"]
    listed = []
    for name, df in relations.items():
        imdb = F.col("imdb_id") if "imdb_id" in df.columns else F.lit(None).cast("string")
        tmdb = F.col("tmdb_id") if "tmdb_id" in df.columns else F.lit(None).cast("bigint")
        listed.append(df.select(F.lit(name).alias("model_name"), imdb.alias("imdb_id"), tmdb.alias("tmdb_id")))
    ids = reduce(DataFrame.unionByName, listed)
    found = []
    for column, wanted in (("imdb_id", excluded.imdb), ("tmdb_id", excluded.tmdb)):
        known = ids.filter(F.col(column).isNotNull())
        found.append(balanced_join(known, wanted.select(column), column, "left_semi").select(columns))
    return found[0].unionByName(found[1])


def misranked_rows(
    df: DataFrame, list_name: str, rank: str, order: Sequence[Column], within: Sequence[str] = ()
) -> DataFrame:
    """Stored ranks that differ from the row number the order gives.

    Meant for published rank lists, which are bounded per group.
    """
    expected = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    listed = F.lit(list_name).alias("list_name")
    ranks = df.select(listed, F.col(rank).alias("actual_rank"), expected.alias("expected_rank"))
    return ranks.filter("actual_rank <> expected_rank")


def histogram_issues(bins: DataFrame) -> DataFrame:
    """(finding, bucket_order) of every broken invariant of a rating histogram; whole-list findings have no bucket.

    A bin is one of the ten, is named after its bounds and holds between none and
    all of the population; bins do not repeat, name one population, and add up to
    it and to 100 percent.
    """
    low, count, population = F.col("bucket_order"), F.col("movie_count"), F.col("total_no_of_movies")
    names = F.array(*[F.lit(f"{k}-{k + 1}") for k in range(TOP_BRACKET + 1)])
    own = F.when(low.between(0, TOP_BRACKET), F.element_at(names, low + 1))
    of_bin = {
        "no_such_bin": own.isNull(),
        "misnamed": own.isNotNull() & ~own.eqNullSafe(F.col("rating_bracket")),
        "count_out_of_bounds": ~count.between(0, population),
    }
    per_bin = bins.select(
        F.explode(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in of_bin.items()]))).alias("finding"),
        low.alias("bucket_order"),
    )
    whole = bins.agg(
        F.sum(count).alias("counted"),
        F.sum("percentage_of_movies").alias("percent"),
        F.collect_set(population).alias("populations"),
        (F.count("rating_bracket") - F.count_distinct("rating_bracket")).alias("surplus"),
        F.max(population).alias("largest"),
    )
    of_list = {
        "repeated_bins": F.col("surplus") > 0,
        "several_populations": F.size("populations") > 1,
        "counts_do_not_add_up": F.col("counted") != F.col("largest"),
        "percentages_do_not_add_up": F.abs(F.col("percent") - 100) > PERCENTAGE_TOLERANCE,
    }
    per_list = whole.select(
        F.explode(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in of_list.items()]))).alias("finding"),
        F.lit(None).cast("int").alias("bucket_order"),
    )
    return per_bin.unionByName(per_list)


def mismatched_tokens(cases: DataFrame, token: str, text: str = "genres", expected: str = "expected") -> DataFrame:
    """Cases where the token predicate disagrees with the expected answer."""
    return cases.filter(has_token(F.col(text), token) != F.col(expected))
