"""Checks of published result sets; each returns violating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogmart.functions.rules import ROLE_MINIMUMS, TOP_BRACKET, role_minimum
from catalogmart.functions.public_text import normalize_scalars, not_finite
from catalogmart.operators.checks import PERCENTAGE_TOLERANCE
from catalogmart.sources.bounded import require_at_most

SHARE_TOLERANCE = 0.0051
REGIONS = ("IN", "US")
PEOPLE_PER_ROLE = 20
LARGEST_BYTES = 2 << 20


def not_one_row(df: DataFrame, name: str, optional: bool = False) -> DataFrame:
    """The row count when a scalar result has not exactly one row (or none, if optional)."""
    allowed = [0, 1] if optional else [1]
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter(~F.col("row_count").isin(allowed)).select(F.lit(name).alias("dataset"), "row_count")


def repeated_identities(df: DataFrame, identity: str, within: Sequence[str] = ()) -> DataFrame:
    """Identities listed more than once in a list, role or region."""
    counted = df.groupBy(*within, identity).agg(F.count(F.lit(1)).alias("record_count"))
    return counted.filter("record_count > 1")


def broken_ranks(df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), rank: str = "rank") -> DataFrame:
    """Rows whose rank is not 1..n in the stated order; for bounded lists."""
    place = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    return df.withColumn("expected_rank", place).filter(~F.col(rank).eqNullSafe(F.col("expected_rank")))


def population_chain(qualifying: DataFrame, rated: DataFrame, total: DataFrame) -> DataFrame:
    """The three one-row counts unless qualifying <= rated <= total.

    Each argument has one column; a missing qualifying row counts as zero.
    """
    parts = [("qualifying", qualifying), ("rated", rated), ("total", total)]
    tagged = [df.select(F.lit(n).alias("part"), F.col(df.columns[0]).cast("bigint").alias("n")) for n, df in parts]
    rows = reduce(DataFrame.unionByName, tagged)
    chain = rows.agg(*[F.coalesce(F.max(F.when(F.col("part") == n, F.col("n"))), F.lit(0)).alias(n) for n, _ in parts])
    return chain.filter("qualifying > rated OR rated > total")


def bin_issues(bins: DataFrame, population: int | None = None) -> DataFrame:
    """Findings on public bins: (issue, bracket); the bracket is NULL for whole-list findings.

    ``population`` is the published denominator where one is given apart from
    the bins; the bins' own ``population_count`` must agree with it.
    """
    share = F.col("movie_count") * 100 / F.col("population_count")
    wrong_label = F.col("bracket") != F.concat(
        F.col("order").cast("string"), F.lit("-"), (F.col("order") + 1).cast("string")
    )
    row_tests = {
        "label": wrong_label,
        "order": ~F.col("order").between(0, TOP_BRACKET),
        "share": F.when(F.col("population_count") > 0, F.abs(F.col("percentage") - share) > SHARE_TOLERANCE),
        "unexpected_bin": F.col("population_count") == 0,
    }
    found = [F.when(test, F.lit(name)) for name, test in row_tests.items()]
    per_row = bins.select(F.explode(F.array_compact(F.array(*found))).alias("issue"), "bracket")
    repeated = [
        bins.groupBy(c).agg(F.count(F.lit(1)).alias("n"), F.min("bracket").alias("first")).filter("n > 1").select(
            F.lit(f"repeated_{c}").alias("issue"), F.col("first").alias("bracket")
        )
        for c in ("order", "bracket")
    ]
    totals = bins.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("movie_count").alias("counted"),
        F.sum("percentage").alias("percent"),
        F.min("population_count").alias("low"),
        F.max("population_count").alias("high"),
    )
    published = F.lit(population) if population is not None else F.coalesce(F.col("high"), F.lit(0))
    list_tests = {
        "population": (F.col("n") > 0) & ((F.col("low") != F.col("high")) | (F.col("high") != published)),
        "count_sum": F.coalesce(F.col("counted"), F.lit(0)) != published,
        "percentage_sum": (published > 0) & (F.abs(F.col("percent") - 100) > PERCENTAGE_TOLERANCE),
    }
    found = [F.when(test, F.lit(name)) for name, test in list_tests.items()]
    per_list = totals.select(
        F.explode(F.array_compact(F.array(*found))).alias("issue"), F.lit(None).cast("string").alias("bracket")
    )
    return reduce(DataFrame.unionByName, [per_row, *repeated, per_list])


def role_limit_issues(
    people: DataFrame, minimums: Mapping[str, int] = ROLE_MINIMUMS, limit: int = PEOPLE_PER_ROLE
) -> DataFrame:
    """Per role: rows beyond the list limit and people below the role minimum."""
    below = F.col("movie_count") < role_minimum(F.col("role"), dict(minimums))
    per_role = people.groupBy("role").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(below, 1)).alias("below_minimum")
    )
    return per_role.filter((F.col("rows") > limit) | (F.col("below_minimum") > 0))


def region_coverage_issues(
    counts: DataFrame, recommendations: DataFrame, regions: Sequence[str] = REGIONS
) -> DataFrame:
    """Missing, unknown, empty or over-recommended regions."""
    listed = recommendations.groupBy("region").agg(F.count(F.lit(1)).alias("recommended"))
    names = F.explode(F.array(*[F.lit(r) for r in regions]))
    expected = counts.sparkSession.range(1).select(names.alias("region"), F.lit(True).alias("expected"))
    joined = counts.join(listed, "region", "full_outer").join(expected, "region", "full_outer")
    movies, recommended = F.col("movie_count"), F.coalesce(F.col("recommended"), F.lit(0))
    issue = (
        F.when(F.col("expected").isNull(), "unsupported_region")
        .when(movies.isNull(), "missing_region")
        .when(movies < 1, "no_titles")
        .when(recommended > movies, "too_many_recommendations")
    )
    return joined.select("region", issue.alias("issue")).filter("issue IS NOT NULL")


def capture_evidence(now_playing: DataFrame) -> DataFrame:
    """Capture dates and row counts per region."""
    return now_playing.groupBy(F.col("tmdb_region").alias("region")).agg(
        F.min("snapshot_date").alias("min_capture_date"),
        F.max("snapshot_date").alias("max_capture_date"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("tmdb_id").alias("unique_movie_count"),
        F.count("snapshot_date").alias("capture_date_count"),
    )


def capture_issues(evidence: DataFrame, counts: DataFrame, regions: Sequence[str] = REGIONS) -> DataFrame:
    """Regions whose rows, distinct ids, dates and published count disagree, or that mix dates.

    An expected region without evidence or count, and one that is not expected, disagree as well.
    """
    names = F.explode(F.array(*[F.lit(r) for r in regions]))
    expected = evidence.sparkSession.range(1).select(names.alias("region"), F.lit(True).alias("expected"))
    joined = evidence.join(counts, "region", "full_outer").join(expected, "region", "full_outer")
    reconciled = (
        F.col("expected").isNotNull()
        & (F.col("row_count") > 0)
        & (F.col("row_count") == F.col("unique_movie_count"))
        & (F.col("row_count") == F.col("capture_date_count"))
        & F.col("row_count").eqNullSafe(F.col("movie_count"))
    )
    single_date = F.coalesce(F.col("min_capture_date") == F.col("max_capture_date"), F.lit(False))
    return joined.select(
        "region",
        (~F.coalesce(reconciled, F.lit(False))).alias("counts_disagree"),
        (~single_date).alias("dates_disagree"),
    ).filter("counts_disagree OR dates_disagree")


def latest_mismatch(latest: DataFrame, evidence: DataFrame) -> DataFrame:
    """Published latest date and region maximum, when they differ.

    Both inputs are one column of at most a few dates.
    """
    dates = latest.select(F.col(latest.columns[0]).alias("latest"), F.lit(None).cast("date").alias("captured"))
    captures = evidence.select(F.lit(None).cast("date").alias("latest"), F.col("max_capture_date").alias("captured"))
    both = dates.unionByName(captures).agg(F.max("latest").alias("latest"), F.max("captured").alias("captured"))
    return both.filter(~F.col("latest").eqNullSafe(F.col("captured")))


def impossible_dates(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is no calendar date in ``yyyy-MM-dd`` form; NULL is allowed."""
    text = F.col(column)
    strict = text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull()
    return df.filter(text.isNotNull() & ~F.coalesce(strict, F.lit(False)))


def instant(column: str) -> Column:
    """Timestamp text with an explicit zone as an instant; NULL without a zone or when impossible."""
    text = F.col(column)
    return F.when(text.rlike(r"(Z|[+-]\d{2}:\d{2})$"), text.try_cast("timestamp"))


def sequence_issues(df: DataFrame, completed: str, exported: str) -> DataFrame:
    """Rows with an unreadable instant or an export before its completion."""
    done, out = instant(completed), instant(exported)
    issue = F.when(done.isNull() | out.isNull(), "unreadable").when(done > out, "out_of_order")
    return df.withColumn("issue", issue).filter("issue IS NOT NULL")


class FieldRule(NamedTuple):
    """Constraint of one public field; type, bounds, lengths and patterns are optional.

    An ``integer`` has no fraction; a ``finite`` number is neither NaN nor infinite.
    """

    field: str
    nullable: bool = False
    integer: bool = False
    finite: bool = False
    low: float | None = None
    high: float | None = None
    values: tuple | None = None
    pattern: str | None = None
    min_length: int | None = None
    max_length: int | None = None

    def broken(self) -> dict[str, Column]:
        """Name and test of every constraint; a NULL value breaks only ``required``."""
        c = F.col(self.field)
        tests = {}
        if not self.nullable:
            tests["required"] = c.isNull()
        if self.integer:
            tests["integer"] = ~F.coalesce(F.rint(c.try_cast("double")) == c.try_cast("double"), c.isNull())
        if self.finite or self.integer:
            tests["finite"] = not_finite(c.try_cast("double"))
        if self.low is not None:
            tests["minimum"] = c < self.low
        if self.high is not None:
            tests["maximum"] = c > self.high
        if self.values is not None:
            tests["enum"] = ~c.isin(list(self.values))
        if self.pattern is not None:
            tests["pattern"] = ~c.rlike(self.pattern)
        if self.min_length is not None:
            tests["min_length"] = F.length(c) < self.min_length
        if self.max_length is not None:
            tests["max_length"] = F.length(c) > self.max_length
        return tests


def field_rule_issues(df: DataFrame, rules: Sequence[FieldRule]) -> DataFrame:
    """(field, rule, value) of every broken constraint, in one pass.

    The columns must be exactly the ruled fields.
    """
    names = [rule.field for rule in rules]
    if sorted(names) != sorted(df.columns):
        raise ValueError(f"columns {df.columns} are not the contract's {names}")
    cells = [
        F.when(
            test,
            F.struct(
                F.lit(rule.field).alias("field"),
                F.lit(name).alias("rule"),
                F.col(rule.field).cast("string").alias("value"),
            ),
        )
        for rule in rules
        for name, test in rule.broken().items()
    ]
    return df.select(F.inline(F.array_compact(F.array(*cells))))


def public_cells(df: DataFrame, name: str) -> DataFrame:
    """(result, field, value) of every cell of a result set, in public text form."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in df.columns])
    return normalize_scalars(df).select(F.lit(name).alias("result"), F.inline(cells))


def non_finite_rows(df: DataFrame, identity: str, columns: Sequence[str]) -> DataFrame:
    """(identity, column) of every NaN or infinite value."""
    cells = [F.when(not_finite(F.col(c).cast("double")), F.lit(c)) for c in columns]
    return df.select(identity, F.explode(F.array_compact(F.array(*cells))).alias("invalid_column"))


def fingerprint(df: DataFrame, maximum: int, max_bytes: int = LARGEST_BYTES) -> DataFrame:
    """SHA-256 over the sorted JSON rows of a public result of at most ``maximum`` rows and ``max_bytes`` bytes.

    Keys are in name order and row order does not matter, so an unchanged
    rebuild has an unchanged fingerprint. The rows meet in one aggregate, hence
    the bounds: a larger result fails.
    """
    row = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    rows = F.sort_array(F.collect_list(row))
    bounded = require_at_most(df, maximum, "fingerprinted result")
    text = bounded.agg(F.concat_ws("\n", rows).alias("_text"), F.count(F.lit(1)).alias("row_count"))
    too_long = F.raise_error(F.lit(f"fingerprinted result has more than {max_bytes} bytes"))
    digest = F.when(F.octet_length("_text") > max_bytes, too_long.cast("string")).otherwise(F.sha2("_text", 256))
    return text.select(digest.alias("sha256"), "row_count")
