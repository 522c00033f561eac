"""Table operators behind the charts: dense spines, leaders, slices, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogmart.functions.rules import DECADE_COUNT, FIRST_DECADE, TOP_BRACKET
from catalogmart.operators.contract import not_finite
from catalogmart.operators.ranking import numbered
from catalogmart.plans.public import LARGEST
from catalogmart.sources.bounded import require_at_most
from catalogmart.sources.tables import KeptTables

CHART_PEOPLE = 10
STALE_DAYS = 8


def dense_histogram(bins: DataFrame) -> DataFrame:
    """All ten brackets, empty ones with zero; no rows when the population is empty."""
    spine = bins.sparkSession.range(TOP_BRACKET + 1).select(F.col("id").cast("int").alias("order"))
    low = F.col("order").cast("string")
    population = F.max("population_count").over(Window.partitionBy())
    filled = spine.join(bins, "order", "left").withColumn("_population", population).filter("_population > 0")
    return filled.select(
        F.coalesce("bracket", F.concat(low, F.lit("-"), (F.col("order") + 1).cast("string"))).alias("bracket"),
        "order",
        F.coalesce("movie_count", F.lit(0)).alias("movie_count"),
        F.coalesce("percentage", F.lit(0.0)).alias("percentage"),
    )


def dense_decades(decades: DataFrame, value: str) -> DataFrame:
    """All displayed decades, missing ones with NULL; no rows when no decade is known."""
    start = F.lit(FIRST_DECADE) + F.col("id") * 10
    spine = decades.sparkSession.range(DECADE_COUNT).select(F.concat(start.cast("string"), F.lit("s")).alias("decade"))
    known = decades.select("decade", value, F.lit(1).alias("_known"))
    filled = spine.join(known, "decade", "left").withColumn("_any", F.count("_known").over(Window.partitionBy()))
    return filled.filter("_any > 0").select("decade", value)


def leaders(rows: DataFrame, value: str, maximum: int = max(LARGEST.values())) -> DataFrame:
    """All rows of a published list that share the largest known, finite value.

    Fails beyond the largest published list, so the window that holds them is bounded.
    """
    known = F.when(~not_finite(F.col(value).cast("double")), F.col(value))
    best = F.max(known).over(Window.partitionBy())
    bounded = require_at_most(rows, maximum, "list")
    return bounded.withColumn("_best", best).filter(F.col(value) == F.col("_best")).drop("_best")


def coverage_ratio(rated: DataFrame, total: DataFrame) -> DataFrame:
    """Rated share of all titles in percent with one decimal; NULL for an empty catalogue."""
    sides = rated.select(F.col(rated.columns[0]).alias("rated"), F.lit(None).cast("bigint").alias("total")).unionByName(
        total.select(F.lit(None).cast("bigint").alias("rated"), F.col(total.columns[0]).alias("total"))
    )
    both = sides.agg(F.max("rated").alias("rated_movies"), F.max("total").alias("total_movies"))
    percent = F.round(F.col("rated_movies") * 100 / F.col("total_movies"), 1)
    return both.withColumn("coverage_percent", F.when(F.col("total_movies") > 0, percent))


def freshness(captures: DataFrame, completed: Column, now: Column, days: int = STALE_DAYS) -> DataFrame:
    """Per region, whether the build or its capture is older than the grace period.

    The build's age counts exact hours, a capture's age UTC calendar days.
    """
    build_age = F.unix_timestamp(now) - F.unix_timestamp(completed)
    today = F.to_utc_timestamp(now, F.current_timezone()).cast("date")
    return captures.select(
        "region",
        F.col("max_capture_date").alias("capture_date"),
        (build_age > days * 24 * 3600).alias("build_stale"),
        (F.datediff(today, "max_capture_date") > days).alias("capture_stale"),
    )


def people_for_role(people: DataFrame, role: str, charted_only: bool = False) -> DataFrame:
    """One role's list; the chart shows its first ten."""
    listed = people.filter(F.col("role") == role)
    return listed.filter(F.col("rank") <= CHART_PEOPLE) if charted_only else listed


def region_view(recommendations: DataFrame, counts: DataFrame, captures: DataFrame, region: str) -> DataFrame:
    """One region's recommendations with its title count and capture date.

    A region without recommendations yields one row with NULL title fields.
    """
    here = F.col("region") == region
    facts = counts.filter(here).join(
        captures.filter(here).select("region", F.col("max_capture_date").alias("capture_date")), "region", "left"
    )
    return facts.join(recommendations.filter(here), "region", "left")


def genre_order(rows: DataFrame, value: str) -> DataFrame:
    """Chart order: value descending with unknown last, name ascending, with its position."""
    order = [F.col(value).desc_nulls_last(), F.col("genre").asc()]
    placed = numbered(rows, order, "position", KeptTables(rows.sparkSession))
    return placed.select(*rows.columns, F.col("position").cast("int").alias("position"))


def shared_leader(highest: DataFrame, most_voted: DataFrame) -> DataFrame:
    """Whether the highest-rated and the most-voted title are the same; one row."""
    sides = highest.select(F.lit("rated").alias("side"), "movie_id").unionByName(
        most_voted.select(F.lit("voted").alias("side"), "movie_id")
    )
    ids = sides.agg(
        F.max(F.when(F.col("side") == "rated", F.col("movie_id"))).alias("highest_rated_id"),
        F.max(F.when(F.col("side") == "voted", F.col("movie_id"))).alias("most_voted_id"),
    )
    return ids.withColumn(
        "shared_leader", F.coalesce(F.col("highest_rated_id") == F.col("most_voted_id"), F.lit(False))
    )
