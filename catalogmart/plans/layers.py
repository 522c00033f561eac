"""Loading the raw layer and building the curated and analytics layers as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from catalogmart.operators.contract import REGIONS
from catalogmart.plans import declared
from catalogmart.plans.build import Catalogue
from catalogmart.sources.payloads import enrichment_gaps, flatten_listing, listing_faults
from catalogmart.sources.readers import scan_raw
from catalogmart.sources.tables import Buckets, IncompleteLoadError, LayerTables, ensure_database, guarded_replace

STAGING = (
    "stg_name_basics",
    "stg_title_akas",
    "stg_title_basics",
    "stg_title_crew",
    "stg_title_principals",
    "stg_title_ratings",
    "stg_details",
    "stg_genres",
    "stg_now_playing",
)
CURATED = (
    "dim_movies",
    "dim_person",
    "dim_genre",
    "bridge_movie_genres",
    "bridge_movie_people",
    "fct_movie_ratings",
    "fct_now_playing",
)
ANALYTICS = (
    "average_rating_by_genre",
    "average_runtime_by_genre",
    "decade_avg_rating",
    "no_of_movies_every_decade",
    "mart_rating_distribution",
    "mart_top_movies",
    "mart_top_people",
    "mart_top_years",
    "mart_now_playing_recommendations",
    "average_runtime",
    "avg_movie_rating",
    "highest_rated_movie",
    "most_popular_movie",
    "latest_now_playing_snapshot",
    "number_of_movies_now_playing",
    "rated_movies",
    "top_recommended_now_playing_movie",
    "top_rated_genre",
    "total_genres",
    "total_movies",
)
# Few rows per movie id, so buckets stay even; credits are not among them, a title may have very many.
JOINED_BY_MOVIE = ("dim_movies", "fct_movie_ratings", "bridge_movie_genres")


def load_raw(
    spark: SparkSession,
    landed: Mapping[str, str],
    database: str,
    folder: str,
    partitions: int | None = None,
    in_ranges: bool = False,
) -> dict[str, DataFrame]:
    """Replace raw tables from landed files, each only after its own load has rows; ``in_ranges`` splits quoted files too.

    Replacement is atomic per table: a failing file leaves its table and those
    after it on their previous rows.
    """
    ensure_database(spark, database, folder)
    return {
        relation: guarded_replace(
            scan_raw(spark, relation, path, partitions, in_ranges), f"{database}.{relation}", f"{folder}/{relation}"
        )
        for relation, path in landed.items()
    }


def replace_details(listing: DataFrame, details: DataFrame, table: str, folder: str) -> DataFrame:
    """Replace the detail rows only when every listed title has one."""
    if not enrichment_gaps(listing, details).isEmpty():
        raise IncompleteLoadError(f"listed titles without details; {table} was left unchanged")
    return guarded_replace(details, table, folder)


def replace_listing(
    pages: DataFrame, snapshot_date: Column, table: str, folder: str, regions: Sequence[str] = REGIONS
) -> DataFrame:
    """Replace the listing rows only by a whole listing of the regions: every page landed, readable and numbered."""
    faults = listing_faults(pages, regions).orderBy("region", "issue", "first_page").limit(5).collect()
    if faults:
        named = "; ".join(f"{r['region']}: {r['issue']}" + (f" {r['first_page']}-{r['last_page']}" if r["first_page"] else "") for r in faults)
        raise IncompleteLoadError(f"{table} was left unchanged, the listing is not whole: {named}")
    return guarded_replace(flatten_listing(pages, snapshot_date), table, folder)


def build_layers(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    folder: str,
    curated: str = "curated",
    analytics: str = "analytics",
    buckets: int | None = None,
) -> Catalogue:
    """Build everything: staging as views, curated and analytics as replaced tables, independent ones side by side.

    The returned catalogue reads the written tables, so tests and public results
    that follow see what was published; what writing them has counted stands in
    its ``kept.observed``. With ``buckets`` the relations that meet
    on the movie id are bucketed by it, and the marts join them without a
    shuffle; count one bucket per few hundred megabytes of the largest of them.
    """
    databases = {**dict.fromkeys(CURATED, curated), **dict.fromkeys(ANALYTICS, analytics)}
    layout = dict.fromkeys(JOINED_BY_MOVIE, Buckets("movie_id", buckets)) if buckets else None
    built = Catalogue(spark, raw, LayerTables(spark, databases, folder, layout, declared.watched()))
    for name in STAGING:
        getattr(built, name).createOrReplaceTempView(name)
    built.build(databases)
    return built
