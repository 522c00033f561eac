"""Staging: renamed, cleaned raw relations without excluded titles.

All are lazy projections over one scan, with an anti join on the title id.
``projected`` gives a relation without exclusion: the curated layer joins some
on ids that are already free of excluded titles, where a second exclusion of the
largest relations would change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.functions.rules import UNKNOWN_NAME
from catalogmart.functions.text import clean_name, is_label
from catalogmart.operators.exclusion import EXCLUDED_LABEL, ExcludedIds
from catalogmart.operators.joins import without
from catalogmart.operators.ranking import best_per_key

# Staged column -> raw column.
COLUMNS = {
    "name_basics": {
        "person_id": "nconst",
        "primary_name": "primaryname",
        "birth_year": "birthyear",
        "death_year": "deathyear",
        "primary_professions": "primaryprofession",
        "known_for_titles": "knownfortitles",
    },
    "title_akas": {
        "imdb_id": "titleid",
        "alternate_title_order": "ordering",
        "alternate_title": "title",
        "region": "region",
        "language": "language",
        "alternate_title_type": "types",
        "alternate_title_attributes": "attributes",
        "is_original_title": "isoriginaltitle",
    },
    "title_basics": {
        "imdb_id": "tconst",
        "content_type": "titletype",
        "primary_title": "primarytitle",
        "original_title": "originaltitle",
        "is_adult": "isadult",
        "start_year": "startyear",
        "end_year": "endyear",
        "runtime_min": "runtimeminutes",
        "genres": "genres",
    },
    "title_crew": {"imdb_id": "tconst", "all_director_ids": "directors", "all_writer_ids": "writers"},
    "title_principals": {
        "imdb_id": "tconst",
        "principal_order": "ordering",
        "person_id": "nconst",
        "job_role": "category",
        "specific_job": "job",
        "characters_played": "characters",
    },
    "title_ratings": {"imdb_id": "tconst", "avg_rating": "averagerating", "num_of_votes": "numvotes"},
    "details": {
        "tmdb_id": "id",
        "imdb_id": "imdb_id",
        "movie_title": "title",
        "budget": "budget",
        "revenue": "revenue",
        "tmdb_release_date": "release_date",
        "tmdb_runtime_min": "runtime",
        "tmdb_status": "status",
        "original_language": "original_language",
        "origin_country": "origin_country",
        "production_countries": "production_countries",
        "production_companies": "production_companies",
        "tmdb_genres": "genres",
        "tmdb_avg_rating": "vote_average",
        "tmdb_num_votes": "vote_count",
        "tmdb_poster_path": "poster_path",
    },
    "genres": {"tmdb_genre_id": "id", "genre_name": "name"},
    "now_playing": {
        "tmdb_id": "id",
        "movie_title": "title",
        "now_playing_release_date": "release_date",
        "now_playing_avg_rating": "vote_average",
        "now_playing_num_votes": "vote_count",
        "tmdb_genre_ids": "genre_ids",
        "now_playing_overview": "overview",
        "now_playing_poster_path": "poster_path",
        "now_playing_popularity": "popularity",
        "tmdb_region": "region",
        "snapshot_date": "snapshot_date",
    },
}


def projected(relation: str, raw: DataFrame) -> DataFrame:
    """A raw relation under its staged column names, nothing excluded."""
    return raw.select(*[F.col(name).alias(staged) for staged, name in COLUMNS[relation].items()])


def staged_titles(relation: str, raw: DataFrame, excluded: ExcludedIds) -> DataFrame:
    """A first-source relation without excluded titles; titles of every type stay."""
    return without(projected(relation, raw), excluded.imdb, "imdb_id", excluded.imdb_filter)


def stg_name_basics(raw: DataFrame) -> DataFrame:
    return projected("name_basics", raw).withColumn("primary_name", clean_name(F.col("primary_name"), UNKNOWN_NAME))


def stg_details(raw: DataFrame, excluded: ExcludedIds) -> DataFrame:
    return without(projected("details", raw), excluded.tmdb, "tmdb_id", excluded.tmdb_filter)


def stg_genres(raw: DataFrame, label: str = EXCLUDED_LABEL) -> DataFrame:
    """Genre dictionary without the excluded label; unnamed entries stay."""
    return projected("genres", raw.filter(~F.coalesce(is_label(F.col("name"), label), F.lit(False))))


def stg_now_playing(raw: DataFrame, excluded: ExcludedIds) -> DataFrame:
    """One listing row per title, region and capture date: the most popular, then most voted.

    An unknown value sorts first, as the largest. The remaining columns break
    full ties so reruns agree. Exclusion goes by title, so whole keys leave and
    it may follow the ranking: the per-task limit then sits below the first
    shuffle, which a large exclusion set would otherwise place by title alone.
    """
    order = [F.col("popularity").desc_nulls_first(), F.col("vote_count").desc_nulls_first()]
    ties = ["title", "release_date", "vote_average", "genre_ids", "overview", "poster_path"]
    best = best_per_key(raw, ["id", "region", "snapshot_date"], order + [F.col(c).asc_nulls_first() for c in ties])
    return without(projected("now_playing", best), excluded.tmdb, "tmdb_id", excluded.tmdb_filter)
