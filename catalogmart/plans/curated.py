"""Curated star schema: dimensions, bridges and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogmart.functions.rules import CATALOGUE_TYPES, FALLBACK_ID_PREFIX, FALLBACK_TYPE
from catalogmart.functions.text import comma_elements, named_tags
from catalogmart.operators.joins import balanced_join, left_join_known, planned, sized_join
from catalogmart.operators.ranking import numbered
from catalogmart.sources.tables import KeptTables


def catalogue_titles(titles: DataFrame) -> DataFrame:
    """Staged titles that are films and have no end year."""
    return titles.filter(F.col("content_type").isin(*CATALOGUE_TYPES) & F.col("end_year").isNull())


def _fallback_id() -> Column:
    return F.concat(F.lit(FALLBACK_ID_PREFIX), F.col("tmdb_id").cast("string"))


def dim_movies(details: DataFrame, titles: DataFrame, kept: KeptTables) -> DataFrame:
    """Both sources merged on the shared id: every title and every detail row, once per match.

    A full outer join would hash all detail rows without an id, and all rows of
    a frequent id, to one task each, and Spark cannot split that join type.
    The same result is a left join from the details, whose frequent ids are
    dealt to parts, and the titles no detail links to. Both branches read
    the two narrow inputs from kept tables, so each is excluded once.
    """
    listed = catalogue_titles(titles).select(
        "imdb_id",
        F.col("imdb_id").alias("title_id"),
        "primary_title",
        "original_title",
        "is_adult",
        "start_year",
        "runtime_min",
        "content_type",
    )
    detail = details.select("imdb_id", "tmdb_id", "movie_title", "tmdb_release_date", "tmdb_runtime_min")
    listed, detail = kept.keep("catalogue_titles", listed), kept.keep("catalogue_details", detail)
    with_details = left_join_known(detail, listed, "imdb_id", *planned(detail, listed, "imdb_id"))
    linked_ids = detail.filter(F.col("imdb_id").isNotNull()).select("imdb_id").distinct()
    title_only = sized_join(listed, linked_ids, "imdb_id", "left_anti")
    merged = with_details.unionByName(title_only, allowMissingColumns=True)
    return merged.select(
        F.coalesce("title_id", _fallback_id()).alias("movie_id"),
        "imdb_id",
        "tmdb_id",
        F.coalesce("primary_title", "movie_title").alias("movie_name"),
        F.col("original_title").alias("imdb_original_title"),
        F.col("movie_title").alias("tmdb_movie_title"),
        "is_adult",
        F.coalesce("start_year", F.year("tmdb_release_date")).alias("release_year"),
        F.coalesce("runtime_min", "tmdb_runtime_min").alias("runtime_min"),
        F.coalesce("content_type", F.lit(FALLBACK_TYPE)).alias("content_type"),
    )


def dim_person(names: DataFrame) -> DataFrame:
    return names.select("person_id", F.col("primary_name").alias("person_name"), "birth_year", "death_year")


def dim_genre(titles: DataFrame, kept: KeptTables) -> DataFrame:
    """Distinct genres of all staged titles, numbered by name."""
    names = titles.select(F.explode(comma_elements(F.col("genres"))).alias("genre_name")).distinct()
    return numbered(names, "genre_name", "genre_id", kept)


def bridge_movie_genres(titles: DataFrame, details: DataFrame) -> DataFrame:
    """(movie, genre, source) rows; a title known to the first source uses only its genres there."""
    listed = catalogue_titles(titles)
    imdb = listed.select(
        F.col("imdb_id").alias("movie_id"),
        F.explode(comma_elements(F.col("genres"))).alias("genre_name"),
        F.lit("imdb").alias("genre_source"),
    )
    tagged = details.filter(F.col("tmdb_genres").isNotNull())
    linked = sized_join(tagged.filter(F.col("imdb_id").isNotNull()), listed.select("imdb_id"), "imdb_id", "left_anti")
    unlinked = tagged.filter(F.col("imdb_id").isNull())
    tags = F.explode(named_tags(F.col("tmdb_genres"), strict=True)).alias("tag")
    tmdb = (
        linked.select("tmdb_id", "tmdb_genres")
        .unionByName(unlinked.select("tmdb_id", "tmdb_genres"))
        .select(_fallback_id().alias("movie_id"), tags)
        .select("movie_id", F.col("tag.name").alias("genre_name"), F.lit("tmdb").alias("genre_source"))
    )
    return imdb.unionByName(tmdb)


def bridge_movie_people(movies: DataFrame, principals: DataFrame) -> DataFrame:
    """Credits of catalogue titles; a credit without a person is dropped."""
    credits = principals.filter(F.col("person_id").isNotNull())
    keyed = movies.filter(F.col("imdb_id").isNotNull()).select("movie_id", "imdb_id")
    return balanced_join(credits, keyed, "imdb_id").select(
        "movie_id", "imdb_id", "principal_order", "person_id", "job_role", "specific_job"
    )


def fct_movie_ratings(movies: DataFrame, ratings: DataFrame, details: DataFrame) -> DataFrame:
    """Ratings and votes of both sources per catalogue row.

    Most rows know one source only; each join spreads the rows without its key
    and deals those of a hot key. The three inputs are read once each, but for
    the keys among which hot ones are sought when ratings are too many to broadcast.
    """
    second = details.select("tmdb_id", "tmdb_avg_rating", F.col("tmdb_num_votes").alias("tmdb_num_of_votes"))
    first = ratings.select(
        "imdb_id", F.col("avg_rating").alias("imdb_avg_rating"), F.col("num_of_votes").alias("imdb_num_of_votes")
    )
    ids = movies.select("movie_id", "imdb_id", "tmdb_id")
    with_second = left_join_known(ids, second, "tmdb_id", *planned(ids, second, "tmdb_id"))
    rated = left_join_known(with_second, first, "imdb_id", *planned(ids, first, "imdb_id"))
    return rated.select(
        "movie_id",
        "imdb_id",
        "tmdb_id",
        "imdb_avg_rating",
        "imdb_num_of_votes",
        "tmdb_avg_rating",
        "tmdb_num_of_votes",
        F.col("imdb_avg_rating").isNotNull().alias("has_imdb_ratings"),
        F.col("tmdb_avg_rating").isNotNull().alias("has_tmdb_ratings"),
    )


def fct_now_playing(now_playing: DataFrame, movies: DataFrame) -> DataFrame:
    """Listing rows with their catalogue identity, falling back to the listing's own."""
    known = movies.filter(F.col("tmdb_id").isNotNull()).select("tmdb_id", "movie_id", "imdb_id", "movie_name")
    joined = sized_join(now_playing, known, "tmdb_id", "left")
    return joined.select(
        F.coalesce("movie_id", _fallback_id()).alias("movie_id"),
        "imdb_id",
        "tmdb_id",
        F.coalesce("movie_name", "movie_title").alias("movie_name"),
        "now_playing_release_date",
        "now_playing_overview",
        "now_playing_poster_path",
        "now_playing_popularity",
        "tmdb_region",
        "snapshot_date",
    )
