"""Analytics marts over the curated layer.

Vote floors filter the ratings before any join, and every average sums exact
decimals, so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogmart.functions import rules
from catalogmart.functions.means import exact, exact_mean, mean_of
from catalogmart.operators.joins import sized_join
from catalogmart.operators.ranking import top_per_group, top_rows
from catalogmart.sources.tables import KeptTables

TITLES_SHOWN = 10
YEARS_SHOWN = 10
TITLES_PER_YEAR = 5
PEOPLE_PER_ROLE = 20
RECOMMENDATIONS_PER_REGION = 5


def _rated(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        "movie_id", rules.preferred_rating().alias("avg_rating"), rules.preferred_votes().alias("num_of_votes")
    )


def qualifying(ratings: DataFrame, floor: tuple[int, int]) -> DataFrame:
    """Preferred rating and votes of titles one source admits; the rating may be unknown."""
    return _rated(ratings.filter(rules.either_votes_reach(floor)))


def headline_order():
    return [
        F.col("avg_rating").desc_nulls_last(),
        F.col("num_of_votes").desc_nulls_last(),
        F.col("movie_id").asc(),
    ]


def average_rating_by_genre(genres: DataFrame, ratings: DataFrame) -> DataFrame:
    rated = qualifying(ratings, rules.GENRE_FLOOR)
    joined = sized_join(genres.select("movie_id", "genre_name"), rated, "movie_id")
    return joined.groupBy("genre_name").agg(exact_mean(F.col("avg_rating")).alias("genre_avg_rating"))


def average_runtime_by_genre(genres: DataFrame, movies: DataFrame) -> DataFrame:
    eligible = movies.filter(rules.runtime_eligible(F.col("runtime_min"))).select("movie_id", "runtime_min")
    joined = sized_join(genres.select("movie_id", "genre_name"), eligible, "movie_id")
    return joined.groupBy("genre_name").agg(F.avg("runtime_min").alias("genre_avg_runtime"))


def era_ratings(movies: DataFrame, ratings: DataFrame, least_votes: int = 0) -> DataFrame:
    """Rated titles whose preferred votes reach the floor of their release year, and least_votes.

    The lowest floor of all applies before the join, each year's own after it.
    """
    rated = _rated(ratings.filter(rules.has_rating()))
    dated = movies.filter(F.col("release_year").isNotNull()).select("movie_id", "release_year")
    lowest = max(least_votes, min([rules.ERA_FLOOR_LATEST, *[votes for _, votes in rules.ERA_FLOORS]]))
    joined = sized_join(dated, rated.filter(F.col("num_of_votes") >= lowest), "movie_id")
    return joined.filter(F.col("num_of_votes") >= rules.era_vote_floor(F.col("release_year"))).drop("num_of_votes")


def decade_avg_rating(era: DataFrame) -> DataFrame:
    """Mean rating per decade; years outside the displayed range share a NULL decade."""
    decade = rules.decade_label(F.col("release_year")).alias("decade")
    return era.groupBy(decade).agg(exact_mean(F.col("avg_rating")).alias("decade_avg_rating"))


def no_of_movies_every_decade(movies: DataFrame) -> DataFrame:
    eligible = movies.filter(rules.runtime_eligible(F.col("runtime_min")))
    decades = eligible.select(rules.decade_label(F.col("release_year")).alias("decade")).filter("decade IS NOT NULL")
    return decades.groupBy("decade").agg(F.count(F.lit(1)).alias("movies_made_in_decade"))


def mart_rating_distribution(ratings: DataFrame, floor: tuple[int, int] = rules.DISTRIBUTION_FLOOR) -> DataFrame:
    """Titles per rating bracket with their share of the population that reaches the vote floor."""
    rating = rules.preferred_rating()
    qualified = ratings.filter(rules.either_votes_reach(floor) & rules.has_rating())
    bins = qualified.groupBy(
        rules.bracket_label(rating).alias("rating_bracket"), rules.bracket_order(rating).alias("bucket_order")
    ).agg(F.count(F.lit(1)).alias("movie_count"))
    # Only the aggregated brackets meet in this window.
    total = F.sum("movie_count").over(Window.partitionBy())
    return bins.withColumn("total_no_of_movies", total).select(
        "rating_bracket",
        "bucket_order",
        "movie_count",
        F.round(F.col("movie_count") * 100 / F.col("total_no_of_movies"), 2).alias("percentage_of_movies"),
        "total_no_of_movies",
    )


def mart_top_movies(ratings: DataFrame, movies: DataFrame, kept: KeptTables, k: int = TITLES_SHOWN) -> DataFrame:
    ranked = top_rows(qualifying(ratings, rules.HEADLINE_FLOOR), headline_order(), k, "movie_rank")
    return with_names(ranked, movies, kept).select("movie_id", "movie_name", "avg_rating", "num_of_votes", "movie_rank")


def with_names(ranked: DataFrame, movies: DataFrame, kept: KeptTables) -> DataFrame:
    """Names for a ranked handful of titles; a title without a catalogue row keeps a NULL name.

    ``ranked`` is a top-k result: its k rows are kept, so the ratings are ranked
    once, and broadcasting them is bounded by k. The semi join looks their names
    up without shuffling the catalogue.
    """
    ranked = kept.keep("ranked", ranked)
    names = movies.select("movie_id", "movie_name")
    found = names.join(F.broadcast(ranked.select("movie_id")), "movie_id", "left_semi")
    return ranked.join(found, "movie_id", "left")


def headline_ratings(ratings: DataFrame) -> DataFrame:
    """Rating sum and rated rows per movie id whose credits count for people rankings."""
    return (
        qualifying(ratings, rules.HEADLINE_FLOOR)
        .groupBy("movie_id")
        .agg(F.sum(exact(F.col("avg_rating"))).alias("total"), F.count("avg_rating").alias("rated"))
    )


def headline_titles(movies: DataFrame, headline: DataFrame) -> DataFrame:
    """Their catalogue rows, so a credit meets its title and the title's ratings in a single join."""
    known = movies.select("movie_id", "imdb_id").filter(F.col("imdb_id").isNotNull())
    return sized_join(known, headline, "movie_id")


def eligible_people(credits: DataFrame, headline: DataFrame) -> DataFrame:
    """Mean rating and distinct titles of every person who reaches their role's minimum.

    ``credits`` has ``imdb_id``, ``person_id`` and ``job_role``. The mean weights
    repeated credits. Sums per (person, role, title) come before the sums per
    person, and both start inside the map tasks, so neither a title with very
    many credits nor a very active person gathers raw rows in one task.
    """
    roles = list(rules.ROLE_MINIMUMS)
    named = credits.filter(F.col("job_role").isin(roles) & F.col("person_id").isNotNull())
    per_title = (
        sized_join(named.select("imdb_id", "person_id", "job_role"), headline, "imdb_id")
        .groupBy("person_id", "job_role", "movie_id")
        .agg(F.sum("total").alias("total"), F.sum("rated").alias("rated"))
    )
    per_person = per_title.groupBy("person_id", "job_role").agg(
        mean_of(F.sum("total"), F.sum("rated")).alias("person_rating"), F.count(F.lit(1)).alias("movie_count")
    )
    return per_person.filter(F.col("movie_count") >= rules.role_minimum(F.col("job_role")))


def mart_top_people(
    credits: DataFrame, headline: DataFrame, persons: DataFrame, k: int = PEOPLE_PER_ROLE
) -> DataFrame:
    """Best-rated people per role; a ranked person without a name row leaves a gap."""
    order = [F.col("person_rating").desc_nulls_last(), F.col("person_id").asc()]
    ranked = top_per_group(eligible_people(credits, headline), "job_role", order, k, "job_rank")
    # At most k rows for each of the listed roles.
    return persons.join(F.broadcast(ranked), "person_id").select(
        "person_id", "job_role", "person_rating", "job_rank", "movie_count", "person_name", "birth_year", "death_year"
    )


def mart_top_years(era: DataFrame, k: int = YEARS_SHOWN) -> DataFrame:
    """Best years by rounded mean rating among years with enough distinct titles."""
    per_title = era.groupBy("release_year", "movie_id").agg(
        F.sum(exact(F.col("avg_rating"))).alias("total"), F.count("avg_rating").alias("rated")
    )
    per_year = per_title.groupBy("release_year").agg(
        F.round(mean_of(F.sum("total"), F.sum("rated")), 2).alias("release_yr_avg_rating"),
        F.count(F.lit(1)).alias("movie_count"),
    )
    order = [F.col("release_yr_avg_rating").desc_nulls_last(), F.col("release_year").asc()]
    return per_year.filter(F.col("movie_count") >= TITLES_PER_YEAR).orderBy(*order).limit(k)


def _recommendable(now_playing: DataFrame, ratings: DataFrame) -> DataFrame:
    listed = now_playing.select(
        "movie_id",
        "movie_name",
        "tmdb_region",
        "now_playing_release_date",
        "now_playing_overview",
        "now_playing_popularity",
    )
    return sized_join(listed, qualifying(ratings, rules.RECOMMENDATION_FLOOR), "movie_id")


def mart_now_playing_recommendations(
    now_playing: DataFrame, ratings: DataFrame, k: int = RECOMMENDATIONS_PER_REGION
) -> DataFrame:
    """Best-rated listed titles per region; ties go by votes, popularity, then id.

    A title may be listed on several dates; the listing's own columns order its
    otherwise tied rows.
    """
    order = [
        F.col("avg_rating").desc_nulls_last(),
        F.col("num_of_votes").desc_nulls_last(),
        F.col("now_playing_popularity").desc_nulls_last(),
        F.col("movie_id").asc(),
        *listing_ties(),
    ]
    return top_per_group(_recommendable(now_playing, ratings), "tmdb_region", order, k, "recommendation_rank")


def top_recommended_now_playing_movie(now_playing: DataFrame, ratings: DataFrame) -> DataFrame:
    """First title per region when an unknown value counts as the largest."""
    order = [
        F.col("avg_rating").desc_nulls_first(),
        F.col("num_of_votes").desc_nulls_first(),
        F.col("now_playing_popularity").desc_nulls_first(),
        F.col("movie_id").asc(),
        *listing_ties(),
    ]
    return top_per_group(_recommendable(now_playing, ratings), "tmdb_region", order, 1, "recommendation_rank")


def listing_ties():
    """Order among listing rows of one title."""
    ties = ["now_playing_release_date", "now_playing_overview", "movie_name"]
    return [F.col(c).asc_nulls_first() for c in ties]
