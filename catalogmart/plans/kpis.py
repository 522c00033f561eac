"""Scalar KPIs, each a one-row result unless noted, and the board of all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogmart.functions import rules
from catalogmart.functions.means import exact_mean
from catalogmart.plans.marts import average_rating_by_genre, headline_order, qualifying, with_names
from catalogmart.sources.tables import SCALAR, KeptTables

#: What a KPI that is a title shows of it.
FIRST_TITLES = {"highest_rated_movie": "avg_rating", "most_popular_movie": "num_of_votes"}


def average_runtime(movies: DataFrame) -> DataFrame:
    eligible = movies.filter(rules.runtime_eligible(F.col("runtime_min")))
    return eligible.agg(F.avg("runtime_min").alias("average_runtime"))


def avg_movie_rating(ratings: DataFrame) -> DataFrame:
    """Unweighted mean of the preferred rating."""
    return ratings.agg(F.round(exact_mean(rules.preferred_rating()), 2).alias("avg_movie_rating"))


def highest_rated_movie(ratings: DataFrame, movies: DataFrame, kept: KeptTables) -> DataFrame:
    """At most one row."""
    rated = qualifying(ratings, rules.HEADLINE_FLOOR).filter(F.col("avg_rating").isNotNull())
    return _named(rated.orderBy(*headline_order()).limit(1), movies, kept)


def most_popular_movie(ratings: DataFrame, movies: DataFrame, kept: KeptTables) -> DataFrame:
    """Most preferred votes among rated titles; at most one row."""
    rated = ratings.filter(rules.has_rating() & rules.has_votes()).select(
        "movie_id", rules.preferred_rating().alias("avg_rating"), rules.preferred_votes().alias("num_of_votes")
    )
    order = [F.col("num_of_votes").desc_nulls_last(), F.col("movie_id").asc(), F.col("avg_rating").desc_nulls_last()]
    return _named(rated.orderBy(*order).limit(1), movies, kept)


def _named(best: DataFrame, movies: DataFrame, kept: KeptTables) -> DataFrame:
    named = with_names(best, movies, kept).select("movie_id", "movie_name", "avg_rating", "num_of_votes")
    # One row even if the catalogue repeats the id.
    return named.orderBy(F.col("movie_name").asc_nulls_last()).limit(1)


def latest_now_playing_snapshot(now_playing: DataFrame) -> DataFrame:
    return now_playing.agg(F.max("snapshot_date").alias("latest_now_playing_snapshot"))


def number_of_movies_now_playing(now_playing: DataFrame) -> DataFrame:
    """Listing rows per region."""
    return now_playing.groupBy("tmdb_region").agg(F.count("movie_id").alias("no_of_movies_now_playing"))


def rated_movies(ratings: DataFrame) -> DataFrame:
    return ratings.filter(rules.has_rating()).agg(F.count_distinct("movie_id").alias("total_rated_movies"))


def top_rated_genre(genres: DataFrame, ratings: DataFrame) -> DataFrame:
    """Genre with the best mean rating; an unknown mean counts as the largest."""
    averages = average_rating_by_genre(genres, ratings)
    order = [F.col("genre_avg_rating").desc_nulls_first(), F.col("genre_name").asc_nulls_first()]
    return averages.orderBy(*order).limit(1)


def total_genres(genre_dimension: DataFrame) -> DataFrame:
    return genre_dimension.agg(F.count_distinct("genre_id").alias("total_genres"))


def total_movies(movies: DataFrame) -> DataFrame:
    return movies.agg(F.count_distinct("movie_id").alias("total_movies"))


def scalars(relation: str) -> dict[str, Column]:
    """Aggregates of a relation that partial results merge into, by KPI, to be taken along while it is written.

    The first of an order is the least of a struct that compares alike: greater
    values first by their negative, unknown ones by a flag before it.
    """
    rating, votes = rules.preferred_rating(), rules.preferred_votes()
    title = F.struct("movie_id", rating.alias("avg_rating"), votes.alias("num_of_votes"))
    falling = lambda c: (c.isNull(), -c)
    first = lambda admitted, *order: F.min_by(title, F.when(admitted, F.struct(*order)))
    by_relation = {
        "dim_movies": {"average_runtime": F.avg(F.when(rules.runtime_eligible(F.col("runtime_min")), F.col("runtime_min")))},
        "fct_movie_ratings": {
            "avg_movie_rating": F.round(exact_mean(rating), 2),
            "highest_rated_movie": first(
                rules.either_votes_reach(rules.HEADLINE_FLOOR) & rating.isNotNull(), *falling(rating), *falling(votes), F.col("movie_id")
            ),
            "most_popular_movie": first(
                rules.has_rating() & rules.has_votes(), *falling(votes), F.col("movie_id"), *falling(rating)
            ),
        },
    }
    return {f"{SCALAR}{name}": aggregate for name, aggregate in by_relation.get(relation, {}).items()}


def _taken(c, relation: str) -> dict:
    """The scalars of a relation: as its writing has taken them along, else from one scan."""
    df, wanted = getattr(c, relation), scalars(relation)
    seen = c.kept.scalars.get(relation, {})
    if not set(wanted) <= set(seen):
        seen = df.agg(*[aggregate.alias(name) for name, aggregate in wanted.items()]).first().asDict()
    return {name.removeprefix(SCALAR): seen[name] for name in wanted}


def board(c) -> DataFrame:
    """(kpi, item, value) of all eleven KPIs of catalogue ``c``; item is a title, region, genre or date, where there is one.

    Means and first titles are taken along while the ratings and the catalogue
    are written, so they cost no scan; both titles are named in one look-up, and
    the listing is read once for its date and its counts. What is left is
    distinct counts and the two KPIs that join relations.
    """
    spark, none = c.kept.spark, F.lit(None)
    known = {**_taken(c, "dim_movies"), **_taken(c, "fct_movie_ratings")}
    row = lambda kpi, item, value: (F.lit(kpi).alias("kpi"), item.cast("string").alias("item"), value.cast("double").alias("value"))
    stated = [F.struct(*row(kpi, none, F.lit(known[kpi]))) for kpi in ("average_runtime", "avg_movie_rating")]
    parts = [spark.range(1).select(F.inline(F.array(*stated)))]

    firsts = [(kpi, known[kpi]["movie_id"], float(known[kpi][of])) for kpi, of in FIRST_TITLES.items() if known[kpi] is not None]
    if firsts:
        found = [F.struct(F.lit(kpi).alias("kpi"), F.lit(movie).cast("string").alias("movie_id"), F.lit(value).alias("value")) for kpi, movie, value in firsts]
        found = spark.range(1).select(F.inline(F.array(*found)))
        wanted = c.dim_movies.filter(F.col("movie_id").isin([movie for _, movie, _ in firsts]))
        # One row an id even if the catalogue repeats it, so at most one for each title is broadcast.
        names = wanted.groupBy("movie_id").agg(F.min("movie_name").alias("item"))
        parts.append(found.join(F.broadcast(names), "movie_id", "left").select("kpi", "item", "value"))

    listed = c.fct_now_playing.groupBy("tmdb_region").agg(F.count("movie_id").alias("n"), F.max("snapshot_date").alias("latest"))
    dated = listed.agg(F.max("latest").alias("latest"))
    distinct = lambda rows, column, kpi: rows.agg(F.count_distinct(column).alias("n")).select(*row(kpi, none, F.col("n")))
    parts += [
        listed.select(*row("number_of_movies_now_playing", F.col("tmdb_region"), F.col("n"))),
        dated.select(*row("latest_now_playing_snapshot", F.col("latest"), none)),
        distinct(c.fct_movie_ratings.filter(rules.has_rating()), "movie_id", "rated_movies"),
        distinct(c.dim_movies, "movie_id", "total_movies"),
        distinct(c.dim_genre, "genre_id", "total_genres"),
        c.top_rated_genre.select(*row("top_rated_genre", F.col("genre_name"), F.col("genre_avg_rating"))),
        c.top_recommended_now_playing_movie.select(*row("top_recommended_now_playing_movie", F.col("tmdb_region"), F.col("avg_rating"))),
    ]
    return reduce(DataFrame.unionAll, parts)
