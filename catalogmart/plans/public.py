"""Public result sets: bounded, renamed, ordered selections of marts, and their field rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.functions.rules import ROLE_MINIMUMS
from catalogmart.operators.contract import FieldRule, capture_evidence
from catalogmart.operators.ranking import top_rows
from catalogmart.sources.bounded import bounded_select

# Public field -> mart column, per result set.
TITLE_FIELDS = {"movie_id": "movie_id", "title": "movie_name", "rating": "avg_rating", "votes": "num_of_votes"}
FIELDS = {
    "total_movies": {"total_movies": "total_movies"},
    "rated_movies": {"rated_movies": "total_rated_movies"},
    "avg_rating": {"avg_rating": "avg_movie_rating"},
    "avg_runtime_minutes": {"avg_runtime_minutes": "average_runtime"},
    "highest_rated_movie": TITLE_FIELDS,
    "most_voted_movie": TITLE_FIELDS,
    "rating_bins": {
        "bracket": "rating_bracket",
        "order": "bucket_order",
        "movie_count": "movie_count",
        "percentage": "percentage_of_movies",
        "population_count": "total_no_of_movies",
    },
    "genre_ratings": {"genre": "genre_name", "avg_rating": "genre_avg_rating"},
    "genre_runtimes": {"genre": "genre_name", "avg_runtime_minutes": "genre_avg_runtime"},
    "decade_counts": {"decade": "decade", "movie_count": "movies_made_in_decade"},
    "decade_ratings": {"decade": "decade", "avg_rating": "decade_avg_rating"},
    "top_years": {"year": "release_year", "avg_rating": "release_yr_avg_rating", "movie_count": "movie_count"},
    "top_movies": {"rank": "movie_rank", **TITLE_FIELDS},
    "people": {
        "role": "job_role",
        "rank": "job_rank",
        "person_id": "person_id",
        "name": "person_name",
        "movie_count": "movie_count",
        "avg_rating": "person_rating",
    },
    "region_counts": {"region": "tmdb_region", "movie_count": "no_of_movies_now_playing"},
    "recommendations": {
        "region": "tmdb_region",
        "rank": "recommendation_rank",
        **TITLE_FIELDS,
        "release_date": "now_playing_release_date",
        "overview": "now_playing_overview",
        "popularity": "now_playing_popularity",
    },
    "latest_snapshot_date": {"latest_snapshot_date": "latest_now_playing_snapshot"},
}
# The relation behind each result set, and the largest allowed size of each list.
RELATIONS = {
    "total_movies": "total_movies",
    "rated_movies": "rated_movies",
    "avg_rating": "avg_movie_rating",
    "avg_runtime_minutes": "average_runtime",
    "highest_rated_movie": "highest_rated_movie",
    "most_voted_movie": "most_popular_movie",
    "rating_bins": "mart_rating_distribution",
    "genre_ratings": "average_rating_by_genre",
    "genre_runtimes": "average_runtime_by_genre",
    "decade_counts": "no_of_movies_every_decade",
    "decade_ratings": "decade_avg_rating",
    "top_years": "mart_top_years",
    "top_movies": "mart_top_movies",
    "people": "mart_top_people",
    "region_counts": "number_of_movies_now_playing",
    "recommendations": "mart_now_playing_recommendations",
    "latest_snapshot_date": "latest_now_playing_snapshot",
}
LARGEST = {
    "rating_bins": 10,
    "genre_ratings": 1000,
    "genre_runtimes": 1000,
    "decade_counts": 14,
    "decade_ratings": 14,
    "top_years": 10,
    "top_movies": 10,
    "people": 220,
    "region_counts": 2,
    "recommendations": 10,
    "captures": 2,
}
# Mart columns each list is published by; a leading minus is descending, unknown last.
ORDER = {
    "rating_bins": ["bucket_order"],
    "genre_ratings": ["-genre_avg_rating", "genre_name"],
    "genre_runtimes": ["-genre_avg_runtime", "genre_name"],
    "decade_counts": ["decade"],
    "decade_ratings": ["decade"],
    "top_years": ["-release_yr_avg_rating", "release_year"],
    "top_movies": ["movie_rank"],
    "people": ["job_role", "job_rank"],
    "region_counts": ["tmdb_region"],
    "recommendations": ["tmdb_region", "recommendation_rank"],
}


def _ordering(columns):
    return [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc() for c in columns]


def published(name: str, mart: DataFrame) -> DataFrame:
    """One result set from its mart: exact fields, stated order, at most its published size.

    Scalars and highlights have at most one row. Years get ranks 1..n in
    published order; the unlabelled decade stays private.
    """
    if name == "decade_ratings":
        mart = mart.filter(F.col("decade").isNotNull())
    listed = bounded_select(
        mart, name, list(FIELDS[name].items()), _ordering(ORDER.get(name, [])), maximum=LARGEST.get(name, 1)
    )
    if name == "top_years":
        ranked = top_rows(listed, _ordering(["-avg_rating", "year"]), LARGEST[name], "rank")
        return ranked.select("rank", *FIELDS[name])
    return listed


def captures(now_playing: DataFrame) -> DataFrame:
    """Private evidence behind the published capture dates."""
    evidence = capture_evidence(now_playing)
    columns = [(c, c) for c in evidence.columns]
    return bounded_select(evidence, "captures", columns, [F.col("region").asc()], maximum=LARGEST["captures"])


def result(name: str, catalogue) -> DataFrame:
    """One result set of a catalogue, by public name."""
    if name == "captures":
        return captures(catalogue.fct_now_playing)
    return published(name, getattr(catalogue, RELATIONS[name]))


RESULT_NAMES = (*RELATIONS, "captures")


def columns(name: str) -> list[str]:
    """Fields of a result set."""
    return [rule.field for rule in FIELD_RULES[name]]


#: Column of a written list that says at which place a row stands.
POSITION = "position"


def publication(catalogue) -> DataFrame:
    """(completed, exported): when the captures were complete and when the results left, as texts with their zones.

    A build from given tables has no clock of its own: both follow from the last capture date.
    """
    day = F.date_format(F.max("max_capture_date"), "yyyy-MM-dd")
    last = captures(catalogue.fct_now_playing).agg(day.alias("day")).filter("day IS NOT NULL")
    return last.select(F.concat("day", F.lit("T00:00:00Z")).alias("completed"), F.concat("day", F.lit("T01:30:00+01:00")).alias("exported"))


# Constraints of the public fields.
BRACKETS = ("0-1", "1-2", "2-3", "3-4", "4-5", "5-6", "6-7", "7-8", "8-9", "9-10")
DECADE_PATTERN = r"^(189|19\d|20[0-2])0s$"
COUNT = {"low": 0, "integer": True}
RATING = {"nullable": True, "finite": True, "low": 0, "high": 10}
NAME = {"nullable": True, "max_length": 2000}
IDENTITY = {"min_length": 1, "max_length": 128}
GENRE = FieldRule("genre", min_length=1, max_length=500)
DECADE = FieldRule("decade", pattern=DECADE_PATTERN)
TITLE_RULES = [
    FieldRule("movie_id", **IDENTITY),
    FieldRule("title", **NAME),
    FieldRule("rating", **RATING),
    FieldRule("votes", nullable=True, integer=True, low=0),
]
FIELD_RULES = {
    "rating_bins": [
        FieldRule("bracket", values=BRACKETS),
        FieldRule("order", integer=True, low=0, high=9),
        FieldRule("movie_count", **COUNT),
        FieldRule("percentage", finite=True, low=0, high=100),
        FieldRule("population_count", **COUNT),
    ],
    "genre_ratings": [GENRE, FieldRule("avg_rating", **RATING)],
    "genre_runtimes": [GENRE, FieldRule("avg_runtime_minutes", nullable=True, finite=True, low=40, high=300)],
    "decade_counts": [DECADE, FieldRule("movie_count", **COUNT)],
    "decade_ratings": [DECADE, FieldRule("avg_rating", **RATING)],
    "top_years": [
        FieldRule("rank", integer=True, low=1, high=10),
        FieldRule("year", integer=True),
        FieldRule("avg_rating", **RATING),
        FieldRule("movie_count", integer=True, low=5),
    ],
    "highest_rated_movie": TITLE_RULES,
    "most_voted_movie": TITLE_RULES,
    "top_movies": [FieldRule("rank", integer=True, low=1, high=10), *TITLE_RULES],
    "people": [
        FieldRule("role", values=tuple(ROLE_MINIMUMS)),
        FieldRule("rank", integer=True, low=1, high=20),
        FieldRule("person_id", **IDENTITY),
        FieldRule("name", **NAME),
        FieldRule("movie_count", integer=True, low=3),
        FieldRule("avg_rating", **RATING),
    ],
    "region_counts": [FieldRule("region", values=("IN", "US")), FieldRule("movie_count", **COUNT)],
    "recommendations": [
        FieldRule("region", values=("IN", "US")),
        FieldRule("rank", integer=True, low=1, high=5),
        *TITLE_RULES,
        FieldRule("release_date", nullable=True),
        FieldRule("overview", **NAME),
        FieldRule("popularity", nullable=True, finite=True, low=0),
    ],
    "total_movies": [FieldRule("total_movies", **COUNT)],
    "rated_movies": [FieldRule("rated_movies", **COUNT)],
    "avg_rating": [FieldRule("avg_rating", **RATING)],
    "avg_runtime_minutes": [FieldRule("avg_runtime_minutes", nullable=True, finite=True, low=40, high=300)],
    "latest_snapshot_date": [FieldRule("latest_snapshot_date")],
    "captures": [
        FieldRule("region", values=("IN", "US")),
        FieldRule("min_capture_date"),
        FieldRule("max_capture_date"),
        FieldRule("row_count", integer=True, low=1),
        FieldRule("unique_movie_count", integer=True, low=1),
        FieldRule("capture_date_count", integer=True, low=1),
    ],
}
