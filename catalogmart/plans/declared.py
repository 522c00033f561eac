"""What is declared about the relations, and what their writing takes along: counts of violations, scalars of the KPIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogmart.functions.rules import RATING_LIMITS
from catalogmart.functions.text import is_label
from catalogmart.operators.exclusion import EXCLUDED_LABEL
from catalogmart.plans import kpis

# Declared column tests. N: not null, U: unique.
COLUMN_TESTS = {
    "stg_name_basics": {"person_id": "NU", "primary_name": "N"},
    "stg_title_akas": {"imdb_id": "N", "alternate_title_order": "N", "alternate_title": "N"},
    "stg_title_basics": {"imdb_id": "NU", "content_type": "N", "primary_title": "N"},
    "stg_title_crew": {"imdb_id": "NU"},
    "stg_title_principals": {"imdb_id": "N", "principal_order": "N", "person_id": "N"},
    "stg_title_ratings": {"imdb_id": "NU", "avg_rating": "N", "num_of_votes": "N"},
    "stg_details": {"tmdb_id": "NU", "movie_title": "N"},
    "stg_genres": {"tmdb_genre_id": "NU", "genre_name": "NU"},
    "stg_now_playing": {"tmdb_id": "N", "movie_title": "N", "tmdb_region": "N", "snapshot_date": "N"},
    "dim_movies": {"movie_id": "NU", "movie_name": "N", "content_type": "N"},
    "dim_person": {"person_id": "NU", "person_name": "N"},
    "dim_genre": {"genre_id": "NU", "genre_name": "NU"},
    "bridge_movie_genres": {"movie_id": "N", "genre_name": "N", "genre_source": "N"},
    "bridge_movie_people": {"movie_id": "N", "person_id": "N"},
    "fct_movie_ratings": {"movie_id": "NU"},
    "fct_now_playing": {"movie_id": "N", "tmdb_id": "N", "movie_name": "N", "tmdb_region": "N", "snapshot_date": "N"},
}
ACCEPTED_VALUES = {
    ("dim_movies", "content_type"): ("movie", "tvMovie", "tmdb_movie"),
    ("bridge_movie_genres", "genre_source"): ("imdb", "tmdb"),
}
REFERENCES = {
    ("bridge_movie_genres", "movie_id"): ("dim_movies", "movie_id"),
    ("bridge_movie_people", "movie_id"): ("dim_movies", "movie_id"),
    ("fct_movie_ratings", "movie_id"): ("dim_movies", "movie_id"),
}
COMPOSITE_KEYS = {
    "stg_title_akas": ("imdb_id", "alternate_title_order"),
    "stg_title_principals": ("imdb_id", "principal_order"),
    "stg_now_playing": ("tmdb_id", "tmdb_region", "snapshot_date"),
}
EXCLUSION_SCOPE = (
    "stg_title_basics",
    "stg_title_ratings",
    "stg_title_crew",
    "stg_title_principals",
    "stg_title_akas",
    "stg_details",
    "dim_movies",
    "fct_movie_ratings",
    "fct_now_playing",
    "stg_now_playing",
)
LABEL_SCOPE = ("dim_genre", "bridge_movie_genres", "stg_genres")
RATING_COLUMNS = ("imdb_avg_rating", "tmdb_avg_rating")
VOTE_COLUMNS = ("imdb_num_of_votes", "tmdb_num_of_votes")
#: Relations that the tests of single rows concern.
WATCHED = tuple(dict.fromkeys([*COLUMN_TESTS, *LABEL_SCOPE]))


def kept_name(relation: str) -> str:
    """The name under which the tested rows of a relation are written; staging itself is a view."""
    return f"tested_{relation}" if relation.startswith("stg_") else relation


def row_counts(relation: str) -> dict[str, Column]:
    """Aggregates by name: the rows of a relation, and those that violate each test a single row can violate.

    A test of accepted values counts rows here, and distinct values where it is a
    test of its own; the two are zero together.
    """
    counts = {f"rows {relation}": F.count(F.lit(1))}
    for column, tests in COLUMN_TESTS.get(relation, {}).items():
        if "N" in tests:
            counts[f"not_null {relation}.{column}"] = F.count_if(F.col(column).isNull())
    for (of, column), accepted in ACCEPTED_VALUES.items():
        if of == relation:
            counts[f"accepted_values {relation}.{column}"] = F.count_if(~F.col(column).isin(list(accepted)))
    if relation in LABEL_SCOPE:
        counts[f"label_excluded {relation}"] = F.count_if(is_label(F.col("genre_name"), EXCLUDED_LABEL))
    if relation == "fct_movie_ratings":
        outside = [F.count_if(~F.col(c).between(*RATING_LIMITS)) for c in RATING_COLUMNS]
        negative = [F.count_if(F.col(c) < 0) for c in VOTE_COLUMNS]
        counts |= {"rating_range": sum(outside[1:], outside[0]), "votes_nonnegative": sum(negative[1:], negative[0])}
    return counts


def watched() -> dict[str, dict[str, Column]]:
    """The aggregates to take along while a relation is written, by the name under which it is."""
    return {kept_name(relation): row_counts(relation) | kpis.scalars(relation) for relation in WATCHED}
