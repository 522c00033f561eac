"""Exclusion, staging and curated layer against brute force on small, dirty inputs."""

from __future__ import annotations

import random

import pytest

from catalogmart.operators.exclusion import ExcludedIds, excluded_ids, tagged_union
from catalogmart.operators.joins import left_join_known, without
from catalogmart.operators.ranking import numbered
from catalogmart.plans import curated, staging
from catalogmart.sources.schemas import RAW_SCHEMAS
from catalogmart.sources.tables import KeptTables
from tests.conftest import tuples


def raw(rows, relation, records):
    names = [part.strip().split(" ")[0] for part in RAW_SCHEMAS[relation].split(",")]
    return rows([tuple(r.get(n) for n in names) for r in records], RAW_SCHEMAS[relation])


def test_exclusion_closes_over_both_sources(spark, rows):
    titles = raw(
        rows,
        "title_basics",
        [
            {"tconst": "tt1", "genres": "News"},
            {"tconst": "tt2", "genres": "Drama"},
            {"tconst": "tt3", "genres": None},
            {"tconst": "tt4", "genres": "Newsreel"},
        ],
    )
    details = raw(
        rows,
        "details",
        [
            {"id": 1, "imdb_id": "tt1", "genres": "[]"},  # through the first source
            {"id": 2, "imdb_id": "tt2", "genres": '[{"id": 9, "name": " news"}]'},  # by name, pulls tt2
            {"id": 3, "imdb_id": "tt3", "genres": "broken"},  # through the listing's tag id, pulls tt3
            {"id": 4, "imdb_id": None, "genres": '[{"id": 9, "name": "\\u004eews"}]'},  # spelled with an escape
            {"id": 5, "imdb_id": None, "genres": None},
            {"id": 6, "imdb_id": "tt2", "genres": "[]"},  # second row of a pulled title
        ],
    )
    listing = raw(
        rows,
        "now_playing",
        [{"id": 3, "genre_ids": "[28, 77]"}, {"id": 5, "genre_ids": "[28]"}, {"id": 8, "genre_ids": "[77]"}],
    )
    genres = raw(rows, "genres", [{"id": 77, "name": " NEWS "}, {"id": 28, "name": "Action"}, {"id": 5, "name": None}])
    excluded = excluded_ids(titles, details, listing, genres, KeptTables(spark))
    assert tuples(excluded.imdb) == [("tt1",), ("tt2",), ("tt3",)]
    assert tuples(excluded.tmdb) == [(1,), (2,), (3,), (4,), (6,), (8,)]
    union = tagged_union(excluded)
    assert union.columns == ["imdb_id", "tmdb_id"] and union.count() == 9
    assert tuples(staging.stg_genres(genres)) == [(28, "Action"), (5, None)]


def test_null_keys_survive_the_anti_join(rows):
    df = rows([("a", 1), (None, 2), ("b", 3)], "key string, n int")
    assert tuples(without(df, rows([("a",), (None,)], "key string"), "key")) == [("b", 3), (None, 2)]


def test_left_join_on_a_sparse_key_equals_a_plain_left_join(rows):
    left = rows([(1, "a"), (2, None), (3, "b"), (4, "a"), (5, None)], "n int, k string")
    right = rows([("a", 10), ("a", 11), (None, 12), ("c", 13)], "k string, v int")
    expected = left.join(right, "k", "left").select("n", "k", "v")
    assert tuples(left_join_known(left, right, "k")) == tuples(expected)


def test_latest_row_per_key(rows):
    key = {"id": 1, "region": "US", "snapshot_date": None, "title": "t"}
    listing = raw(
        rows,
        "now_playing",
        [
            {**key, "popularity": 1.0, "vote_count": 5, "overview": "low"},
            {**key, "popularity": 2.0, "vote_count": 5, "overview": "b"},
            {**key, "popularity": 2.0, "vote_count": 6, "overview": "best"},
            {**key, "region": "IN", "popularity": 9.0, "vote_count": 1, "overview": "known"},
            {**key, "region": "IN", "popularity": None, "vote_count": 0, "overview": "unknown first"},
            {**key, "id": 2, "popularity": 1.0, "overview": "excluded"},
        ],
    )
    excluded = ExcludedIds(rows([], "imdb_id string"), rows([(2,)], "tmdb_id bigint"))
    got = staging.stg_now_playing(listing, excluded)
    assert tuples(got.select("tmdb_region", "now_playing_overview")) == [("IN", "unknown first"), ("US", "best")]


TITLES = (
    "imdb_id string, content_type string, primary_title string, original_title string, is_adult int, "
    "start_year int, end_year int, runtime_min int, genres string"
)
DETAILS = (
    "tmdb_id bigint, imdb_id string, movie_title string, tmdb_release_date date, tmdb_runtime_min int, "
    "tmdb_genres string, tmdb_avg_rating double, tmdb_num_votes bigint"
)


def random_catalogue(rows, seed):
    """Titles and details with unknown links, dangling links and repeated links."""
    import datetime

    pick = random.Random(seed)
    kinds = ["movie", "tvMovie", "tvSeries", None]
    titles = [
        (f"tt{i}", pick.choice(kinds), f"T{i}", f"O{i}", 0, pick.choice([None, 1990 + i]), pick.choice([None, None, 2000]),
         pick.choice([None, 60 + i]), pick.choice([None, "a", "b, a", "c"]))
        for i in range(30)
    ]
    details = [
        (i, pick.choice([None, None, "tt1", f"tt{pick.randrange(40)}"]), f"D{i}",
         pick.choice([None, datetime.date(1950 + i, 5, 1)]), pick.choice([None, 100 + i]),
         pick.choice([None, "[]", '[{"id": 1, "name": "x"}, {"id": 2, "name": " y"}]']), i / 10, i * 100)
        for i in range(40)
    ]
    return titles, details, rows(titles, TITLES), rows(details, DETAILS)


def film(title):
    return title[1] in ("movie", "tvMovie") and title[6] is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_equals_a_brute_force_full_outer_join(rows, seed):
    titles, details, title_df, detail_df = random_catalogue(rows, seed)
    films = [t for t in titles if film(t)]
    expected, met = [], set()
    for d in details:
        matches = [t for t in films if d[1] is not None and t[0] == d[1]]
        for t in matches or [None]:
            if t:
                met.add(t[0])
            year = t[5] if t and t[5] is not None else (d[3].year if d[3] else None)
            minutes = t[7] if t and t[7] is not None else d[4]
            expected.append((
                t[0] if t else f"tmdb_{d[0]}", d[1], d[0], t[2] if t else d[2], t[3] if t else None, d[2],
                t[4] if t else None, year, minutes, t[1] if t else "tmdb_movie",
            ))
    for t in films:
        if t[0] not in met:
            expected.append((t[0], t[0], None, t[2], t[3], None, t[4], t[5], t[7], t[1]))
    movies = curated.dim_movies(detail_df, title_df, KeptTables(detail_df.sparkSession))
    assert movies.columns == [
        "movie_id", "imdb_id", "tmdb_id", "movie_name", "imdb_original_title", "tmdb_movie_title", "is_adult",
        "release_year", "runtime_min", "content_type",
    ]
    assert tuples(movies) == sorted(expected, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_genre_bridge(rows, seed):
    titles, details, title_df, detail_df = random_catalogue(rows, seed)
    films = {t[0]: t for t in titles if film(t)}
    expected = [(t[0], g.strip(), "imdb") for t in films.values() if t[8] for g in t[8].split(",")]
    for d in details:
        if d[1] not in films and d[5] and "x" in d[5]:
            expected += [(f"tmdb_{d[0]}", "x", "tmdb"), (f"tmdb_{d[0]}", " y", "tmdb")]
    assert tuples(curated.bridge_movie_genres(title_df, detail_df)) == sorted(expected, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ratings_fact(rows, seed):
    _, details, title_df, detail_df = random_catalogue(rows, seed)
    movies = curated.dim_movies(detail_df, title_df, KeptTables(detail_df.sparkSession))
    ratings = {f"tt{i}": (i / 10, i * 50) for i in range(0, 30, 2)}
    rating_df = rows([(k, *v) for k, v in ratings.items()], "imdb_id string, avg_rating double, num_of_votes bigint")
    by_id = {d[0]: d for d in details}
    expected = []
    for movie_id, imdb_id, tmdb_id in movies.select("movie_id", "imdb_id", "tmdb_id").collect():
        first = ratings.get(imdb_id, (None, None))
        second = by_id[tmdb_id][6:8] if tmdb_id is not None else (None, None)
        expected.append((movie_id, imdb_id, tmdb_id, *first, *second, first[0] is not None, second[0] is not None))
    assert tuples(curated.fct_movie_ratings(movies, rating_df, detail_df)) == sorted(expected, key=repr)


def test_people_bridge_and_listing_fact(rows):
    movies = rows([("tt1", "tt1", 5, "One"), ("tmdb_7", None, 7, "Seven"), ("tt3", "tt3", None, "Three")],
                  "movie_id string, imdb_id string, tmdb_id bigint, movie_name string")
    credits = rows(
        [("tt1", 1, "nm1", "actor", "j", "c"), ("tt1", 2, None, "actor", "j", "c"), ("tt9", 1, "nm1", "actor", "j", "c"),
         (None, 1, "nm1", "actor", "j", "c")],
        "imdb_id string, principal_order int, person_id string, job_role string, specific_job string, characters_played string",
    )
    assert tuples(curated.bridge_movie_people(movies, credits)) == [("tt1", "tt1", 1, "nm1", "actor", "j")]
    listing = rows(
        [(5, "listed five", None, None, None, 1.0, "US", None), (8, "listed eight", None, None, None, 1.0, "US", None)],
        "tmdb_id bigint, movie_title string, now_playing_release_date date, now_playing_overview string, "
        "now_playing_poster_path string, now_playing_popularity double, tmdb_region string, snapshot_date date",
    )
    got = curated.fct_now_playing(listing, movies).select("movie_id", "imdb_id", "tmdb_id", "movie_name")
    assert tuples(got) == [("tmdb_8", None, 8, "listed eight"), ("tt1", "tt1", 5, "One")]


def test_genre_dimension_numbers_all_title_types_by_name(spark, rows):
    titles = rows([("movie", "b, a"), ("tvSeries", "c,a"), ("movie", None)], "content_type string, genres string")
    assert tuples(curated.dim_genre(titles, KeptTables(spark))) == [(1, "a"), (2, "b"), (3, "c")]


def test_numbering_crosses_ranges(spark):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
        got = numbered(df, "name", "n", KeptTables(spark)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.name for r in sorted(got)] == sorted(r.name for r in got)
    assert sorted(r.n for r in got) == list(range(1, 5001))


def test_one_highlight_even_if_the_catalogue_repeats_the_id(rows):
    from catalogmart.plans import kpis

    facts = rows([("a", 9.0, 100_000, None, None)],
                 "movie_id string, imdb_avg_rating double, imdb_num_of_votes bigint, tmdb_avg_rating double, "
                 "tmdb_num_of_votes bigint")
    movies = rows([("a", "y"), ("a", "x")], "movie_id string, movie_name string")
    assert tuples(kpis.highest_rated_movie(facts, movies, KeptTables(facts.sparkSession))) == [("a", "x", 9.0, 100_000)]


def test_declared_tests_are_complete():
    from catalogmart.plans import quality

    flags = [t for columns in quality.COLUMN_TESTS.values() for tests in columns.values() for t in tests]
    assert flags.count("N") == 41 and flags.count("U") == 12
    assert len(quality.ACCEPTED_VALUES) == 2 and len(quality.REFERENCES) == 3
