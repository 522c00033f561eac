"""The board of KPIs: scalars taken along while relations are written equal the single KPIs."""

from __future__ import annotations

import random
import re
from types import SimpleNamespace

import pytest

from catalogmart.plans import declared, kpis, marts
from catalogmart.sources.tables import KeptTables
from tests.conftest import tuples

FACT = "movie_id string, imdb_id string, tmdb_id bigint, imdb_avg_rating double, tmdb_avg_rating double, imdb_num_of_votes bigint, tmdb_num_of_votes bigint"
MOVIE = "movie_id string, movie_name string, runtime_min int"
LISTED = "movie_id string, tmdb_region string, snapshot_date date"


def random_facts(seed: int, n: int):
    pick = random.Random(seed)
    rating = lambda: pick.choice([None, 0.0, 7.1, 7.1, 9.9, 10.0])
    votes = lambda: pick.choice([None, 0, 20, 400_000, 400_000, 900_000])
    movie = lambda: pick.choice([None, "a", "b", "c", *"defghij"])
    return [(movie(), "x", 1, rating(), rating(), votes(), votes()) for _ in range(n)]


def catalogue(spark, rows, facts, movies, watched):
    kept = KeptTables(spark, declared.watched() if watched else None)
    c = SimpleNamespace(kept=kept)
    c.fct_movie_ratings = kept.keep("fct_movie_ratings", rows(facts, FACT).repartition(3))
    c.dim_movies = kept.keep("dim_movies", rows(movies, "content_type string, " + MOVIE))
    c.fct_now_playing = rows([("a", "IN", None), (None, "IN", None), ("b", None, None)], LISTED)
    c.dim_genre = rows([(1,), (2,), (None,)], "genre_id int")
    c.top_rated_genre = rows([("Drama", None)], "genre_name string, genre_avg_rating double")
    c.top_recommended_now_playing_movie = rows([], "tmdb_region string, avg_rating double")
    return c


MOVIES = [("movie", k, name, run) for k, name, run in [("a", "A", 90), ("a", "AA", None), ("b", None, 10), ("c", "C", 5_000), ("d", "D", 101), ("z", "Z", 77)]]


def single(c):
    """The same rows from the KPIs one by one."""
    out = [("average_runtime", None, kpis.average_runtime(c.dim_movies).first()[0]), ("avg_movie_rating", None, kpis.avg_movie_rating(c.fct_movie_ratings).first()[0])]
    for kpi, of in kpis.FIRST_TITLES.items():
        out += [(kpi, r["movie_name"], float(r[of])) for r in getattr(kpis, kpi)(c.fct_movie_ratings, c.dim_movies, c.kept).collect()]
    out += [("rated_movies", None, float(kpis.rated_movies(c.fct_movie_ratings).first()[0])), ("total_movies", None, float(kpis.total_movies(c.dim_movies).first()[0]))]
    return out


@pytest.mark.parametrize("seed,n", [(1, 40), (2, 40), (3, 200), (4, 3), (5, 0)])
@pytest.mark.parametrize("watched", [True, False])
def test_board_equals_the_single_kpis(spark, rows, seed, n, watched):
    c = catalogue(spark, rows, random_facts(seed, n), MOVIES, watched)
    fixed = [
        ("latest_now_playing_snapshot", None, None),
        ("number_of_movies_now_playing", "IN", 1.0),
        ("number_of_movies_now_playing", None, 1.0),
        ("top_rated_genre", "Drama", None),
        ("total_genres", None, 2.0),
    ]
    assert tuples(kpis.board(c)) == sorted([*single(c), *fixed], key=repr)


def test_the_ratings_are_read_for_the_distinct_count_alone(spark, rows):
    c = catalogue(spark, rows, random_facts(6, 60), MOVIES, True)
    plan = kpis.board(c)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[[^]]*imdb_avg_rating", plan)) == 1


def test_an_often_repeated_title_is_named_without_sending_its_rows(spark, rows):
    """Both titles are looked up by one row each, however many rows the catalogue has for them."""
    n = 20_000
    c = catalogue(spark, rows, [("a", "x", 1, 9.0, None, 900_000, None)], MOVIES, True)
    named = spark.range(0, n, 1, 4).selectExpr("'movie' AS content_type", "'a' AS movie_id", "concat('name ', id) AS movie_name", "90 AS runtime_min")
    c.dim_movies = KeptTables(spark).keep("dim_movies", named)
    board = kpis.board(c)
    assert [tuple(r) for r in board.collect() if r.item and r.item.startswith("name")] == [("highest_rated_movie", "name 0", 9.0), ("most_popular_movie", "name 0", 900_000.0)]
    assert max(sent(board)) <= 2


def sent(df):
    """Rows of each broadcast of the executed plan."""
    nodes, found = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
        else:
            if node.nodeName() == "BroadcastExchange":
                found.append(node.metrics().apply("numOutputRows").value())
            children = node.children()
            nodes += [children.apply(k) for k in range(children.size())]
    return found


def test_the_joined_kpis_send_no_relation_whole(spark, rows):
    """Facts, listing and genres that are small as written and large in memory."""
    kept, n = KeptTables(spark), 30_000
    title = "concat('tt', id) AS movie_id"
    write = lambda name, *columns: kept.keep(name, spark.range(0, n, 1, 1).selectExpr(title, *columns))
    facts = write("facts", "id % 9 + 0.5D AS imdb_avg_rating", "cast(null AS double) AS tmdb_avg_rating", "900000L AS imdb_num_of_votes", "cast(null AS bigint) AS tmdb_num_of_votes", "'x' AS imdb_id", "1L AS tmdb_id")
    text = "repeat('the same text in every row ', 8)"
    listed = write("listed", f"{text} AS movie_name", "'US' AS tmdb_region", "date'2024-01-01' AS now_playing_release_date", f"{text} AS now_playing_overview", "1.0D AS now_playing_popularity", "date'2024-01-01' AS snapshot_date")
    genres = write("genres", "concat('genre ', id % 5) AS genre_name", "'imdb' AS genre_source")
    movies = write("movies", "'movie' AS content_type", f"{text} AS movie_name", "90 AS runtime_min")
    c = SimpleNamespace(kept=kept, fct_movie_ratings=facts, dim_movies=movies, fct_now_playing=listed, dim_genre=rows([(1,), (2,)], "genre_id int"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    largest = max(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for df in (facts, listed, genres, movies))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(largest))
    try:
        c.top_rated_genre = kpis.top_rated_genre(genres, facts)
        c.top_recommended_now_playing_movie = marts.top_recommended_now_playing_movie(listed, facts)
        board = kpis.board(c)
        got = tuples(board)
        assert max(sent(board)) <= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ("total_movies", None, float(n)) in got and ("top_recommended_now_playing_movie", "US", 8.5) in got
