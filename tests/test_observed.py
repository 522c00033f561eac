"""Counts taken along while relations are written, and the tests that need no scan for them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalogmart.operators import checks
from catalogmart.plans import declared, quality
from catalogmart.plans.build import Catalogue
from catalogmart.sources.tables import Buckets, KeptTables, LayerTables
from tests.conftest import tuples
from workload.raw import Given

FOLDER = "/root/testdata/sf0.001"
FACT = "movie_id string, imdb_avg_rating double, tmdb_avg_rating double, imdb_num_of_votes bigint, tmdb_num_of_votes bigint"
FACTS = [("a", 5.0, 11.0, 3, -1), ("b", -0.5, None, None, 0), (None, 10.0, 0.0, -2, None), ("a", None, 99.0, 1, 1)]
SEEN = {"rows fct_movie_ratings": 4, "not_null fct_movie_ratings.movie_id": 1, "rating_range": 3, "votes_nonnegative": 2}


def test_violations_are_counted_while_rows_are_written(spark, rows):
    kept = KeptTables(spark, declared.watched())
    facts = rows(FACTS, FACT).repartition(3)
    assert tuples(kept.keep("fct_movie_ratings", facts)) == tuples(facts)
    assert kept.observed == {"fct_movie_ratings": SEEN}
    bridge = rows([("a", "News ", "imdb"), (None, "Drama", "web"), ("b", None, "tmdb"), ("c", "Drama", "web")], "movie_id string, genre_name string, genre_source string")
    kept.keep("bridge_movie_genres", bridge)
    assert kept.observed["bridge_movie_genres"] == {
        "rows bridge_movie_genres": 4,
        "not_null bridge_movie_genres.movie_id": 1,
        "not_null bridge_movie_genres.genre_name": 1,
        "not_null bridge_movie_genres.genre_source": 0,
        "accepted_values bridge_movie_genres.genre_source": 2,
        "label_excluded bridge_movie_genres": 1,
    }
    kept.keep("fct_movie_ratings", facts.limit(0))  # the last writing counts
    assert set(kept.observed["fct_movie_ratings"].values()) == {0}
    kept.keep("something_else", facts)
    assert set(kept.observed) == {"fct_movie_ratings", "bridge_movie_genres"}


@pytest.mark.parametrize("buckets", [None, {"fct_movie_ratings": Buckets("movie_id", 3)}])
def test_layer_tables_count_too(spark, rows, tmp_path, buckets):
    database = f"observed_{'bucketed' if buckets else 'plain'}"
    tables = LayerTables(spark, {"fct_movie_ratings": database}, str(tmp_path), buckets, declared.watched())
    for _ in range(2):
        assert tables.layer("fct_movie_ratings", rows(FACTS, FACT)).count() == 4
        assert tables.observed == {"fct_movie_ratings": SEEN}
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_a_failing_write_counts_nothing(spark, rows):
    kept = KeptTables(spark, declared.watched())
    broken = rows(FACTS, FACT).withColumn("movie_id", F.when(F.col("movie_id") == "b", F.raise_error(F.lit("no"))).otherwise(F.col("movie_id")))
    with pytest.raises(Exception):
        kept.keep("fct_movie_ratings", broken)
    assert kept.observed == {}


def test_counts_are_those_of_the_violation_queries(spark):
    c = Catalogue(spark, Given(spark, FOLDER))
    found = {r["test"]: r["violations"] for r in quality.summary(c).collect()}
    counted = quality.observed_counts(c)
    violating = quality.violations(c)
    assert set(found) == set(violating)
    of_rows = [name for name in counted if name.startswith(("not_null", "rating", "votes"))]
    assert len(of_rows) > 20
    for name in of_rows:
        assert counted[name] == found[name] == violating[name].count(), name
    assert counted["rows dim_movies"] == c.dim_movies.count()


def test_values_outside_are_counted_as_distinct_ones(spark, rows, monkeypatch):
    """Taken along are rows; the test itself counts values, so it still runs where rows are outside."""
    assert "accepted_values x.y" not in quality._already_counted({"accepted_values x.y": 2})
    assert quality._already_counted({"accepted_values x.y": 0}) == {"accepted_values x.y": 0}
    labels = {f"label_excluded {relation}": k for k, relation in enumerate(quality.LABEL_SCOPE)}
    assert quality._already_counted(labels) == {"label_excluded": 3}
    assert quality._already_counted(dict(list(labels.items())[:2])) == {}


def test_stated_counts_join_the_counted_ones(spark, rows):
    odd = rows([(1,), (2,)], "k int")
    got = checks.counted({"found": odd}, "test", given={"known": 7, "clean": 0})
    assert tuples(got) == [("clean", 0), ("found", 2), ("known", 7)]
