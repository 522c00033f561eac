"""Marts and KPIs on tiny inputs with known answers, and against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from catalogmart.functions import rules
from catalogmart.plans import kpis, marts
from catalogmart.sources.tables import KeptTables
from tests.conftest import as_dicts, tuples

RATINGS = (
    "movie_id string, imdb_avg_rating double, imdb_num_of_votes bigint, tmdb_avg_rating double, tmdb_num_of_votes bigint"
)
MOVIES = "movie_id string, imdb_id string, movie_name string, release_year int, runtime_min int"
LISTING = (
    "movie_id string, movie_name string, tmdb_region string, now_playing_release_date date, "
    "now_playing_overview string, now_playing_popularity double, snapshot_date date"
)


def catalogue(rows, *ratings):
    """Ratings (id, rating) with 100,000 votes, and a catalogue naming them."""
    facts = rows([(i, r, 100_000, None, None) for i, r in ratings], RATINGS)
    return facts, rows([(i, i, f"Title {i}", 2000, 100) for i, _ in ratings], MOVIES)


def test_nine_point_nine_and_ten_share_a_bin(rows):
    facts, _ = catalogue(rows, ("a", 9.9), ("b", 10.0), ("unknown", None))
    assert as_dicts(marts.mart_rating_distribution(facts)) == [
        {
            "rating_bracket": "9-10",
            "bucket_order": 9,
            "movie_count": 2,
            "percentage_of_movies": 100.0,
            "total_no_of_movies": 2,
        }
    ]


def test_rank_ties_break_by_id(rows):
    facts, movies = catalogue(rows, ("b", 8.5), ("a", 8.5))
    assert [r["movie_id"] for r in as_dicts(marts.mart_top_movies(facts, movies, KeptTables(facts.sparkSession)).orderBy("movie_rank"))] == ["a", "b"]
    assert as_dicts(kpis.highest_rated_movie(facts, movies, KeptTables(facts.sparkSession)))[0]["movie_id"] == "a"
    assert as_dicts(kpis.most_popular_movie(facts, movies, KeptTables(facts.sparkSession)))[0]["movie_id"] == "a"


def test_unknown_rating_is_not_zero(rows):
    facts, movies = catalogue(rows, ("a", None))
    assert as_dicts(marts.mart_top_movies(facts, movies, KeptTables(facts.sparkSession)))[0]["avg_rating"] is None
    assert marts.mart_rating_distribution(facts).isEmpty()
    assert kpis.highest_rated_movie(facts, movies, KeptTables(facts.sparkSession)).isEmpty()
    assert kpis.avg_movie_rating(facts).first()[0] is None
    assert kpis.rated_movies(facts).first()[0] == 0


def test_displayed_votes_may_lie_below_the_floor(rows):
    facts = rows([("a", 9.0, 50, 8.0, 200_000)], RATINGS)
    got = as_dicts(marts.mart_top_movies(facts, rows([], MOVIES), KeptTables(facts.sparkSession)))
    assert got == [{"movie_id": "a", "movie_name": None, "avg_rating": 9.0, "num_of_votes": 50, "movie_rank": 1}]


def test_recommendations_order_ties_by_id_and_unknown_last(rows):
    facts, _ = catalogue(rows, ("b", 8.5), ("a", 8.5), ("c", None), ("d", 9.0))
    listing = rows([(i, i, "US", None, None, 1.0, None) for i in "bacd"], LISTING)
    got = as_dicts(marts.mart_now_playing_recommendations(listing, facts).orderBy("recommendation_rank"))
    assert [r["movie_id"] for r in got] == ["d", "a", "b", "c"]
    first = as_dicts(marts.top_recommended_now_playing_movie(listing, facts))
    assert [r["movie_id"] for r in first] == ["c"]


def test_top_lists_are_cut_per_group(rows):
    facts, movies = catalogue(rows, *[(f"m{i:02}", i / 10) for i in range(30)])
    listing = rows([(f"m{i:02}", "n", r, None, None, 1.0, None) for i in range(30) for r in ("US", "IN")], LISTING)
    assert [r["movie_rank"] for r in as_dicts(marts.mart_top_movies(facts, movies, KeptTables(facts.sparkSession)).orderBy("movie_rank"))] == list(
        range(1, 11)
    )
    got = marts.mart_now_playing_recommendations(listing, facts).groupBy("tmdb_region").count()
    assert tuples(got) == [("IN", 5), ("US", 5)]


CREDITS = "imdb_id string, person_id string, job_role string"
PERSONS = "person_id string, person_name string, birth_year int, death_year int"


def brute_force_people(movies, facts, credits, persons):
    """The ranking as plain joins and groups, repeated ids included."""
    rated = [
        (i, a if a is not None else c) for i, a, b, c, d in facts if (b or 0) >= 100_000 or (d or 0) >= 100_000
    ]
    groups = defaultdict(list)
    for movie_id, imdb_id, *_ in movies:
        for credit_imdb, person, role in credits:
            if imdb_id is not None and credit_imdb == imdb_id and person is not None:
                groups[person, role] += [(movie_id, r) for i, r in rated if i == movie_id]
    names = dict((p[0], p[1]) for p in persons)
    by_role = defaultdict(list)
    for (person, role), hits in groups.items():
        minimum = rules.ROLE_MINIMUMS.get(role)
        known = [r for _, r in hits if r is not None]
        if minimum and len({m for m, _ in hits}) >= minimum:
            mean = sum(round(r * 10) for r in known) / 10 / len(known) if known else None
            by_role[role].append((-(mean if mean is not None else float("-inf")), person, mean, len({m for m, _ in hits})))
    out = []
    for role, people in by_role.items():
        for rank, (_, person, mean, count) in enumerate(sorted(people), 1):
            if rank <= 20 and person in names:
                out.append((person, role, None if mean is None else round(mean, 9), rank, count))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_people_match_brute_force_with_repeats_and_duplicates(rows, seed):
    pick = random.Random(seed)
    movies = [(f"tt{i}", f"tt{i}", "n", 2000, 100) for i in range(12)]
    movies += [("tt1", "tt1", "n", 2000, 100), ("tmdb_7", "tt99", "n", 2000, 100), ("tmdb_8", None, "n", 2000, 100)]
    facts = [(m[0], pick.choice([None, pick.randrange(101) / 10]), pick.choice([50, 100_000, None]), 5.5,
              pick.choice([None, 100_000])) for m in movies]
    facts = [(i, a, b, None if pick.random() < 0.3 else c, d) for i, a, b, c, d in facts]
    people = [f"nm{i}" for i in range(40)]
    credits = [
        (f"tt{pick.choice([*range(12), 1, 1, 99])}", pick.choice([*people, "nm0", None]),
         pick.choice(["director", "director", "writer", "actor", "self"]))
        for _ in range(1500)
    ]
    persons = [(p, p.upper(), 1950, None) for p in people if p != "nm3"]
    movie_df, fact_df = rows(movies, MOVIES), rows(facts, RATINGS)
    headline = marts.headline_titles(movie_df, marts.headline_ratings(fact_df))
    got = marts.mart_top_people(rows(credits, CREDITS), headline, rows(persons, PERSONS))
    keep = [(r.person_id, r.job_role, None if r.person_rating is None else round(r.person_rating, 9), r.job_rank,
             r.movie_count) for r in got.collect()]
    assert sorted(keep, key=repr) == brute_force_people(movies, facts, credits, persons)
    assert keep


def test_genre_and_decade_means(rows):
    facts = rows(
        [("a", 8.0, 1000, None, None), ("b", None, None, 6.5, 1000), ("c", 1.0, 999, None, None), ("d", None, 5000, None, 0)],
        RATINGS,
    )
    genres = rows([("a", "x"), ("b", "x"), ("c", "x"), ("d", "y"), ("a", "z")], "movie_id string, genre_name string")
    assert tuples(marts.average_rating_by_genre(genres, facts)) == [("x", 7.25), ("y", None), ("z", 8.0)]
    assert tuples(kpis.top_rated_genre(genres, facts)) == [("y", None)]
    movies = rows(
        [("a", "a", "n", 1975, 40), ("b", "b", "n", 1889, 300), ("c", "c", "n", 1960, 39), ("d", "d", "n", 1999, None)], MOVIES
    )
    era = marts.era_ratings(movies, facts)
    assert tuples(marts.decade_avg_rating(era)) == [("1960s", 1.0), ("1970s", 8.0), (None, 6.5)]
    assert tuples(marts.no_of_movies_every_decade(movies)) == [("1970s", 1)]
    assert tuples(marts.average_runtime_by_genre(genres, movies)) == [("x", 170.0), ("z", 40.0)]
    assert kpis.average_runtime(movies).first()[0] == 170.0


def test_top_years_sort_on_the_rounded_mean(rows):
    ids = [(f"m{y}{i}", y, r) for y, r in ((2001, 8.001), (2000, 8.004), (2002, 9.0)) for i in range(5)]
    ids = [x for x in ids if x[0] != "m20024"]  # four titles are too few
    movies = rows([(i, i, "n", y, 100) for i, y, _ in ids], MOVIES)
    facts = rows([(i, r, 10_000, None, None) for i, _, r in ids], RATINGS)
    years = marts.mart_top_years(marts.era_ratings(movies, facts))
    assert [tuple(r) for r in years.collect()] == [(2000, 8.0, 5), (2001, 8.0, 5)]


def test_counts(rows):
    import datetime

    day = datetime.date
    listing = rows(
        [("a", "a", "US", None, None, 1.0, day(2026, 1, 1)), ("a", "a", "US", None, None, 1.0, day(2026, 1, 2)),
         ("b", "b", "IN", None, None, 1.0, None)],
        LISTING,
    )
    assert tuples(kpis.number_of_movies_now_playing(listing)) == [("IN", 1), ("US", 2)]
    assert kpis.latest_now_playing_snapshot(listing).first()[0] == day(2026, 1, 2)
    movies = rows([("a", "a", "n", 1, 1), ("a", "a", "n", 1, 1), ("b", None, "n", 1, 1)], MOVIES)
    assert kpis.total_movies(movies).first()[0] == 2
    assert kpis.total_genres(rows([(1,), (2,)], "genre_id int")).first()[0] == 2
