"""Quality checks, public contract and presentation operators."""

from __future__ import annotations

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalogmart.functions.public_text import multiset_digest
from catalogmart.operators import checks, contract
from catalogmart.operators.exclusion import ExcludedIds
from catalogmart.plans import present, public
from tests.conftest import as_dicts, tuples
from tests.test_functions import TOKEN_CASES

BINS = "bracket string, order int, movie_count bigint, percentage double, population_count bigint"
GOOD_BINS = [("7-8", 7, 3, 60.0, 5), ("9-10", 9, 2, 40.0, 5)]


def test_generic_checks(rows):
    df = rows([(1, "a"), (1, "b"), (None, "a"), (None, None)], "id int, s string")
    assert tuples(checks.null_rows(df, "s")) == [(None, None)]
    assert tuples(checks.repeated_values(df, "id")) == [(1, 2)]
    assert tuples(checks.repeated_keys(df, ["id"])) == [(1, 2), (None, 2)]
    assert tuples(checks.unaccepted_values(df, "s", ["a"])) == [("b", 1)]
    assert tuples(checks.orphans(df, "s", rows([("a",), ("a",)], "name string"), "name")) == [(1, "b")]


def test_long_form_range_checks(rows):
    df = rows([("a", 10.0, -0.1), ("b", 10.1, None)], "movie_id string, x double, y double")
    assert tuples(checks.outside_range(df, "movie_id", ["x", "y"])) == [("a", "y", -0.1), ("b", "x", 10.1)]
    assert tuples(checks.negative_values(df, "movie_id", ["x", "y"])) == [("a", "y", -0.1)]


def test_excluded_labels_and_ids(rows):
    genres = rows([(" News ",), ("Newsreel",), (None,)], "genre_name string")
    assert tuples(checks.label_occurrences({"g": genres}, "news")) == [("g", " News ")]
    excluded = ExcludedIds(rows([("tt1",)], "imdb_id string"), rows([(5,)], "tmdb_id bigint"))
    relations = {
        "both": rows([("tt1", 5), ("tt2", 5), ("tt1", None), (None, None), ("tt3", 6)], "imdb_id string, tmdb_id bigint"),
        "one": rows([("tt1",)], "imdb_id string"),
    }
    assert tuples(checks.excluded_occurrences(relations, excluded)) == sorted(
        [("both", "tt1", 5), ("both", "tt1", 5), ("both", "tt2", 5), ("both", "tt1", None), ("one", "tt1", None)], key=repr
    )


def test_token_cases_pass(rows):
    assert checks.mismatched_tokens(rows(TOKEN_CASES, "genres string, expected boolean"), "news").isEmpty()


HISTOGRAM = (
    "rating_bracket string, bucket_order int, movie_count bigint, percentage_of_movies double, total_no_of_movies bigint"
)


@pytest.mark.parametrize(
    ("data", "issues"),
    [
        (GOOD_BINS, []),
        ([], []),
        ([("7-8", 7, 3, 60.0, 5), ("7-8", 7, 2, 40.0, 5)], ["repeated_bins"]),
        ([("7-8", 8, 3, 60.0, 5), ("9-10", 9, 2, 40.0, 5)], ["misnamed"]),
        ([("7-8", 7, 3, 60.0, 5), ("9-10", 9, 2, 40.0, 6)], ["counts_do_not_add_up", "several_populations"]),
        ([("7-8", 7, 3, 59.0, 5), ("9-10", 9, 2, 40.0, 5)], ["percentages_do_not_add_up"]),
        ([(None, 9, 5, 100.0, 5)], ["misnamed"]),
        ([("10-11", 10, 5, 100.0, 5)], ["no_such_bin"]),
        ([("9-10", 9, -1, 100.0, 5)], ["count_out_of_bounds", "counts_do_not_add_up"]),
    ],
)
def test_histogram_invariants(rows, data, issues):
    assert [r[0] for r in tuples(checks.histogram_issues(rows(data, HISTOGRAM)))] == issues


def bin_issues(rows, data, population=None):
    return sorted({r[0] for r in contract.bin_issues(rows(data, BINS), population).collect()})


def test_bin_faults_are_found(rows):
    first, second = GOOD_BINS
    assert bin_issues(rows, GOOD_BINS) == []
    assert bin_issues(rows, []) == []
    assert bin_issues(rows, [], population=5) == ["count_sum", "percentage_sum"] or bin_issues(rows, [], 5) == ["count_sum"]
    assert "repeated_order" in bin_issues(rows, [*GOOD_BINS, first])
    assert "count_sum" in bin_issues(rows, [("7-8", 7, 4, 60.0, 5), second])
    assert "percentage_sum" in bin_issues(rows, [("7-8", 7, 3, 59.0, 5), second])
    assert "label" in bin_issues(rows, [("6-7", 7, 3, 60.0, 5), second])
    assert bin_issues(rows, [("7-8", 7, 3, 55.0, 5), ("9-10", 9, 2, 45.0, 5)]) == ["share"]
    assert "population" in bin_issues(rows, [first, ("9-10", 9, 2, 40.0, 6)])
    assert "unexpected_bin" in bin_issues(rows, [("7-8", 7, 0, 0.0, 0)])


def test_accumulated_rounding_is_tolerated(rows):
    data = [(f"{i}-{i + 1}", i, n, round(n / 30 * 100, 2), 30) for i, n in enumerate([1] * 9 + [21])]
    assert round(sum(row[3] for row in data), 2) == 99.97
    assert bin_issues(rows, data) == []


def test_cardinality_identity_and_rank_checks(rows):
    one, none, two = (rows([(i,) for i in range(n)], "n int") for n in (1, 0, 2))
    assert contract.not_one_row(one, "x").isEmpty() and contract.not_one_row(none, "x", optional=True).isEmpty()
    assert tuples(contract.not_one_row(none, "x")) == [("x", 0)]
    assert tuples(contract.not_one_row(two, "x", optional=True)) == [("x", 2)]
    people = rows(
        [("actor", 1, "a", 9.0), ("actor", 2, "b", 8.0), ("actor", 4, "c", None), ("writer", 1, "a", 1.0), ("writer", 2, "a", 1.0)],
        "role string, rank int, person_id string, avg_rating double",
    )
    assert tuples(contract.repeated_identities(people, "person_id", ["role"])) == [("writer", "a", 2)]
    order = [F.col("avg_rating").desc_nulls_last(), F.col("person_id").asc()]
    broken = contract.broken_ranks(people.filter("role = 'actor'"), order, ["role"])
    assert tuples(broken.select("rank", "expected_rank")) == [(4, 3)]


def test_population_chain(rows):
    n = lambda value: rows([(value,)], "n bigint")
    assert contract.population_chain(n(5), n(10), n(12)).isEmpty()
    assert contract.population_chain(rows([], "n bigint"), n(0), n(0)).isEmpty()
    assert tuples(contract.population_chain(n(5), n(13), n(12))) == [(5, 13, 12)]
    assert tuples(contract.population_chain(n(11), n(10), n(12))) == [(11, 10, 12)]


def test_role_limits(rows):
    people = [("actor", 5)] * 20 + [("director", 3)] * 21 + [("writer", 3)]
    got = contract.role_limit_issues(rows(people, "role string, movie_count bigint"))
    assert tuples(got) == [("director", 21, 0), ("writer", 1, 1)]


def test_region_coverage(rows):
    counts, recs = "region string, movie_count bigint", "region string"
    check = lambda c, r: tuples(contract.region_coverage_issues(rows(c, counts), rows(r, recs)))
    assert check([("US", 2), ("IN", 1)], [("US",)]) == []
    assert check([("US", 0)], []) == [("IN", "missing_region"), ("US", "no_titles")]
    assert check([("US", 1), ("IN", 1), ("XX", 1)], [("US",), ("US",)]) == [
        ("US", "too_many_recommendations"),
        ("XX", "unsupported_region"),
    ]


def test_capture_reconciliation(rows):
    day = datetime.date
    schema = (
        "region string, min_capture_date date, max_capture_date date, row_count bigint, unique_movie_count bigint, "
        "capture_date_count bigint"
    )
    counts = rows([("US", 2), ("IN", 1)], "region string, movie_count bigint")
    good = [("US", day(2026, 10, 1), day(2026, 10, 1), 2, 2, 2), ("IN", day(2026, 10, 1), day(2026, 10, 1), 1, 1, 1)]
    issues = lambda data: tuples(contract.capture_issues(rows(data, schema), counts))
    assert issues(good) == []
    assert issues([("US", day(2026, 9, 30), day(2026, 10, 1), 2, 2, 2), good[1]]) == [("US", False, True)]
    assert issues([("US", None, None, 2, 2, 0), good[1]]) == [("US", True, True)]
    assert issues([("US", *good[0][1:3], 2, 0, 2), good[1]]) == [("US", True, False)]
    assert issues([("US", *good[0][1:3], 9, 9, 9), good[1]]) == [("US", True, False)]
    strange = [("XX", *good[0][1:3], 2, 2, 2)]
    assert issues(strange) == [("IN", True, True), ("US", True, True), ("XX", True, False)]
    assert issues(good[1:]) == [(good[0][0], True, True)]
    gone = contract.capture_issues(rows(good, schema), counts.limit(0))
    assert tuples(gone) == sorted((g[0], True, False) for g in good)
    latest = rows([(day(2026, 10, 1),)], "d date")
    assert contract.latest_mismatch(latest, rows(good, schema)).isEmpty()
    assert contract.latest_mismatch(latest, rows([], schema)).count() == 1


def test_dates_and_instants(rows):
    dates = rows([("2026-02-28",), ("2026-02-30",), ("2026-2-3",), (None,), ("x",)], "d string")
    assert tuples(contract.impossible_dates(dates, "d")) == [("2026-02-30",), ("2026-2-3",), ("x",)]
    pairs = rows(
        [("2026-10-01T11:00:00-07:00", "2026-10-01T18:00:00Z"), ("2026-10-01T18:00:01Z", "2026-10-01T11:00:00-07:00"),
         ("2026-10-01T18:00:00", "2026-10-01T19:00:00Z"), ("2026-13-01T18:00:00Z", "2026-10-01T19:00:00Z")],
        "completed string, exported string",
    )
    got = contract.sequence_issues(pairs, "completed", "exported").select("issue")
    assert tuples(got) == [("out_of_order",), ("unreadable",), ("unreadable",)]


def test_field_rules_are_closed_and_found_in_one_pass(rows):
    schema = "rank int, year int, avg_rating double, movie_count bigint"
    rules = public.FIELD_RULES["top_years"]
    assert contract.field_rule_issues(rows([(1, 1995, 8.0, 5), (2, 1996, None, 5)], schema), rules).isEmpty()
    got = contract.field_rule_issues(rows([(11, None, 10.1, 4)], schema), rules)
    assert tuples(got) == sorted(
        [("rank", "maximum", "11"), ("year", "required", None), ("avg_rating", "maximum", "10.1"), ("movie_count", "minimum", "4")],
        key=repr,
    )
    with pytest.raises(ValueError):
        contract.field_rule_issues(rows([(1, 1)], "rank int, extra int"), rules)
    decades = rows([("1890s", 1), ("2030s", 1), ("1880s", 1), ("2020s", -1)], "decade string, movie_count bigint")
    found = tuples(contract.field_rule_issues(decades, public.FIELD_RULES["decade_counts"]))
    assert found == [("decade", "pattern", "1880s"), ("decade", "pattern", "2030s"), ("movie_count", "minimum", "-1")]


def test_scalars_take_their_public_form(spark, rows):
    df = rows([(2.0, 1.25, None, "x", datetime.date(2026, 1, 2))], "a double, b double, c double, d string, e date")
    stamped = df.withColumn("f", F.lit("2026-10-01T11:00:00-07:00").cast("timestamp")).withColumn(
        "g", F.lit("2.00").cast("decimal(5,2)")
    )
    assert as_dicts(contract.normalize_scalars(stamped)) == [
        {"a": "2", "b": "1.25", "c": None, "d": "x", "e": "2026-01-02", "f": "2026-10-01T18:00:00Z", "g": "2"}
    ]
    for bad in ("nan", "inf", "-inf"):
        broken = rows([("k", float(bad))], "id string, v double")
        assert tuples(contract.non_finite_rows(broken, "id", ["v"])) == [("k", "v")]
        with pytest.raises(PySparkException):
            contract.normalize_scalars(broken).collect()
    with pytest.raises(ValueError):
        contract.normalize_scalars(df.select(F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("t")))


def test_fingerprint_ignores_row_order_and_partitioning(rows):
    schema = "decade string, movie_count bigint"
    data = [("1990s", 5), ("2020s", 7), (None, None)]
    first = tuples(contract.fingerprint(rows(data, schema), 3))
    assert first == tuples(contract.fingerprint(rows(data[::-1], schema).repartition(3).select("movie_count", "decade"), 3))
    assert first != tuples(contract.fingerprint(rows(data[:2], schema), 3))
    with pytest.raises(PySparkException):
        contract.fingerprint(rows(data, schema), 2).collect()


def test_dense_histogram_fills_zero_only_for_a_known_population(rows):
    got = present.dense_histogram(rows(GOOD_BINS, BINS)).orderBy("order")
    assert [r.percentage for r in got.collect()] == [0, 0, 0, 0, 0, 0, 0, 60, 0, 40]
    assert [r.bracket for r in got.collect()][:2] == ["0-1", "1-2"]
    assert present.dense_histogram(rows([], BINS)).isEmpty()
    assert present.dense_histogram(rows([("7-8", 7, 0, 0.0, 0)], BINS)).isEmpty()


def test_dense_decades_fill_null(rows):
    schema = "decade string, avg_rating double"
    got = dict(tuples(present.dense_decades(rows([("1990s", 8.0), ("2020s", 7.6)], schema), "avg_rating")))
    assert len(got) == 14 and got["1990s"] == 8.0 and got["2000s"] is None
    assert present.dense_decades(rows([], schema), "avg_rating").isEmpty()


def test_leaders_share_the_maximum(rows):
    df = rows([("a", 2.0), ("b", 2.0), ("c", 1.0), ("d", None)], "genre string, v double")
    assert tuples(present.leaders(df, "v")) == [("a", 2.0), ("b", 2.0)]
    assert present.leaders(df.filter("v IS NULL"), "v").isEmpty()
    odd = rows([("a", float("nan")), ("b", float("inf")), ("c", 1.0)], "genre string, v double")
    assert tuples(present.leaders(odd, "v")) == [("c", 1.0)]


def test_coverage_and_shared_leader(rows):
    n = lambda value: rows([(value,)], "n bigint")
    assert tuples(present.coverage_ratio(n(10), n(12))) == [(10, 12, 83.3)]
    assert tuples(present.coverage_ratio(n(0), n(0))) == [(0, 0, None)]
    title = lambda *ids: rows([(i,) for i in ids], "movie_id string")
    assert present.shared_leader(title("a"), title("a")).first().shared_leader
    assert not present.shared_leader(title("a"), title("b")).first().shared_leader
    assert not present.shared_leader(title(), title("b")).first().shared_leader


def test_freshness_counts_hours_for_builds_and_days_for_captures(rows):
    at = lambda text: F.lit(text).cast("timestamp")
    captures = rows([("US", datetime.date(2026, 10, 1)), ("IN", datetime.date(2026, 10, 2))],
                    "region string, max_capture_date date")
    exact = present.freshness(captures, at("2026-10-02T12:00:00Z"), at("2026-10-10T12:00:00Z"))
    assert tuples(exact.select("region", "build_stale", "capture_stale")) == [("IN", False, False), ("US", False, True)]
    late = present.freshness(captures, at("2026-10-02T11:59:59Z"), at("2026-10-10T12:00:00Z"))
    assert all(r.build_stale for r in late.collect())


def test_slices(rows):
    people = rows([("actor", 10, "a"), ("actor", 11, "b"), ("writer", 1, "c")], "role string, rank int, person_id string")
    assert present.people_for_role(people, "actor").count() == 2
    assert present.people_for_role(people, "actor", charted_only=True).count() == 1
    counts = rows([("US", 2), ("IN", 1)], "region string, movie_count bigint")
    captures = rows([("US", datetime.date(2026, 1, 1)), ("IN", datetime.date(2026, 1, 2))],
                    "region string, max_capture_date date")
    recs = rows([("US", 1, "a")], "region string, rank int, movie_id string")
    assert tuples(present.region_view(recs, counts, captures, "US")) == [("US", 2, datetime.date(2026, 1, 1), 1, "a")]
    assert tuples(present.region_view(recs, counts, captures, "IN")) == [("IN", 1, datetime.date(2026, 1, 2), None, None)]
    genres = rows([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "genre string, avg_rating double")
    ordered = present.genre_order(genres, "avg_rating").orderBy("position")
    assert [r.genre for r in ordered.collect()] == ["d", "a", "b", "c"]


def test_public_top_years_are_ranked_and_bounded(rows):
    schema = "release_year int, release_yr_avg_rating double, movie_count bigint"
    got = public.published("top_years", rows([(1996, 7.0, 5), (1995, 8.0, 5), (1994, 7.0, 6)], schema)).orderBy("rank")
    assert [tuple(r) for r in got.collect()] == [(1, 1995, 8.0, 5), (2, 1994, 7.0, 6), (3, 1996, 7.0, 5)]
    with pytest.raises(PySparkException, match="top_years has more than 10 rows"):
        public.published("top_years", rows([(1900 + i, 7.0, 5) for i in range(11)], schema)).collect()


@pytest.mark.parametrize(("name", "schema", "maximum"), [
    ("top_movies", "movie_rank int, movie_id string, movie_name string, avg_rating double, num_of_votes bigint", 10),
    ("people", "job_role string, job_rank int, person_id string, person_name string, movie_count bigint, person_rating double", 220),
    ("region_counts", "tmdb_region string, no_of_movies_now_playing bigint", 2),
])
def test_overflowing_lists_fail(rows, name, schema, maximum):
    width = len(schema.split(","))
    assert public.published(name, rows([(None,) * width] * maximum, schema)).count() == maximum
    with pytest.raises(PySparkException, match="more than"):
        public.published(name, rows([(None,) * width] * (maximum + 1), schema)).collect()


def test_field_rules_know_types(rows):
    titles = rows([("a", "A", 2.5, 2.5), ("b", "B", float("nan"), 3.0), ("c", "C", 1.0, None)], "movie_id string, title string, rating double, votes double")
    found = {(r["field"], r["rule"]) for r in contract.field_rule_issues(titles, public.TITLE_RULES).collect()}
    assert {("votes", "integer"), ("rating", "finite")} <= found and ("votes", "finite") not in found


def test_large_whole_numbers_keep_their_digits(rows):
    data = [(1e16,), (-(2.0**60),), (1e22,), (0.5,), (-0.0,), (None,)]
    got = [r[0] for r in contract.normalize_scalars(rows(data, "x double")).collect()]
    assert got == ["10000000000000000", "-1152921504606846976", "10000000000000000000000", "0.5", "0", None]
    for odd in (float("nan"), float("inf"), float("-inf")):
        with pytest.raises(Exception, match="not finite"):
            contract.normalize_scalars(rows([(odd,)], "x double")).collect()


def test_genres_of_any_number_are_placed(spark):
    many = spark.range(1_500).selectExpr("concat('g', id) AS genre", "if(id % 7 = 0, null, cast(id % 50 AS double)) AS avg_rating")
    places = [r["position"] for r in present.genre_order(many, "avg_rating").orderBy(F.col("avg_rating").desc_nulls_last(), "genre").collect()]
    assert places == list(range(1, 1_501))


def test_fingerprints_are_bounded_in_bytes(rows):
    df = rows([("x" * 100,)], "a string")
    assert contract.fingerprint(df, 5).first()["row_count"] == 1
    with pytest.raises(Exception, match="more than 50 bytes"):
        contract.fingerprint(df, 5, max_bytes=50).collect()


def test_digests_of_relations_ignore_order_and_count_repeats(rows):
    schema = "id bigint, name string, x double, day date"
    data = [(k, f"n{k % 7}" if k % 5 else None, k / 4, None) for k in range(200)]
    digest = lambda df, key="": tuple(multiset_digest(df, key).first())
    df = rows(data, schema)
    assert digest(df) == digest(rows(data[::-1], schema).repartition(7).select("x", "day", "name", "id"))
    others = [digest(rows(data[:-1], schema)), digest(rows([*data, data[0]], schema)), digest(df, "key")]
    others += [digest(df.withColumn("name", F.coalesce("name", F.lit("-")))), digest(df.withColumn("id", F.col("id") + 1))]
    assert len({digest(df), *others}) == 6
    assert digest(df.limit(0)) == (0, "0", "0")
    plan = multiset_digest(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "hashpartitioning" not in plan


def test_small_and_large_fractions_take_no_exponent(rows):
    data = [(0.0005,), (-0.000025,), (1.25e-9,), (12345678.5,), (9007199254740991.5 / 2,), (0.1,), (1e-300,), (123.456,)]
    got = [r[0] for r in contract.normalize_scalars(rows(data, "x double")).collect()]
    assert got == ["0.0005", "-0.000025", "0.00000000125", "12345678.5", "4503599627370496", "0.1", "1.0E-300", "123.456"]
