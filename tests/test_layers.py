"""Raw loading, layer writing and the whole public contract."""

from __future__ import annotations

import datetime
from functools import partial
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalogmart.operators import checks, contract
from catalogmart.plans import curated, layers, marts, public, quality, validate
from catalogmart.plans.build import Catalogue
from catalogmart.sources.schemas import CSV_RELATIONS, RAW_SCHEMAS, TSV_RELATIONS
from catalogmart.sources.tables import EmptyLoadError, KeptTables
from catalogmart.sources.versions import Versions
from tests.conftest import tuples
from workload.raw import Given

FOLDER = "/root/testdata/sf0.001"
AS_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def land(given, folder):
    paths = {}
    for relation in RAW_SCHEMAS:
        paths[relation] = f"{folder}/{relation}"
        if relation in TSV_RELATIONS:
            given[relation].write.csv(
                paths[relation], sep="\t", header=True, nullValue="\\N", quote="", compression="gzip", **AS_IS
            )
        else:
            given[relation].write.csv(paths[relation], header=True, quote='"', escape='"', **AS_IS)
    return paths


def test_landed_files_to_tables_and_back(spark, tmp_path):
    given = Given(spark, FOLDER)
    paths = land(given, str(tmp_path / "landed"))
    assert set(paths) == {*TSV_RELATIONS, *CSV_RELATIONS}
    raw = layers.load_raw(spark, paths, "raw_layer", str(tmp_path / "raw"))
    for relation, table in raw.items():
        assert tuples(table) == tuples(given[relation])

    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "genres.csv").write_text("id,name\n")
    with pytest.raises(EmptyLoadError):
        layers.load_raw(spark, {"genres": str(tmp_path / "empty")}, "raw_layer", str(tmp_path / "raw"))
    assert spark.table("raw_layer.genres").count() == given["genres"].count()

    loaded, direct = Catalogue(spark, raw), Catalogue(spark, given)
    assert tuples(loaded.fct_movie_ratings) == tuples(direct.fct_movie_ratings)

    build = partial(layers.build_layers, spark, raw, str(tmp_path / "built"), "curated_layer", "analytics_layer")
    built = build()
    assert tuples(spark.table("curated_layer.dim_movies")) == tuples(direct.dim_movies)
    assert tuples(spark.table("analytics_layer.mart_top_people")) == tuples(direct.mart_top_people)
    assert tuples(spark.table("stg_genres")) == tuples(direct.stg_genres)
    assert len(layers.STAGING + layers.CURATED + layers.ANALYTICS) == 36
    assert all("/built/" in name for name in built.mart_rating_distribution.inputFiles())
    assert tuples(quality.summary(built)) == tuples(quality.summary(direct))
    build()  # a rebuild replaces every table
    for name in layers.ANALYTICS:
        assert tuples(spark.table(f"analytics_layer.{name}")) == tuples(getattr(direct, name))
    for database in ("raw_layer", "curated_layer", "analytics_layer"):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    for view in layers.STAGING:
        spark.catalog.dropTempView(view)


def test_bucketed_layers_join_without_a_shuffle(spark, tmp_path):
    given = Given(spark, FOLDER)
    build = partial(layers.build_layers, spark, given, str(tmp_path), "curated_bucketed", "analytics_bucketed")
    build(buckets=4)
    built = build(buckets=4)  # as the next version
    with pytest.raises(ValueError):
        build(buckets=5)
    direct = Catalogue(spark, given)
    for name in layers.CURATED:
        assert tuples(spark.table(f"curated_bucketed.{name}")) == tuples(getattr(direct, name))
    live = Versions(spark, f"{tmp_path}/curated_bucketed/dim_movies").latest()
    assert live.number == 2 and len(list(Path(live.slot).glob("*.parquet"))) == 4
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = {
            "rating": marts.average_rating_by_genre(built.bridge_movie_genres, built.fct_movie_ratings),
            "runtime": marts.average_runtime_by_genre(built.bridge_movie_genres, built.dim_movies),
            "era": marts.era_ratings(built.dim_movies, built.fct_movie_ratings),
        }
        for df in joined.values():
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "hashpartitioning(movie_id" not in plan
        assert tuples(joined["rating"]) == tuples(direct.average_rating_by_genre)
        assert tuples(joined["era"]) == tuples(direct.era_ratings)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for database in ("curated_bucketed", "analytics_bucketed"):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    for view in layers.STAGING:
        spark.catalog.dropTempView(view)


def test_declared_tests_by_name(spark):
    found = quality.violations(Catalogue(spark, Given(spark, FOLDER)))
    assert len(found) == 67
    clean = ["not_null dim_movies.movie_id", "unique dim_movies.movie_id", "ids_excluded", "label_excluded", "rank_order",
             "histogram", "relationships fct_movie_ratings.movie_id"]
    for name in clean:
        assert found[name].isEmpty(), name
    assert not found["unique_key stg_title_principals"].isEmpty()


DAY = datetime.date(2026, 10, 1)
TITLE = "movie_id string, title string, rating double, votes bigint"
# A small document that meets the contract.
GOLDEN = {
    "total_movies": ([(12,)], "total_movies bigint"),
    "rated_movies": ([(10,)], "rated_movies bigint"),
    "avg_rating": ([(7.8,)], "avg_rating double"),
    "avg_runtime_minutes": ([(112.5,)], "avg_runtime_minutes double"),
    "highest_rated_movie": ([("synthetic-a", "Aurora", 10.0, 150000)], TITLE),
    "most_voted_movie": ([("synthetic-b", "Beacon", 9.9, 180000)], TITLE),
    "rating_bins": (
        [("7-8", 7, 3, 60.0, 5), ("9-10", 9, 2, 40.0, 5)],
        "bracket string, order int, movie_count bigint, percentage double, population_count bigint",
    ),
    "genre_ratings": ([("Adventure", 8.8), ("Drama", 7.2)], "genre string, avg_rating double"),
    "genre_runtimes": ([("Adventure", 125.0), ("Drama", 100.0)], "genre string, avg_runtime_minutes double"),
    "decade_counts": ([("1990s", 5), ("2020s", 7)], "decade string, movie_count bigint"),
    "decade_ratings": ([("1990s", 8.0), ("2020s", 7.6)], "decade string, avg_rating double"),
    "top_years": ([(1, 1995, 8.0, 5)], "rank int, year int, avg_rating double, movie_count bigint"),
    "top_movies": (
        [(1, "synthetic-a", "Aurora", 10.0, 150000), (2, "synthetic-b", "Beacon", 9.9, 180000)],
        "rank int, " + TITLE,
    ),
    "people": (
        [("actor", 1, "person-a", "Actor A", 5, 8.5), ("director", 1, "person-b", "Director B", 3, 8.4)],
        "role string, rank int, person_id string, name string, movie_count bigint, avg_rating double",
    ),
    "region_counts": ([("IN", 1), ("US", 2)], "region string, movie_count bigint"),
    "recommendations": (
        [("US", 1, "synthetic-a", "Aurora", 10.0, 150000, datetime.date(2026, 9, 1), "Invented.", 12.5)],
        "region string, rank int, " + TITLE + ", release_date date, overview string, popularity double",
    ),
    "latest_snapshot_date": ([(DAY,)], "latest_snapshot_date date"),
    "captures": (
        [("IN", DAY, DAY, 1, 1, 1), ("US", DAY, DAY, 2, 2, 2)],
        "region string, min_capture_date date, max_capture_date date, row_count bigint, unique_movie_count bigint, "
        "capture_date_count bigint",
    ),
}


def document(rows, **changes):
    return {name: rows(changes.get(name, data), schema) for name, (data, schema) in GOLDEN.items()}


@pytest.mark.parametrize("changes", [{}, {"highest_rated_movie": [], "recommendations": []}])
def test_golden_document_meets_the_contract(rows, changes):
    assert validate.summary(document(rows, **changes)).filter("violations > 0").isEmpty()


@pytest.mark.parametrize(
    ("changes", "broken"),
    [
        ({"total_movies": []}, {"one_row total_movies", "populations"}),
        ({"rated_movies": [(13,)]}, {"populations"}),
        ({"rated_movies": [(4,)]}, {"populations"}),
        ({"top_movies": [(1, "a", None, 9.0, 5), (2, "a", None, 8.0, 5)]}, {"identity top_movies"}),
        ({"top_movies": [(1, "a", None, 9.0, 5), (3, "b", None, 8.0, 5)]}, {"ranks top_movies"}),
        ({"top_movies": [(1, "b", None, 9.0, 5), (2, "a", None, 9.0, 5)]}, {"ranks top_movies"}),
        ({"top_movies": [(1, "a", None, None, 5), (2, "b", None, 8.0, 5)]}, {"ranks top_movies"}),
        ({"top_movies": [(1, "a", None, 10.1, 5)]}, {"fields top_movies"}),
        ({"people": [("actor", 1, "p", "P", 4, 8.5)]}, {"roles"}),
        ({"people": [("self", 1, "p", "P", 5, 8.5)]}, {"fields people"}),
        ({"region_counts": [("US", 2)]}, {"regions", "captures"}),
        ({"latest_snapshot_date": [(datetime.date(2026, 9, 30),)]}, {"latest"}),
        ({"decade_counts": [("1990s", 5), ("1990s", 7)]}, {"identity decade_counts"}),
        ({"decade_ratings": [("2030s", 5.0)]}, {"fields decade_ratings"}),
        ({"genre_ratings": [("", 5.0)]}, {"fields genre_ratings"}),
        ({"avg_runtime_minutes": [(39.0,)]}, {"fields avg_runtime_minutes"}),
        ({"rating_bins": [("7-8", 7, 3, 60.0, 5), ("9-10", 9, 2, 41.0, 5)]}, {"bins"}),
    ],
)
def test_contract_faults_are_named(rows, changes, broken):
    issues = validate.contract_issues(document(rows, **changes))
    assert not [name for name in broken if issues[name].isEmpty()]


def test_published_order_dates_and_sequence_are_checked(rows):
    good = document(rows)
    for name in validate.UNRANKED_LISTS:
        good[name] = good[name].withColumn("position", F.row_number().over(Window.orderBy(*validate.UNRANKED_LISTS[name][1]())))
    instants = lambda a, b: rows([(a, b)], "completed string, exported string")
    fine = instants("2026-10-01T10:00:00Z", "2026-10-01T11:00:00Z")
    assert validate.summary(good, fine).filter("violations > 0").isEmpty()
    swapped = good | {"genre_ratings": good["genre_ratings"].withColumn("position", 3 - F.col("position"))}
    broken = {r["check"] for r in validate.summary(swapped, instants("2026-10-01T12:00:00Z", "2026-10-01T11:00:00Z")).filter("violations > 0").collect()}
    assert broken == {"order genre_ratings", "sequence"}
    texts = good | {"recommendations": good["recommendations"].withColumn("release_date", F.lit("2026-02-30"))}
    assert not validate.contract_issues(texts)["dates recommendations"].isEmpty()


def test_positions_are_those_of_the_written_list(spark, rows):
    """A list written in another order than the published one is found, whatever its values say."""
    kept, good = KeptTables(spark), document(rows)
    written = lambda name, *order: kept.keep_listed(name, good[name].orderBy(*order), validate.POSITION)
    right = {"genre_ratings": written("genre_ratings", F.desc("avg_rating")), "people": written("people", "role", "rank")}
    assert validate.summary(good | right).filter("violations > 0").isEmpty()
    wrong = {"genre_ratings": written("genre_ratings", "avg_rating"), "people": written("people", F.desc("role"))}
    broken = {r["check"] for r in validate.summary(good | wrong).filter("violations > 0").collect()}
    assert broken == {"order genre_ratings", "order people"}


def test_written_lists_stand_in_one_file(spark):
    listed = KeptTables(spark).keep_listed("many", spark.range(0, 500, 1, 7).orderBy(F.desc("id")), "position")
    assert [(r["position"], r["id"]) for r in listed.collect()] == [(k + 1, 499 - k) for k in range(500)]
    assert len(listed.inputFiles()) == 1


def test_publication_instants_are_checked(spark):
    c = Catalogue(spark, Given(spark, FOLDER))
    assert contract.sequence_issues(public.publication(c), "completed", "exported").isEmpty()
    assert validate.summary(c.public_results, public.publication(c)).filter("check = 'sequence'").first()["violations"] == 0


def test_relations_are_built_once_and_side_by_side(spark):
    """Threads that want one relation wait for it; those that need others do not stand in each other's way."""
    built = []

    class Counting(KeptTables):
        def keep(self, name, df):
            built.append(name)
            return super().keep(name, df)

    c = Catalogue(spark, Given(spark, FOLDER), Counting(spark))
    c.build(["fct_movie_ratings", "bridge_movie_people", "dim_movies", "era_ratings", "fct_now_playing"] * 2)
    assert sorted(built) == sorted(set(built)) and {"dim_movies", "fct_movie_ratings", "excluded_imdb"} <= set(built)


def test_a_failing_relation_leaves_its_old_version(spark, tmp_path):
    given = Given(spark, FOLDER)
    build = lambda raw: layers.build_layers(spark, raw, str(tmp_path), "curated_failing", "analytics_failing")
    build(given)
    broken = {name: given[name] for name in (*TSV_RELATIONS, *CSV_RELATIONS)}
    broken["name_basics"] = given["name_basics"].withColumn("primaryname", F.raise_error(F.lit("broken names")).cast("string"))
    with pytest.raises(PySparkException, match="broken names"):
        build(broken)
    versions = {name: Versions(spark, f"{tmp_path}/curated_failing/{name}").latest().number for name in ("dim_person", "dim_movies", "dim_genre")}
    assert versions == {"dim_person": 1, "dim_movies": 2, "dim_genre": 2}
    assert spark.table("curated_failing.dim_person").count() == given["name_basics"].count()
    for database in ("curated_failing", "analytics_failing"):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    for view in layers.STAGING:
        spark.catalog.dropTempView(view)


def test_column_tests_take_one_exchange_a_relation(rows):
    df = rows([(1, "a", None), (1, None, 2), (2, "a", None), (None, "b", None), (None, "c", 2)], "k int, s string, n int")
    known, keys = {"known k": "k", "known n": "n"}, {"key": ("k", "n"), "wide": ("k", "s", "n")}

    def violations(df):
        names = [*known, "unique k", "unique s", *keys]
        tallied = checks.column_counts(df, known, {"unique k": "k", "unique s": "s"}, keys, "test")
        return dict(map(tuple, checks.counted({"rows": df.filter("k = 1")}, "test", [tallied], names).collect()))

    assert violations(df) == {"known k": 2, "known n": 3, "unique k": 1, "unique s": 1, "key": 0, "wide": 0, "rows": 2}
    assert violations(df.unionAll(df)) == {"known k": 4, "known n": 6, "unique k": 2, "unique s": 3, "key": 5, "wide": 5, "rows": 4}
    assert violations(df.limit(0)) == dict.fromkeys(["known k", "known n", "unique k", "unique s", "key", "wide", "rows"], 0)
    plan = checks.column_counts(df, known, {"unique k": "k"}, keys, "test")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan") == 1


def test_every_given_row_reaches_its_raw_relation(spark):
    given = Given(spark, FOLDER)
    assert given["now_playing"].count() == given.table("events").count()
    counted = given.table("lineitem").groupBy("l_partkey").count()
    assert given["title_ratings"].count() == counted.count()
    assert given["title_principals"].count() == given.table("lineitem").count()
    assert given["title_ratings"].filter("averagerating IS NULL").count() > 0


def test_curated_plans_read_their_inputs_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = Catalogue(spark, Given(spark, FOLDER))
        fact = curated.fct_movie_ratings(c.dim_movies, c._ratings, c._details)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 3 and plan.count("SortMergeJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
