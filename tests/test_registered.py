"""Every registered query against its check SQL, and what its plan may contain."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, open_oracle
from workload.queries import SPARK, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(FOLDER)


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "rating_bracket" and not df.isEmpty()


def test_every_query_has_check_sql():
    assert set(SPARK) == set(SQL)
    assert set(SPARK) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("key", list(SPARK))
def test_query_agrees_with_its_check_sql(spark, oracle, key):
    assert compare(spark, oracle, FOLDER, key)[0] == "ok"


# Joins without an equality, and rows leaving the JVM.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "ExistingRDD")


@pytest.mark.parametrize("key", list(SPARK))
def test_plan_stays_in_the_jvm_without_nested_loops(spark, key):
    plan = queries()[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [name for name in FORBIDDEN if name in plan]


@pytest.mark.parametrize("key", ["latest_per_key", "top_people", "top_per_region", "kpi_top_recommended"])
def test_groups_are_limited_before_the_shuffle(spark, key):
    plan = queries()[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan.split("WindowGroupLimit", 1)[1]


BEYOND_BROADCAST = [
    "excluded_ids", "stg_principals", "latest_per_key", "merge_catalog", "genre_bridge", "people_bridge", "ratings_fact",
    "now_playing_fact", "top_people", "avg_rating_by_genre", "top_years", "check_ids_absent",
]


def test_results_hold_when_nothing_fits_a_broadcast(spark, oracle, monkeypatch):
    """The shuffled plans, on a catalogue of their own."""
    import workload.queries as registered

    monkeypatch.setattr(registered, "_CATALOGUES", {})
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        verdicts = {key: compare(spark, oracle, FOLDER, key)[0] for key in BEYOND_BROADCAST}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert set(verdicts.values()) == {"ok"}
