from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogmart.llm import exact_dedup as e
from catalogmart.llm.common import Scratch


def digests(n, tag=""):
    return [hashlib.sha256(f"{tag}{k}".encode()).digest() for k in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 50, 20_000])
def test_perfect_hash_is_minimal(n):
    own = digests(n)
    function = e.PerfectHash.unpack(e.PerfectHash.build(own).pack())
    if n:
        assert sorted(function.slots(own)) == list(range(n))
        assert function.slots(digests(500, "other")).max() < n


@pytest.mark.parametrize("source", ["given", "messy"])
def test_against_brute_force(given, messy, source):
    docs = given("documents") if source == "given" else messy
    rows, groups = docs.collect(), defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    want = []
    for r in rows:
        ids = groups[r["text"] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((r["doc_id"], keep, len(ids), r["doc_id"] == keep, hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in e.exact_dedup(docs).collect())


def test_members_are_found_and_nonmembers_group(spark):
    text = [(k, f"text {k % 700}") for k in range(2_000)]
    rows = spark.createDataFrame(text, "doc_id long, text string").select("doc_id", e.digest_of(F.col("text")).alias("digest"))
    found = e.winners(rows, F.col("doc_id") < 300, Scratch(spark, "test"), range_digests=40).collect()
    by_digest = {bytes(r["digest"]): r for r in found}
    assert len(found) == len(by_digest) == 700
    for k in range(700):
        own = [i for i, t in text if t == f"text {k}"]
        r = by_digest[hashlib.sha256(f"text {k}".encode()).digest()]
        assert (r["winner"], r["n"], r["member"]) == (max(own), len(own), k < 300)


def test_a_colliding_slot_is_no_member(spark):
    """A slot that answers for another digest is refused by the byte check."""
    own = digests(40)
    function = e.PerfectHash.build(own)
    assert (function.slots(digests(4_000, "x")) >= 0).any()


def test_a_third_of_all_rows_in_one_group(spark):
    df = spark.range(9_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same', concat('t', id)) AS text")
    rows = e.exact_dedup(df).where("group_size > 1").agg(F.count("*"), F.min("keep_id"), F.max("keep_id"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(rows) == (3_000, 8_997, 8_997, 1)


def test_empty_table_and_survivors(nothing, messy):
    assert e.exact_dedup(nothing).collect() == []
    kept = e.keep_one(messy)
    assert kept.columns == messy.columns
    bodies = [r["text"] or "" for r in kept.collect()]
    assert len(bodies) == len(set(bodies)) == len({r["text"] or "" for r in messy.collect()})


def test_other_ids_are_refused(messy):
    named = messy.withColumn("doc_id", F.concat(F.lit("x"), F.col("doc_id")))
    for operator in (e.exact_dedup, e.keep_one):
        with pytest.raises(TypeError, match="whole number"):
            operator(named)
