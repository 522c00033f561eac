from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import strategies as st

from catalogmart.llm import sharding


@cases(st.integers(1, 3_000), st.integers(0, 1 << 40))
def test_feistel_permutes_and_restores(n, seed):
    f = sharding.Feistel(n, seed)
    out = f.permute(np.arange(n))
    assert sorted(out) == list(range(n))
    assert (f.restore(out) == np.arange(n)).all()


def test_feistel_shuffles():
    out = sharding.Feistel(100_000).permute(np.arange(100_000))
    assert abs(np.corrcoef(out, np.arange(100_000))[0, 1]) < 0.02
    assert (out != sharding.Feistel(100_000, 5).permute(np.arange(100_000))).any()


@pytest.mark.parametrize("source", ["given", "messy"])
def test_rows_law(given, messy, source):
    docs = given("documents") if source == "given" else messy
    rows = sharding.shard_rows(docs).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(8)) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(counts[shard]))
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    ordered = sorted(rows, key=lambda r: r["row_number"])
    assert [r["row_number"] for r in ordered] == list(range(len(rows)))
    ids = [r["doc_id"] for r in ordered if r["doc_id"] is not None]
    assert ids == sorted(ids) and ordered[-1]["doc_id"] == max((r["doc_id"] for r in rows), key=lambda x: (x is None, x))


def test_the_same_place_in_any_partitioning(given):
    docs = given("documents")
    place = lambda df: {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_rows(df).collect()}
    assert place(docs) == place(docs.repartition(7))


def test_empty_table(nothing):
    assert sharding.shard_rows(nothing).collect() == []


def test_one_id_for_a_third_of_the_rows(spark):
    df = spark.range(3_000).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "'t' AS text")
    rows = sharding.shard_rows(df).collect()
    assert len({(r["shard"], r["slot"]) for r in rows}) == 3_000
