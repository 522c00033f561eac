from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from catalogmart.llm import mixing as m
from catalogmart.llm.common import Scratch
from tests.llm.conftest import by_id


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        rest = total - sum(3 * sizes[s] for s in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in open_) for s in order}
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("source", ["given", "messy"])
def test_mix(given, messy, source):
    docs = given("documents") if source == "given" else messy
    rows, sizes = docs.collect(), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    target = plain_targets(sizes)
    found = m.mix(docs).collect()
    assert len(found) == len(rows)
    taken, of = Counter(), {r["doc_id"]: r["source"] for r in rows}
    for r in found:
        s = of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
        assert sum(r["shard_words"]) == r["taken"] and len(r["shard_words"]) == m.SHARDS
    block = plain_block(sizes)
    assert all(abs(taken[s] - target[s]) <= block + 1 for s in sizes)
    assert sorted(map(repr, found)) == sorted(map(repr, m.mix(docs.repartition(5)).collect()))


def plain_block(sizes):
    return max(1, min((n for n in sizes.values() if n), default=0) // m.BLOCKS_PER_SOURCE)


@pytest.mark.parametrize("small", [1, 2, 60, 700])
def test_small_sources_reach_their_targets(spark, small):
    """A source of a few words beside large ones takes its target, the ceiling of three times its size."""
    rows = [(k, "w " * 5_000, "ac"[k % 2]) for k in range(40)] + [(100 + k, "x", "b") for k in range(small)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found, sizes = m.mix(df).collect(), words_by_source(df.collect())
    target, taken, of = plain_targets(sizes), Counter(), {r[0]: r[2] for r in rows}
    for r in found:
        taken[of[r["doc_id"]]] += r["taken"]
    assert target["b"] == 3 * small and taken["b"] == 3 * small
    assert all(abs(taken[s] - target[s]) <= 2 for s in "ac") and sum(taken.values()) == sum(sizes.values())


def test_full_sources_leave_their_seats_to_the_others(spark):
    sizes = {0: 10, 1: 1_000, 2: 7, 3: 5_000, 4: 0}
    targets = {0: 30.0, 1: 2_300.0, 2: 21.0, 3: 3_666.0, 4: 0.0}
    df = spark.createDataFrame([(k, targets[k], sizes[k]) for k in sizes], "rank int, target double, source_size long")
    for block in (1, 2, 3, 4, 7):
        got = {r["rank"]: r["quota"] for r in m.seats(df, block, 6_017 // block, 6_017, 5).collect()}
        most = {k: 3 * n // block for k, n in sizes.items()}
        quotients = sorted((-targets[k] / (2 * j + 1), k, j) for k in sizes for j in range(most[k]))
        assert got == {k: Counter(x[1] for x in quotients[: 6_017 // block])[k] for k in sizes}


def test_each_shard_takes_its_quota(spark):
    """Shards are within a block of each other in total and in every source."""
    rows = [(k, "w " * (k % 37 + 1), "abcd"[k % 4 if k % 3 else 0]) for k in range(2_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    of, words = {r[0]: r[2] for r in rows}, defaultdict(lambda: [0] * m.SHARDS)
    for r in m.mix(df).collect():
        for source in (of[r["doc_id"]], "all"):
            words[source] = [a + b for a, b in zip(words[source], r["shard_words"])]
    block = plain_block(words_by_source(df.collect()))
    assert all(max(v) - min(v) <= block for v in words.values())


def highest(targets, total_seats):
    won = Counter()
    quotients = sorted(((-t / (2 * k + 1), s, k) for s, t in targets.items() for k in range(total_seats + 1)))
    for _, s, _ in quotients[:total_seats]:
        won[s] += 1
    return won


@pytest.mark.parametrize("shares", [(53, 24, 23), (1, 1, 1, 1), (1000, 1, 1, 1, 7), (10,), (340, 330, 165, 165)])
@pytest.mark.parametrize("total_seats", [1, 2, 10, 97])
def test_seats_are_the_highest_quotients(spark, shares, total_seats):
    total = sum(shares)
    df = spark.createDataFrame([(k, float(v), 10**9) for k, v in enumerate(shares)], "rank int, target double, source_size long")
    got = {r["rank"]: r["quota"] for r in m.seats(df, 1, total_seats, total, len(shares)).collect()}
    want = highest({k: float(v) for k, v in enumerate(shares)}, total_seats)
    assert sum(got.values()) == total_seats
    value = lambda won: sorted(v / (2 * k + 1) for s, v in enumerate(shares) for k in range(won[s]))
    assert value(Counter(got)) == value(want)


def test_shard_quotas_are_even(spark, given):
    scratch = Scratch(spark, "test")
    docs = given("documents")
    sources = docs.groupBy("source").agg({"n_chars": "sum"}).toDF("source", "source_size")
    total, n = sources.agg({"source_size": "sum"}).first()[0], sources.count()
    targets = scratch.keep(m.source_targets(sources))
    quotas = scratch.keep(m.seats(targets, total // 5_120, 5_120, total, n))
    rows = m.shard_quotas(quotas).collect()
    whole = [sum(r["by_shard"][k] for r in rows) for k in range(8)]
    assert sum(whole) == quotas.agg({"quota": "sum"}).first()[0] and max(whole) - min(whole) <= 1
    for r in rows:
        assert sum(r["by_shard"]) == r["quota"] and max(r["by_shard"]) - min(r["by_shard"]) <= 1


def test_no_python_in_the_plan(spark, given):
    plan = m.mix(given("documents"))._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "ExistingRDD", "Cartesian", "NestedLoop") if x in plan]


def test_empty_table_and_applied_mix(spark, nothing, messy):
    assert m.mix(nothing).collect() == []
    applied = m.apply_mix(messy)
    assert applied.columns == messy.columns
    copies = Counter(r["doc_id"] for r in applied.collect())
    taken = by_id(m.mix(messy))
    assert all(copies[i] == int(taken[i]["taken"] / taken[i]["size"] + 0.5) for i in (1, 2, 6, 8, 13))


def test_documents_without_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in m.mix(df).collect()] == [(0, 0, 0.0, 0)] * 2


def words_by_source(rows):
    words = Counter()
    for r in rows:
        words[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    return words


def test_applied_mix_meets_the_targets_in_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    target, got = plain_targets(words_by_source(rows)), words_by_source(m.apply_mix(docs).collect())
    longest = {s: max(words_by_source([r])[s] for r in rows if r["source"] == s) for s in target}
    assert all(abs(got[s] - target[s]) <= longest[s] / 2 + 1 for s in target)


def test_long_documents_stay_in_the_mix(spark):
    rows = [(k, f"w{k} " * 400, "abcc"[k % 4]) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target, got = plain_targets(words_by_source(df.collect())), words_by_source(m.apply_mix(df).collect())
    assert target["c"] < 0.4 * 60 * 400 and all(abs(got[s] - target[s]) <= 201 for s in "abc")


def test_rows_without_an_id_and_clashing_names(spark):
    """Null ids fall apart by their texts; names that operators like to use stay what they are."""
    rows = [(None if k % 2 else k, f"w{k} x y", "s", k, 1, 1) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __id long, times long, copy long")
    out = m.apply_mix(df)
    assert out.columns == df.columns and Counter(r["__id"] for r in out.collect()) == Counter(range(60))
    order = m.placed_rows(*_sized(spark, df), m.SEED, Scratch(spark, "test"))
    assert order.where("doc_id IS NULL").select("order").distinct().count() == 30


def _sized(spark, df):
    rows, sources = m.sized_rows(df, Scratch(spark, "test"), "doc_id", "text", "source")
    return rows, m.source_targets(sources)
