from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from catalogmart.llm import simhash
from catalogmart.llm.common import Scratch
from catalogmart.llm.components import components


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=2):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    arr = np.array(prints, np.uint64)
    for a in range(len(prints)):
        for b in np.flatnonzero(np.bitwise_count(arr ^ arr[a]) <= distance):
            x, y = find(a), find(int(b))
            root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(prints))]


def check(docs, found):
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    groups = plain_components(prints)
    least = {}
    for r, g in zip(rows, groups):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    want = [(r["doc_id"], f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, groups)]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in found.collect())


@pytest.mark.parametrize("source", ["given", "messy"])
def test_against_brute_force(given, messy, source):
    docs = given("documents") if source == "given" else messy
    check(docs, simhash.near_duplicates(docs))


def near_prints(n, seed=0):
    """Fingerprints in clusters: centres, points one or two bits off, chains, and many around one centre."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    out = [centres]
    for step in range(3):
        flips = np.zeros(n, np.uint64)
        for _ in range(2):
            flips ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        out.append(out[-1] ^ flips)
    crowd = centres[0] ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    return np.unique(np.concatenate([*out, crowd]))


@pytest.mark.parametrize("hot", [64, 3, 1])
@pytest.mark.parametrize("groups,thresholds", [(3, (0, 0, 0)), (3, (1, -1, 0)), (2, (1, 0)), (2, (0, 1)), (1, (2,)), (2, (2, -1))])
def test_every_allocation_finds_the_same_components(spark, groups, thresholds, hot):
    prints = near_prints(60)
    nodes = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    bits = np.array_split(np.random.default_rng(3).permutation(64), groups)
    plan = [simhash.Partition(tuple(map(int, b)), t) for b, t in zip(bits, thresholds) if t >= 0]
    scratch = Scratch(spark, "test")
    roots = {r["node"]: r["root"] for r in components(simhash.links(nodes, plan, 2, scratch, hot), scratch).collect()}
    label = plain_components(prints.tolist())
    mine = [roots.get(int(x), int(x)) for x in prints.view(np.int64)]
    assert len({*zip(mine, label)}) == len(set(mine)) == len(set(label))


def test_planned_thresholds_cover_the_distance(spark):
    nodes = spark.createDataFrame([(int(x),) for x in near_prints(200).view(np.int64)], "fp long")
    for n in (200, 10**7, 10**10):
        plan = simhash.plan_partitions(nodes, n)
        assert plan and all(p.threshold <= 2 for p in plan)
    groups = simhash.group_bits(simhash.correlations(nodes), 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    cost, thresholds = simhash.allocate(groups, [10.0, 10.0, 1e9], 1e4, 2)
    assert sum(thresholds) == 0 and thresholds[2] == -1


def test_correlated_bits_share_a_partition():
    correlation = np.eye(64)
    for a in range(0, 64, 2):
        correlation[a, a + 1] = correlation[a + 1, a] = 0.9
    groups = simhash.group_bits(correlation, 2)
    assert all((a + 1 in g) == (a in g) for g in groups for a in range(0, 64, 2))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (300, 301), (301, 300)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    assert {found[k] for k in range(51)} == {0} and {found[100 + k] for k in range(60)} == {100} and found[301] == 300


def test_large_groups_of_copies(spark):
    base = " ".join(f"term{k}" for k in range(400))
    rows = [(k, base) for k in range(200)] + [(200 + k, base + f" tail{k}") for k in range(200)] + [(500 + k, f"other text {k} entirely") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, simhash.near_duplicates(docs, hot=8))


def test_empty_table_and_representatives(nothing, messy):
    assert simhash.near_duplicates(nothing).collect() == []
    kept = simhash.keep_representatives(messy)
    assert kept.columns == messy.columns
    assert 1 in (ids := [r["doc_id"] for r in kept.collect()]) and 2 not in ids
