from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalogmart.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NARROW = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [*(row[c] for c in FIELDS[:-1]), text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """The root, and for every node (place in its run, the run's others) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            first = at[k] // 3 * 3
            path.append((at[k] - first, nodes[first : at[k]] + nodes[at[k] + 1 : first + 3]))
            at[k] //= 3
        nodes = [digest(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain_manifest(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names]
    root, tops = plain_tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for name, (subroot, paths), top in zip(names, trees, tops):
        for (_, doc_id, own, row), path in zip(sorted(by_source[name], key=lambda x: x[:3]), paths):
            text, name_of_id = row["text"], "" if row["doc_id"] is None else str(doc_id)
            if text is not None and zlib.crc32(name_of_id.encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(row, text)
            for at, others in path + top:
                folded = digest(*others[:at], folded, *others[at:])
            proof = digest(*(x for _, others in path + top for x in others))
            out.append((row["doc_id"], own, subroot, root, proof, folded, folded == root))
    return Counter(out)


def check(df):
    got = merkle.manifest(df, merkle.stripped_text(F.col("doc_id"), F.col("text")))
    assert Counter(tuple(r) for r in got.collect()) == plain_manifest(df.collect())


@pytest.mark.parametrize("source", ["given", "messy", "nothing"])
def test_against_the_plain_version(given, messy, nothing, source):
    check({"given": lambda: given("documents"), "messy": lambda: messy, "nothing": lambda: nothing}[source]())


def test_any_ids(spark):
    """Ids of the whole range, negative, null and repeated, in sources of every size; equal rows and null sources."""
    draw = random.Random(5)
    odd = [None, 0, 1, -1, -7, 2**62, -(2**63), 2**63 - 1, 4_095, 4_096]
    rows = []
    for _ in range(3_000):
        far, near = draw.randrange(-(2**63), 2**63), draw.randrange(-9_000, 9_000)
        doc_id = draw.choice([draw.choice(odd), far, near, near])
        source = draw.choice(["hot", "hot", draw.choice([None, "", "a", "z", "é", "lone"])])
        rows.append((doc_id, source, draw.choice([None, "en"]), draw.choice([None, 1]), draw.choice([None, "", "x\ny", "q", "\n"])))
    check(spark.createDataFrame(rows + [(4, "one of its own", "en", 1, "t")], NARROW))


def test_hot_ids_and_hot_rows(spark):
    """A third of the rows is one row, a third has no id."""
    rows = [(7, "a", "x", 1, "t\n")] * 1_200 + [(None, "a", "x", k, "t") for k in range(1_200)] + [(k, "b", "x", 1, "t") for k in range(1_200)]
    check(spark.createDataFrame(rows, NARROW).repartition(5))


def test_one_source_and_many_sources(spark):
    check(spark.createDataFrame([(k * 3, "s", None, k, "a\nb") for k in range(731)], NARROW))
    check(spark.createDataFrame([(k, f"s{k % 800}", None, k, "a\nb") for k in range(1_000)], NARROW))
    check(spark.createDataFrame([(5, None, None, None, None)], NARROW))


def test_in_any_partitioning(given):
    docs = given("documents")
    rows = lambda df: Counter(tuple(r) for r in merkle.manifest(df).collect())
    assert rows(docs) == rows(docs.repartition(7))


def test_untampered_rows_are_verified(given):
    rows = merkle.manifest(given("documents")).collect()
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in rows) and len({r["root"] for r in rows}) == 1


def test_other_ids_are_refused(messy):
    with pytest.raises(TypeError, match="whole number"):
        merkle.manifest(messy.withColumn("doc_id", F.col("text")))
    kinds = dict(merkle.manifest(messy.limit(3).withColumn("doc_id", F.col("doc_id").cast("int"))).dtypes)
    assert kinds["doc_id"] == "int"


places = st.sets(st.integers(0, (1 << merkle.STRETCH_BITS) - 1))


@cases(places)
def test_bitmaps(held):
    bits = merkle.unpack(merkle.pack(np.array(sorted(held), np.int64)))
    assert set(np.flatnonzero(bits)) == held
    rank = merkle.ranks(bits)
    assert [int(rank[p]) for p in sorted(held)] == list(range(len(held)))


@cases(st.integers(1, 3_000))
def test_arrays_reduce_to_the_plain_root(n):
    nodes = [digest(str(k)) for k in range(n)]
    root, paths = plain_tree(nodes)
    row, total = [x.encode() for x in nodes], n
    while len(row) > 1 or total > 1:
        row = [merkle.climb(row[k : k + merkle.ARRAY], total)[-1][0] for k in range(0, len(row), merkle.ARRAY)]
        total = -(-total // merkle.ARRAY)
    assert row[0].decode() == root
    if n <= merkle.ARRAY:
        levels = merkle.climb([x.encode() for x in nodes], n)
        for k in (0, n // 2, n - 1):
            path = merkle.read_path(merkle.path_bytes(merkle.steps(levels, k)))
            assert [(at, [x.decode() for x in others]) for at, others in path] == paths[k]
            assert merkle.fold(nodes[k].encode(), path).decode() == root


def test_directory_of_stretches(spark):
    draw = random.Random(1)
    keys = {(s, draw.choice([draw.randrange(-(2**51), 2**51), draw.randrange(-70_000, 70_000)])) for s in (0, 1) for _ in range(1_500)}
    rows = [(s, k, draw.randrange(1, 9)) for s, k in sorted(keys)]
    want, upto = set(), Counter()
    for s, k, n in rows:
        want.add((s, k, upto[s]))
        upto[s] += n
    got = merkle.stretch_offsets(spark.createDataFrame(rows, "source_no int, stretch long, n long"))
    assert {(r["source_no"], r["stretch"], r["before"]) for r in got.collect()} == want
