from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from catalogmart.llm import line_dedup
from catalogmart.llm.common import Scratch
from tests.llm.conftest import SCHEMA

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(rows, length=40, documents=5):
    """(doc_id, lines, dropped lines, text) of every row."""
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= length:
                held[key(line)].add(i)
    keeper = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= documents}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return Counter(out)


def found(df, **options):
    return Counter(tuple(r) for r in line_dedup.dedup_lines(df, **options).collect())


@pytest.mark.parametrize("source", ["given", "messy"])
def test_against_the_plain_version(given, messy, source):
    docs = given("documents") if source == "given" else messy
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs) == plain(rows)
    assert found(docs, min_length=3, min_documents=2) == plain(rows, 3, 2)


def test_empty_table(nothing):
    assert line_dedup.dedup_lines(nothing).collect() == []


LINE = "This Line stands in MANY documents, ÄÖ and it is long"


def test_edges(spark):
    """Blanks and case of A to Z do not count, other letters do; exactly 40 code points and 5 documents suffice."""
    rows = [(k, f"first {k}\n \t{LINE.upper() if k % 2 else LINE.replace('L', 'l')}\r\nlast\n{LINE}") for k in range(6)]
    rows += [(k, LINE.replace("Ä", "ä")) for k in range(10, 14)]
    rows += [(k, "é" * 40 + "\n" + "é" * 39) for k in range(20, 25)]
    rows += [(30 + k // 2, "z" * 50) for k in range(8)] + [(None, "n" * 60), (None, "n" * 60)]
    rows += [(None if k == 40 else k, "w" * 45 + "\n\n" + "w" * 45) for k in range(40, 45)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == plain(rows)
    text = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df.where("doc_id < 6")).collect()}
    assert text[0] == "first 0\nlast" and text[5].count("\n") == 3


def test_repeated_rows_count_once(spark):
    rows = [(1, "r" * 50)] * 9 + [(2, "r" * 50)] * 3
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_hot_keys_stay_out_of_the_shuffle(spark, monkeypatch):
    """A third of all lines is one key: its lines meet its keeper without an exchange, with the same result."""
    rows = [(k, "hot " * 12 + f"\nline {k % 40} that some documents share with each other, {k % 40}\nown {k} " + "x" * 40) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for share in (0.1, 1e-9, 1.0):
        monkeypatch.setattr(line_dedup.dropped_lines, "__defaults__", (share,))
        assert found(df) == plain(rows)


def test_hot_keys_are_bounded(spark):
    scratch = Scratch(spark, "test")
    rows = [(k, f"{'abcdefgh'[k % 8]}" * 45) for k in range(80)]
    lines = scratch.keep(line_dedup.occurrences(spark.createDataFrame(rows, "doc_id long, text string")))
    shared = scratch.keep(line_dedup.shared_lines(lines))
    assert sorted(r["documents"] for r in shared.collect()) == [10] * 8
    assert line_dedup.dropped_lines(lines, shared, 0.5).count() == line_dedup.dropped_lines(lines, shared, 0.01).count() == 72


def test_clashing_columns(spark):
    schema = SCHEMA.replace("size long", "line string, key string, hash string, position long, going long, lines long, body string, row string, h string")
    rows = [(k, LINE, "en", "a", None, *["q"] * 3, 1, 1, 1, *["q"] * 3, 3, 1, None, 0.5, True, "o", "l") for k in range(6)]
    assert sorted(r["n_dropped"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, schema)).collect()) == [0, 1, 1, 1, 1, 1]


def test_no_python_in_the_plan(given):
    docs = given("documents")
    parts = [line_dedup.digest_lines(line_dedup.dedup_lines(docs)), line_dedup.shared_lines(line_dedup.occurrences(docs))]
    for df in parts:
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
