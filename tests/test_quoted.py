"""Quoted CSV in byte ranges gives what the plain reader gives, from many tasks."""

from __future__ import annotations

import csv
import random

import pytest

from catalogmart.sources.quoted import quoted_records
from catalogmart.sources.readers import scan_csv
from tests.conftest import tuples

SCHEMA = "id bigint, name string, note string, score double"


@pytest.fixture
def small_ranges(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "700")
    spark.conf.set(names[1], "0")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def write(path, rows, header=("id", "name", "note", "score"), end="\n", **how):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end, **how)
        writer.writerows([header, *rows])
    return str(path)


def random_rows(seed: int, n: int):
    pick = random.Random(seed)
    bits = ["a", "é", "日本", '"', '""', ",", "\n", "\n\n", " ", "'", "\\", '",\n"', "x" * 40, "\t"]
    text = lambda: "".join(pick.choice(bits) for _ in range(pick.randrange(9)))
    return [(k, text() or "-", text(), pick.choice(["", "1.5", "-2"])) for k in range(n)]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_quotes_and_breaks(spark, tmp_path, small_ranges, seed, end):
    rows = random_rows(seed, 300)
    quoting = csv.QUOTE_ALL if seed % 2 else csv.QUOTE_MINIMAL
    path = write(tmp_path / "a.csv", rows, end=end, quoting=quoting)
    got = scan_csv(spark, path, SCHEMA, in_ranges=True)
    assert tuples(got) == tuples(scan_csv(spark, path, SCHEMA))
    assert spark.read.text(path).rdd.getNumPartitions() > 8


def test_a_record_over_many_ranges_and_several_files(spark, tmp_path, small_ranges):
    folder = tmp_path / "many"
    folder.mkdir()
    long = 'so "long",\n' * 1_000
    for k in range(3):
        write(folder / f"{k}.csv", [(10 * k, "a", long, 1), (10 * k + 1, "b", "one line", 2), (10 * k + 2, "c", long[:-1], "")])
    got = scan_csv(spark, str(folder), SCHEMA, in_ranges=True)
    assert tuples(got) == tuples(scan_csv(spark, str(folder), SCHEMA))
    assert {r["id"]: len(r["note"]) for r in got.collect()}[20] == len(long)


def test_records_are_numbered_and_blank_lines_are_none(spark, tmp_path):
    path = tmp_path / "blank.csv"
    path.write_bytes(b'id,name\n\n1,"a\n\nb"\n\n\n2,c')
    found = sorted((r["number"], r["record"]) for r in quoted_records(spark, str(path)).collect())
    assert found == [(1, "id,name"), (2, '1,"a\n\nb"'), (3, "2,c")]
    got = scan_csv(spark, str(path), "id bigint, name string", in_ranges=True)
    assert tuples(got) == tuples(scan_csv(spark, str(path), "id bigint, name string")) == [(1, "a\n\nb"), (2, "c")]


@pytest.mark.parametrize("content", ["", "id,name\n", "﻿id,name\n7,x\n"])
def test_empty_header_only_and_marked_files(spark, tmp_path, content):
    path = tmp_path / "file.csv"
    path.write_text(content, encoding="utf-8")
    got = scan_csv(spark, str(path), "id bigint, name string", in_ranges=True)
    assert tuples(got) == ([(7, "x")] if "7" in content else [])


@pytest.mark.parametrize(
    "content",
    [
        'id,name\n1,5" disc\n2,b\n',  # a quote inside an unquoted cell
        'id,name\n1,"open\n2,b\n',  # a cell that is never closed
        'id,name\n1,"a"b\n',  # text after a closed cell
        "name,id\n1,a\n",  # another header
        "id,name,more\n1,a,b\n",  # more columns
        "id,name\n1.5,a\n",  # a fraction in a whole number
        "id,name\nx,a\n",  # no number
    ],
)
def test_what_is_refused(spark, tmp_path, content):
    path = tmp_path / "bad.csv"
    path.write_text(content)
    with pytest.raises(Exception):
        scan_csv(spark, str(path), "id bigint, name string", in_ranges=True).collect()


def test_only_records_of_several_lines_are_gathered(spark, tmp_path, small_ranges):
    path = write(tmp_path / "plain.csv", [(k, "a", "b" * 30, 1) for k in range(500)])
    got = scan_csv(spark, path, SCHEMA, in_ranges=True)
    assert got.count() == 500 and got.agg({"id": "sum"}).first()[0] == 499 * 250
