from __future__ import annotations

import gzip
import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalogmart.plans.layers import replace_details, replace_listing
from catalogmart.sources import payloads
from catalogmart.sources.bounded import bounded_select
from catalogmart.sources.readers import scan_raw
from catalogmart.sources.tables import EmptyLoadError, IncompleteLoadError, KeptTables, Replacement, guarded_replace, shared_folder
from catalogmart.sources.versions import ConcurrentLoadError, Versions
from tests.conftest import as_dicts, tuples


def test_tsv_keeps_quotes_and_reads_the_null_marker(spark, tmp_path):
    path = tmp_path / "title.basics.tsv.gz"
    header = "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"
    lines = [
        'tt1\tmovie\t"Unbalanced\tA "B" C\t0\t1999\t\\N\t90\tDrama,News\n',
        "tt2\tmovie\t trailing \tx\t0\t\\N\t\\N\t\\N\t\\N\n",
    ]
    with gzip.open(path, "wt") as handle:
        handle.write(header + "".join(lines))
    for partitions in (None, 3):
        got = sorted(as_dicts(scan_raw(spark, "title_basics", str(path), partitions)), key=lambda r: r["tconst"])
        assert got[0]["primarytitle"] == '"Unbalanced' and got[0]["originaltitle"] == 'A "B" C'
        assert got[0]["startyear"] == 1999 and got[0]["endyear"] is None and got[0]["genres"] == "Drama,News"
        assert got[1]["primarytitle"] == " trailing " and got[1]["genres"] is None


def test_csv_cells_may_hold_json_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "now.csv"
    path.write_text(
        "id,title,release_date,vote_average,vote_count,genre_ids,overview,poster_path,popularity,region,snapshot_date\n"
        '1,"A, ""quoted""",2026-01-02,7.5,10,"[7, 12]","two\nlines",,3.5,US,2026-02-01\n'
    )
    (row,) = as_dicts(scan_raw(spark, "now_playing", str(path)))
    assert row["title"] == 'A, "quoted"' and row["overview"] == "two\nlines"
    assert row["genre_ids"] == "[7, 12]" and row["poster_path"] is None
    assert str(row["release_date"]) == "2026-01-02"


def test_csv_whole_numbers_may_have_a_zero_fraction(spark, tmp_path):
    path = tmp_path / "genres.csv"
    path.write_text("id,name\n28.0,Action\n,Unknown\n9007199254740993,Big\n")
    df = scan_raw(spark, "genres", str(path), partitions=2)
    assert df.dtypes == [("id", "bigint"), ("name", "string")]
    assert tuples(df) == [(28, "Action"), (9007199254740993, "Big"), (None, "Unknown")]


def detail(**changes):
    base = {
        "id": 1,
        "imdb_id": "tt1",
        "title": "T",
        "budget": 0,
        "revenue": 0,
        "release_date": "2026-01-01",
        "runtime": 90,
        "status": "Released",
        "original_language": "en",
        "vote_average": 7.0,
        "vote_count": 100,
    }
    return {k: v for k, v in {**base, **changes}.items() if v != "absent"}


def test_detail_payloads(rows):
    texts = [
        detail(),
        detail(id=2, imdb_id="absent", genres=[{"id": 7, "name": "News"}], release_date=""),
        detail(id=3, title="absent"),
        detail(id=4, runtime=None),
    ]
    df = rows([(json.dumps(t),) for t in texts] + [("not json",), (None,)], "payload string")
    got = {r["id"]: r for r in as_dicts(payloads.flatten_details(df))}
    assert set(got) == {1, 2, 4}
    assert got[1]["genres"] == "[]" and got[1]["poster_path"] is None and got[1]["imdb_id"] == "tt1"
    assert json.loads(got[2]["genres"]) == [{"id": 7, "name": "News"}]
    assert got[2]["imdb_id"] is None and got[2]["release_date"] is None and got[4]["runtime"] is None
    assert payloads.rejected_details(df).count() == 3


def test_listing_pages_of_all_regions(rows):
    item = {"id": 1, "title": "A", "release_date": "2026-01-01", "genre_ids": [1, 2], "popularity": 2.5}
    pages = rows(
        [
            ("US", json.dumps({"page": 1, "results": [item, {**item, "id": 2}]})),
            ("IN", json.dumps({"page": 1, "results": [item]})),
            ("IN", json.dumps({"page": 2, "results": []})),
        ],
        "region string, payload string",
    )
    got = as_dicts(payloads.flatten_listing(pages, F.lit("2026-02-03").cast("date")))
    assert sorted((r["region"], r["id"]) for r in got) == [("IN", 1), ("US", 1), ("US", 2)]
    assert got[0]["genre_ids"] == "[1,2]" and str(got[0]["snapshot_date"]) == "2026-02-03"


def test_enrichment_is_all_or_nothing(rows):
    listing = rows([(1,), (1,), (2,)], "id bigint")
    assert tuples(payloads.enrichment_keys(listing)) == [(1,), (2,)]
    assert tuples(payloads.enrichment_gaps(listing, rows([(1,)], "id bigint"))) == [(2,)]
    assert payloads.enrichment_gaps(listing, rows([(1,), (2,)], "id bigint")).isEmpty()


def test_guarded_replace(spark, rows, tmp_path):
    folder = str(tmp_path / "ratings")
    schema = "id bigint, n int"
    assert tuples(guarded_replace(rows([(1, 1)], schema), "ratings", folder)) == [(1, 1)]
    assert tuples(guarded_replace(rows([(2, 2), (3, 3)], schema), "ratings", folder)) == [(2, 2), (3, 3)]
    with pytest.raises(EmptyLoadError):
        guarded_replace(rows([], schema), "ratings", folder)
    assert tuples(spark.table("ratings")) == [(2, 2), (3, 3)]
    with pytest.raises(PySparkException):
        failing = rows([(4, 4)], schema).withColumn("n", F.raise_error(F.lit("broken load")).cast("int"))
        guarded_replace(failing, "ratings", folder)
    assert tuples(spark.table("ratings")) == [(2, 2), (3, 3)]
    with pytest.raises(ValueError):
        guarded_replace(rows([(4,)], "id bigint"), "ratings", folder)
    # A load derived from the table itself never overwrites what it reads.
    grown = spark.table("ratings").withColumn("n", F.col("n") + 10)
    assert tuples(guarded_replace(grown, "ratings", folder)) == [(2, 12), (3, 13)]
    assert tuples(guarded_replace(rows([(9, 9)], schema), "ratings", folder)) == [(9, 9)]
    spark.sql("DROP TABLE ratings")


def test_one_of_two_loads_wins(spark, rows, tmp_path):
    """Loads that began on the same version: the first to publish wins, the other learns of it and may begin again."""
    folder, schema = str(tmp_path / "raced"), "id bigint"
    first, second = Replacement(spark, "raced", folder), Replacement(spark, "raced", folder)
    assert tuples(second.publish(rows([(2,)], schema))) == [(2,)]
    with pytest.raises(ConcurrentLoadError, match="version 1"):
        first.publish(rows([(1,)], schema))
    assert tuples(spark.table("raced")) == [(2,)]
    assert len(list((tmp_path / "raced").glob("v-*"))) == 1
    assert tuples(Replacement(spark, "raced", folder).publish(rows([(1,)], schema))) == [(1,)]
    with pytest.raises(ConcurrentLoadError):
        second.publish(rows([(5,)], schema))
    spark.sql("DROP TABLE raced")


def test_an_unchanged_load_makes_no_version(spark, rows, tmp_path):
    folder, schema, data = str(tmp_path / "same"), "id bigint, name string", [(k, f"n{k}") for k in range(50)]
    load = lambda data: Replacement(spark, "unchanged", folder).publish(rows(data, schema), skip_unchanged=True).count()
    assert load(data) == 50 and load(data[::-1]) == 50
    assert Versions(spark, folder).latest().number == 1 and len(list((tmp_path / "same").glob("v-*"))) == 1
    assert load(data[:-1]) == 49 and load([*data[:-1], data[0]]) == 50
    assert Versions(spark, folder).latest().number == 3
    spark.sql("DROP TABLE unchanged")


def test_many_loads_at_once_have_one_winner(spark, rows, tmp_path):
    folder, schema = str(tmp_path / "crowd"), "id bigint"
    guarded_replace(rows([(0,)], schema), "crowd", folder)
    loads = [(k, Replacement(spark, "crowd", folder)) for k in range(1, 6)]

    def run(load):
        k, replacement = load
        try:
            replacement.publish(rows([(k,)] * k, schema))
            return k
        except ConcurrentLoadError:
            return None

    with ThreadPoolExecutor(5) as pool:
        won = [k for k in pool.map(run, loads) if k]
    assert len(won) == 1 and tuples(spark.table("crowd")) == [(won[0],)] * won[0]
    assert Versions(spark, folder).latest().number == 2
    spark.sql("DROP TABLE crowd")


def test_commits_by_rename_refuse_a_taken_number(spark, tmp_path, monkeypatch):
    """What other file systems than a local disk use."""
    monkeypatch.setattr(Versions, "_link", Versions._rename)
    versions = Versions(spark, str(tmp_path / "renamed"))
    versions.commit(0, "one")
    with pytest.raises(ConcurrentLoadError):
        versions.commit(0, "two")
    versions.commit(1, "three")
    assert [(v.number, v.slot) for v in versions.all()] == [(1, "one"), (2, "three")]
    assert not [name for name in os.listdir(tmp_path / "renamed" / "_versions") if len(name) > 30 and not name.endswith(".crc")]


def test_a_reader_keeps_its_version(spark, rows, tmp_path):
    folder, schema = str(tmp_path / "read"), "id bigint"
    reader = guarded_replace(rows([(1,), (2,)], schema), "read_slowly", folder)
    for k in range(3, 6):
        guarded_replace(rows([(k,)], schema), "read_slowly", folder)
    assert tuples(reader) == [(1,), (2,)] and tuples(spark.table("read_slowly")) == [(5,)]
    versions = Versions(spark, folder)
    orphan = versions.new_slot()
    rows([(9,)], schema).write.parquet(orphan)
    assert versions.expire() == [] and tuples(reader) == [(1,), (2,)]  # all too young
    assert len(versions.expire(keep=2, older_than=-60)) == 3  # two versions and the load that never committed
    assert [v.number for v in versions.all()] == [3, 4] and tuples(spark.table("read_slowly")) == [(5,)]
    guarded_replace(rows([(6,)], schema), "read_slowly", folder)
    assert versions.latest().number == 5 and tuples(spark.table("read_slowly")) == [(6,)]
    spark.sql("DROP TABLE read_slowly")


def test_details_are_replaced_only_when_complete(spark, rows, tmp_path):
    folder, listing = str(tmp_path / "details"), rows([(1,), (1,), (2,)], "id bigint")
    schema = "id bigint, title string"
    replace_details(listing, rows([(1, "a"), (2, "b")], schema), "details_table", folder)
    with pytest.raises(IncompleteLoadError):
        replace_details(listing, rows([(1, "new")], schema), "details_table", folder)
    assert tuples(spark.table("details_table")) == [(1, "a"), (2, "b")]
    spark.sql("DROP TABLE details_table")


def test_bounded_select_refuses_instead_of_truncating(spark):
    df = spark.range(20).withColumn("v", F.col("id") * 2)
    exact = bounded_select(df, "list", [("public", "v")], [F.col("id").desc()], F.col("id") < 5, maximum=5)
    assert exact.columns == ["public"] and [r[0] for r in exact.collect()] == [8, 6, 4, 2, 0]
    with pytest.raises(PySparkException, match="list has more than 5 rows"):
        bounded_select(df, "list", [("public", "v")], maximum=5).collect()


def test_kept_tables_live_in_the_shared_folder(spark, rows):
    kept = KeptTables(spark)
    assert kept.folder.startswith(shared_folder(spark))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = kept.keep("x", rows([(1, "a"), (2, None)], "id int, s string"))
    assert tuples(df) == [(1, "a"), (2, None)]
    assert "kept-" in df.inputFiles()[0]
    kept.discard()
    assert not os.path.exists(kept.folder)


def test_fractions_of_whole_numbers_are_refused(spark, tmp_path):
    path = tmp_path / "genres.csv"
    path.write_text("id,name\n1.5,Action\n")
    with pytest.raises(PySparkException, match="no whole number"):
        scan_raw(spark, "genres", str(path)).collect()


@pytest.mark.parametrize(("relation", "sep"), [("title_crew", "\t"), ("genres", ",")])
def test_a_reordered_header_is_refused(spark, tmp_path, relation, sep):
    columns = ["directors", "tconst", "writers"] if relation == "title_crew" else ["name", "id"]
    path = tmp_path / "reordered"
    path.write_text(sep.join(columns) + "\n" + sep.join(["1"] * len(columns)) + "\n")
    with pytest.raises(Exception, match="header"):
        scan_raw(spark, relation, str(path)).collect()


def test_rejected_and_missing_pages(rows):
    pages = rows(
        [
            ("US", '{"page":1,"total_pages":4,"results":[{"id":1}]}'),
            ("US", '{"page":2,"total_pages":4,"results":[{"id":2},{"title":"x"}]}'),
            ("US", '{"page":3,"total_pages":4}'),
            ("US", "{"),
            ("IN", '{"page":1,"results":[]}'),
            ("IN", None),
        ],
        "region string, payload string",
    )
    assert sorted(r["issue"] for r in payloads.rejected_pages(pages).collect()) == ["bad_item"] + ["unreadable"] * 4
    assert tuples(payloads.missing_pages(pages)) == [("US", 4)]
    genres = rows([('{"genres":[]}',), ("{}",), ("[",)], "payload string")
    assert payloads.rejected_genres(genres).count() == 2


def page(region, number, total, *ids):
    text = {"page": number, "total_pages": total, "results": [{"id": i, "title": "t"} for i in ids]}
    return region, json.dumps({k: v for k, v in text.items() if v is not None})


def faults(df, **options):
    return {(r["region"], r["issue"], r["first_page"], r["last_page"], r["pages"]) for r in payloads.listing_faults(df, ("IN", "US"), **options).collect()}


def test_listing_faults_are_named(rows):
    schema = "region string, payload string"
    whole = [page("US", k, 3, k) for k in (1, 2, 3)] + [page("IN", 1, 1, 7)]
    assert faults(rows(whole, schema)) == set()
    # A region without any readable page, lost stretches, a page without a number, absurd and differing counts.
    broken = [page("US", 3, 9, 1), page("US", 4, 9, 2), page("US", None, 9, 3), page("US", 8, 10**12, 4), page("US", 12, 9, 5), page("US", 0, 8, 6)]
    broken += [("IN", "{"), ("IN", None), page("FR", 1, 1, 1), (None, "{"), page("US", 9, -1, 2)]
    assert faults(rows(broken, schema)) == {
        ("US", "missing", 1, 2, 2),
        ("US", "missing", 5, 7, 3),
        ("US", "unnumbered", None, None, 2),
        ("US", "page_count", None, None, 3),
        ("US", "beyond_count", None, None, 1),
        ("IN", "no_readable_page", None, None, 0),
        ("IN", "unreadable", None, None, 2),
        ("FR", "unwanted_region", None, None, 1),
        (None, "unreadable", None, None, 1),
    }
    absurd = [page("US", 1, 10**15, 1), page("IN", 1, 1, 2)]
    assert faults(rows(absurd, schema)) == {("US", "page_count", None, None, 1)}
    assert payloads.missing_pages(rows(absurd, schema)).isEmpty()
    assert faults(rows([], schema)) == {("US", "no_readable_page", None, None, 0), ("IN", "no_readable_page", None, None, 0)}


def test_listings_of_many_pages_are_searched_whole(rows):
    schema, block = "region string, payload string", 1 << payloads.BLOCK_BITS
    # The second half of a listing of 12,000 pages is lost, also every page but the first of one of 11,000.
    pages = rows([page("US", k, 12_000, k) for k in range(1, 6_001)] + [page("IN", 1, 11_000, 1)], schema)
    assert {tuple(r) for r in payloads.page_gaps(pages).collect()} == {("US", 6_001, 12_000), ("IN", 2, 11_000)}
    assert set(tuples(payloads.missing_pages(pages))) == {("US", k) for k in range(6_001, 12_001)} | {("IN", k) for k in range(2, 11_001)}
    assert faults(pages) == {("US", "missing", 6_001, 12_000, 6_000), ("IN", "missing", 2, 11_000, 10_999)}
    # Stretches within, between and over blocks of numbers; numbers at their ends; pages beyond the count or twice.
    landed = (2, 5, block - 1, block, block + 1, 3 * block - 1, 3 * block + 2, 3 * block + 2, 4 * block + 9, 9 * block)
    pages = rows([page("US", k, 4 * block, 1) for k in landed] + [page("IN", 2 * block - 1, 2 * block - 1, 1)], schema)
    assert sorted(tuple(r) for r in payloads.page_gaps(pages).collect()) == [
        ("IN", 1, 2 * block - 2),
        ("US", 1, 1),
        ("US", 3, 4),
        ("US", 6, block - 2),
        ("US", block + 2, 3 * block - 2),
        ("US", 3 * block, 3 * block + 1),
        ("US", 3 * block + 3, 4 * block),
    ]
    missing = [r["page"] for r in payloads.missing_pages(pages).filter("region = 'US'").collect()]
    assert sorted(missing) == sorted(set(range(1, 4 * block + 1)) - set(landed))
    # The largest page number is a count, one more is none.
    most = 2**31 - 1
    pages = rows([page("US", 1, most, 1), page("IN", 1, most + 1, 1)], schema)
    assert tuples(payloads.page_gaps(pages)) == [("US", 2, most)]
    assert payloads.missing_pages(pages).limit(3).count() == 3


def test_a_listing_is_replaced_only_when_whole(spark, rows, tmp_path):
    folder, schema, day = str(tmp_path / "listing"), "region string, payload string", F.lit("2026-02-03").cast("date")
    whole = [page("US", 1, 2, 1), page("US", 2, 2, 2), page("IN", 1, 1, 3)]
    assert replace_listing(rows(whole, schema), day, "listing_table", folder).count() == 3
    for lost, named in ((0, "US: missing 1-1"), (2, "IN: no_readable_page")):
        with pytest.raises(IncompleteLoadError, match=named):
            replace_listing(rows(whole[:lost] + whole[lost + 1 :], schema), day, "listing_table", folder)
    assert spark.table("listing_table").count() == 3
    spark.sql("DROP TABLE listing_table")
