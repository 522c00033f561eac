from __future__ import annotations

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from catalogmart.functions import rules, text
from catalogmart.functions.means import exact_mean
from catalogmart.functions.text import id_tags, tag_names

# The token truth table.
TOKEN_CASES = [
    ("News", True),
    ("Documentary,News", True),
    ("News,Drama", True),
    ("Drama,News,History", True),
    ("Drama, news ,History", True),
    ("Drama,Documentary", False),
    ("Newsreel", False),
    ("NotNews", False),
    ("", False),
    (None, False),
]


def values(rows, expression, data, schema):
    return [row[0] for row in rows(data, schema).select(expression).collect()]


def test_token_truth_table(rows):
    got = values(rows, text.has_token(F.col("genres"), "news"), [(g,) for g, _ in TOKEN_CASES], "genres string")
    assert got == [expected for _, expected in TOKEN_CASES]


def test_token_is_literal_not_a_pattern(rows):
    got = values(rows, text.has_token(F.col("g"), "a.c"), [("a.c",), ("abc",), ("x,A.C\t",)], "g string")
    assert got == [True, False, True]


def test_brackets_close_only_at_the_top(rows):
    data = [(0.0,), (0.99,), (1.0,), (8.999,), (9.0,), (9.9,), (10.0,), (10.1,), (-0.5,), (None,)]
    df = rows(data, "r double").select(rules.bracket_label(F.col("r")), rules.bracket_order(F.col("r")))
    got = [tuple(row) for row in df.collect()]
    assert got[:7] == [("0-1", 0), ("0-1", 0), ("1-2", 1), ("8-9", 8), ("9-10", 9), ("9-10", 9), ("9-10", 9)]
    assert got[7] == (None, 9)
    assert got[8] == (None, -1)
    assert got[9][0] is None


def test_decades_cover_the_displayed_range(rows):
    data = [(y,) for y in (1889, 1890, 1899, 1900, 1999, 2000, 2029, 2030, None)]
    got = values(rows, rules.decade_label(F.col("y")), data, "y int")
    assert got == [None, "1890s", "1890s", "1900s", "1990s", "2000s", "2020s", None, None]


def test_era_floor_steps(rows):
    data = [(y,) for y in (1850, 1899, 1900, 1929, 1930, 1949, 1950, 1969, 1970, 1989, 1990, 2024)]
    got = values(rows, rules.era_vote_floor(F.col("y")), data, "y int")
    assert got == [20, 20, 50, 50, 100, 100, 500, 500, 1000, 1000, 10000, 10000]


def test_role_minimums_and_unranked_roles(rows):
    got = values(rows, rules.role_minimum(F.col("r")), [(r,) for r in [*rules.ROLE_MINIMUMS, "self", None]], "r string")
    assert got == [*rules.ROLE_MINIMUMS.values(), None, None]


def test_either_source_floor_ignores_an_unknown_side(rows):
    data = [(1000, None), (None, 500), (999, 500), (999, 499), (None, None)]
    schema = "imdb_num_of_votes bigint, tmdb_num_of_votes bigint"
    df = rows(data, schema).filter(rules.either_votes_reach((1000, 500)))
    assert [tuple(r) for r in df.collect()] == [(1000, None), (None, 500), (999, 500)]


def test_rating_and_votes_are_preferred_independently(rows):
    schema = "imdb_avg_rating double, tmdb_avg_rating double, imdb_num_of_votes bigint, tmdb_num_of_votes bigint"
    df = rows([(None, 7.0, 5, 900)], schema).select(rules.preferred_rating(), rules.preferred_votes())
    assert tuple(df.first()) == (7.0, 5)


def test_json_cells_are_lenient_or_strict(rows):
    data = [('[{"id": 1, "name": " News "}]',), ("not json",), ("[{'id': 1, 'name': 'x'}]",), ("[]",), (None,)]
    got = values(rows, text.named_tags(F.col("c")), data, "c string")
    assert got[0][0].name == " News " and got[1] is None and got[3] == [] and got[4] is None
    assert got[2] is None
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD_IN_PARSING|FAILFAST"):
        values(rows, text.named_tags(F.col("c"), strict=True), data, "c string")


def test_id_lists_skip_what_is_no_number(rows):
    got = values(rows, text.id_tags(F.col("c")), [("[7, 12]",), ('["7", "x"]',), ("oops",)], "c string")
    assert got == [[7, 12], [7, None], None]


def test_blank_names_become_the_default(rows):
    got = values(rows, text.clean_name(F.col("n"), "Unknown"), [("  ",), ("",), (None,), (" A B ",)], "n string")
    assert got == ["Unknown", "Unknown", "Unknown", "A B"]


def test_elements_are_trimmed(rows):
    got = values(rows, text.comma_elements(F.col("g")), [("a, b ,c",), ("10, 1",)], "g string")
    assert got == [["a", "b", "c"], ["10", "1"]]


def test_mean_does_not_depend_on_order(spark, rows):
    data = [(i / 10,) for i in range(101)] * 7
    up = rows(data, "r double").agg(exact_mean(F.col("r"))).first()[0]
    down = rows(data[::-1], "r double").repartition(7).agg(exact_mean(F.col("r"))).first()[0]
    assert up == down == 5.0
    assert rows([(None,)], "r double").agg(exact_mean(F.col("r"))).first()[0] is None


def test_means_keep_every_decimal(rows):
    data = [(7.1234567,), (7.1234561,), (None,)]
    assert rows(data, "r double").agg(exact_mean(F.col("r"))).first()[0] == 7.1234564
    assert rows([(0.1,), (0.2,), (0.3,)], "r double").agg(exact_mean(F.col("r"))).first()[0] == 0.6 / 3


def test_tags_are_read_from_lists_of_mixed_elements(rows):
    cells = rows([('[{"id":1,"name":"News"},5]',), ("[7.0, 12, \"x\", null, \"9\", {}]",), ("{}",), ("[",), (None,)], "c string")
    got = [tuple(r) for r in cells.select(tag_names(F.col("c")), id_tags(F.col("c"))).collect()]
    assert got == [(["News", None], [None, 5]), ([None] * 6, [7, 12, None, None, 9, None]), (None, None), (None, None), (None, None)]
