"""The whole catalogue on random dirty raw relations, against the check SQL over the same rows.

Unlike the given tables these repeat ids, link several details to one title,
repeat credits, and miss keys, names, ratings and votes.
"""

from __future__ import annotations

import datetime
import random

import duckdb
import pytest

from catalogmart.plans import layers
from catalogmart.plans.build import Catalogue
from catalogmart.sources.schemas import RAW_SCHEMAS
from check import canonical
from workload.relations_sql import RAW, RELATIONS, with_query

VOTES = [None, 0, 20, 499, 500, 999, 1000, 10_000, 99_999, 100_000, 100_000, 150_000, 150_000]
GENRES = ["Drama", " comedy", "news", "News ", "Newsreel", "War"]
ROLES = ["actor", "director", "director", "writer", "self", None]
NAMED = ['{"id": 1, "name": "Drama"}', '{"id": 9, "name": " NEWS"}', '{"id": 2, "name": null}', '{"name": " War"}']


def random_raw(pick: random.Random):
    def maybe(value, chance=0.2):
        return None if pick.random() < chance else value

    def rating():
        return maybe(pick.randrange(101) / 10)

    def title():
        return f"tt{pick.choice([*range(60), 1, 1, 1])}"

    def day():
        return datetime.date(2026, 1, pick.randrange(1, 4))

    def named():
        picked = pick.choices(NAMED, weights=[20, 1, 2, 5], k=pick.randrange(3))
        return maybe("[" + ", ".join(picked) + "]")

    def genres():
        return maybe(",".join(pick.choices(GENRES, weights=[20, 10, 1, 1, 5, 5], k=pick.randrange(1, 4))))

    return {
        "name_basics": [
            (f"nm{i}", pick.choice([None, "", "  ", f" N{i} "]), maybe(1950), maybe(2000), "p", "k") for i in range(25)
        ],
        "title_akas": [(title(), i % 4, f"a{i}", maybe("US"), None, "t", None, i % 2) for i in range(50)],
        "title_basics": [
            (f"tt{i}", pick.choice(["movie", "movie", "tvMovie", "tvSeries"]), f"T{i}", f"O{i}", i % 2,
             maybe(pick.randrange(1885, 2035)), pick.choice([None] * 5 + [2000]), maybe(pick.randrange(30, 320)), genres())
            for i in [*range(50), 3, 7]
        ],
        "title_crew": [(title(), "nm1", "nm2") for _ in range(20)],
        "title_principals": [
            (title(), i % 10, maybe(f"nm{pick.choice([*range(30), 1, 1, 1])}", 0.05), pick.choice(ROLES), "j", "c")
            for i in range(4000)
        ],
        "title_ratings": [(f"tt{i}", rating(), pick.choice(VOTES)) for i in [*range(0, 60, 2), 2, 5, 7, 9, 11]],
        "details": [
            (i, maybe(title(), 0.4), f"D{i}", 1, 2, maybe(datetime.date(1900 + i, 1, 1)), maybe(90 + i), "s", "en",
             "[]", "[]", "[]", named(), rating(), pick.choice(VOTES), None)
            for i in [*range(80), 4, 9]
        ],
        "genres": [(1, "Drama"), (9, " News"), (77, "news "), (5, None)],
        "now_playing": [
            (pick.randrange(100), f"L{pick.randrange(3)}", maybe(day()), rating(), pick.choice(VOTES),
             pick.choice(["[28]", "[28, 12]", "[]", "[28]", "[28]", "[77, 28]"]), maybe("o"), None,
             maybe(pick.randrange(50) / 2), pick.choice(["US", "IN"]), maybe(day(), 0.05))
            for _ in range(300)
        ],
    }


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_every_relation_on_random_rows(spark, rows, seed):
    raw = {name: rows(data, RAW_SCHEMAS[name]).cache() for name, data in random_raw(random.Random(seed)).items()}
    oracle = duckdb.connect()
    for name, df in raw.items():
        oracle.register("arrow_rows", df.toArrow())
        oracle.execute(f"CREATE TABLE raw_{name} AS SELECT * FROM arrow_rows")
        oracle.unregister("arrow_rows")
    catalogue = Catalogue(spark, raw)
    wrong = []
    for name in (*layers.STAGING, *layers.CURATED, *layers.ANALYTICS):
        df = getattr(catalogue, name)
        got = canonical(df.columns, [tuple(row) for row in df.collect()])
        result = oracle.execute(with_query(f"SELECT * FROM {name}", given=RAW))
        want = canonical([column[0] for column in result.description], result.fetchall())
        if got != want:
            odd = [pair for pair in zip(got[1], want[1]) if pair[0] != pair[1]][:1]
            wrong.append((name, len(got[1]), len(want[1]), odd))
    assert not wrong
    assert catalogue.excluded.imdb.count() > 1 and catalogue.mart_top_people.count() > 3
    assert set(RAW) < set(RELATIONS)
