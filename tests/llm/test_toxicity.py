from __future__ import annotations

import zlib

import pytest

from catalogmart.llm import toxicity as t
from tests.llm.conftest import by_id


def test_folding():
    assert t.fold("ІDІОТ") == t.fold("idiot") == t.fold("1d10t") == t.fold("ｉｄｉｏｔ") == t.fold("i​diot")
    assert t.fold("L0SER") == t.fold("loser") and t.fold("cl0wn") == t.fold("clown")


def test_matching_respects_words_and_exceptions():
    lexicon = t.Lexicon({t.fold("trash"): 2.0, t.fold("scum") + " ": 3.0}, ("trash can",), ())
    machine = t.automaton(lexicon)
    weights = lambda text: [w for _, w in t.matches(machine, t.fold(text))]
    assert weights("Trash, TRASHY 5cum") == [2.0, 2.0, 3.0]
    assert weights("scummy atrash a trash can") == []
    assert weights("") == []


@pytest.fixture(scope="module")
def corpus(spark):
    bad, good = ["you utter moron and idiot", "such scum , an idiot of a moron"], ["a fine day in the park", "the weather is mild and fine"]
    rows, labels = [], []
    for k in range(600):
        toxic = k % 3 == 0
        rows.append((k, f"{(bad if toxic else good)[k % 2]} number {k}", "x"))
        labels.append((k, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    return docs, spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


def test_learned_score_on_held_out_rows(spark, corpus):
    docs, labels = corpus
    rows = by_id(t.score_toxicity(docs, t.learn(docs, labels)))
    for k, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) == (k % 3 == 0)


def test_held_out_labels_do_not_matter(spark, corpus):
    from pyspark.sql import functions as F

    docs, labels = corpus
    flipped = labels.withColumn("toxic", F.when(t.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert t.learn(docs, labels) == t.learn(docs, flipped)


def test_disguised_words_are_found(spark, corpus):
    docs, labels = corpus
    lexicon = t.learn(docs, labels)
    odd = spark.createDataFrame([(1, "you utter m0r0n and 1d1ot"), (2, "уоu uttеr mоrоn аnd іdіоt"), (3, "fine weather")], "doc_id long, text string")
    assert [r["predicted"] for _, r in sorted(by_id(t.score_toxicity(odd, lexicon)).items())] == [1, 1, 0]
    assert [r["doc_id"] for r in t.drop_toxic(odd, lexicon).collect()] == [3]


def test_messy_rows_and_empty_tables(messy, nothing, spark, given):
    lexicon = t.learn(messy, given("labels"))
    assert t.score_toxicity(messy, lexicon).count() == messy.count()
    none = t.learn(nothing, given("labels").limit(0))
    assert none.entries == {} and t.score_toxicity(nothing, none).collect() == []
    assert all(r["predicted"] == 0 for r in t.score_toxicity(messy, none).collect())
    assert t.drop_toxic(messy, none).columns == messy.columns
