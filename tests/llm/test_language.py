from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from catalogmart.llm import language, queries
from catalogmart.llm.grams import gram_keys
from tests.llm.conftest import by_id


def plain_ppm(texts):
    """Order-four PPM with escape method C and exclusion, written with dictionaries."""
    seen = defaultdict(Counter)
    for text in texts:
        data = bytes(4) + text.encode().lower()
        for k in range(4, len(data)):
            for n in range(5):
                seen[data[k - n : k]][data[k]] += 1

    def bits(context, byte):
        out, excluded = 0.0, set()
        for n in range(len(context), -1, -1):
            own = {b: c for b, c in seen.get(context[len(context) - n :], {}).items() if b not in excluded}
            total = sum(own.values()) + len(own)
            if byte in own:
                return out + math.log2(total / own[byte])
            if own:
                out += math.log2(total / len(own))
            excluded |= set(own)
        return out + math.log2(256 - len(excluded))

    return bits


def test_code_lengths_are_exact(spark):
    texts = {"en": ["the cat sat on the mat", "the dog ran to the log"], "de": ["der hund lief zum haus", "die katze sass auf der matte"]}
    rows, k = [], 0
    for lang, some in texts.items():
        for text in some:
            k += 1
            while not _learned(spark, k):
                k += 1
            rows.append((k, text, lang))
    trees = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert trees.languages == ["de", "en"]
    coder = language.Coder(trees)
    for text in ["the cat ran", "der hund sass", "zz 99 äö", "", "x"]:
        data = bytes(4) + text.encode().lower()
        want = [sum(plain_ppm(texts[g])(data[k - 4 : k], data[k]) for k in range(4, len(data))) for g in trees.languages]
        assert np.allclose(language.code_lengths(coder, [text.encode()])[0], want, atol=1e-3)


def _learned(spark, k):
    import zlib

    return zlib.crc32(str(k).encode()) % 5 != 0


def test_held_out_accuracy(spark, given):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.op6_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_held_out_languages_do_not_matter(spark, given):
    from pyspark.sql import functions as F

    docs = given("documents")
    changed = docs.withColumn("lang", F.when(language.held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang")))
    pick = lambda df: sorted(map(tuple, language.identify_languages(docs, language.train(df)).collect()))
    assert pick(docs) == pick(changed)


def test_messy_rows(messy):
    rows = by_id(language.identify_languages(messy, language.train(messy)))
    assert len(rows) == len({r["doc_id"] for r in messy.collect()})
    for i in (3, 4, 5, 11):
        assert (rows[i]["lang_pred"], rows[i]["score"]) == ("und", 0.0)
    assert rows[9]["lang_pred"] != "und"


def test_empty_tables(messy, nothing):
    trees = language.train(nothing)
    assert language.identify_languages(nothing, trees).collect() == []
    assert {r["lang_pred"] for r in language.identify_languages(messy, trees).collect()} == {"und"}


def test_memory_of_grams_is_bounded(monkeypatch):
    monkeypatch.setattr(language, "REMEMBERED", 50)
    keys, _, _ = gram_keys([b"some training text with a number of different grams in it"])
    values, counts = np.unique(keys, return_counts=True)
    gram, context = language.grow(values, counts.astype(np.int64))
    coder = language.Coder(language.Trees(["x"], [gram], [context]))
    one = coder.rows(keys)
    assert len(coder.known) <= 60 and np.allclose(one, coder.rows(keys))


@pytest.mark.parametrize("text,want", [(b"", False), (b"12 ,.", False), ("é".encode(), True), (b"1a", True), ("日".encode(), True)])
def test_letters(text, want):
    assert language.has_letter(text) == want
