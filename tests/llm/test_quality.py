from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from catalogmart.llm import grams, quality
from catalogmart.llm.common import Scratch, SortedHashes
from tests.llm.conftest import by_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words, seen, repeated = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    inside = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside)


@pytest.mark.parametrize("source", ["given", "messy"])
def test_base_counts_match_a_plain_count(spark, given, messy, source):
    docs = given("documents") if source == "given" else messy
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = defaultdict(list)
    for r in quality.quality_rules(docs).collect():
        counts = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        found[r["doc_id"]].append(counts)
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    for i, text in texts:
        assert plain_counts(text) in found[i]
    assert sum(map(len, found.values())) == len(texts)


def plain_model(texts):
    """Modified Kneser-Ney over bytes, written with dictionaries."""
    counts = {5: Counter()}
    for text in texts:
        data = bytes(4) + text.encode().lower()
        for k in range(4, len(data)):
            counts[5][data[k - 4 : k + 1]] += 1
    for n in (4, 3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discount, total, back = {}, {}, {}
    for n, c in counts.items():
        m = Counter(c.values())
        y = m[1] / (m[1] + 2 * m[2]) if m[1] + 2 * m[2] else None
        for k in (1, 2, 3):
            d = k - (k + 1) * y * m[k + 1] / m[k] if y is not None and m[k] else None
            discount[n, k] = d if d is not None and 0.01 <= d <= k - 0.01 else k / 2
        total[n], back[n] = Counter(), Counter()
        for g, v in c.items():
            total[n][g[:-1]] += v
            back[n][g[:-1]] += discount[n, min(v, 3)]

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / 256
        if not total[n][g[:-1]]:
            return p(g[1:])
        v = counts[n][g]
        own = max(v - discount[n, min(v, 3)], 0) / total[n][g[:-1]] if v else 0
        return own + back[n][g[:-1]] / total[n][g[:-1]] * p(g[1:])

    return p


def test_model_is_kneser_ney_and_backs_off(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog and a hat", "the the the the"]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    entries = quality.kneser_ney(grams.count_grams(df), Scratch(spark, "test"))
    model = quality.collect_model(entries)
    table, p = SortedHashes(model.hashes), plain_model(texts)
    for text in [*texts, "the cow sat zz on", "quite other words"]:
        raw = text.encode()
        keys, _, _ = grams.gram_keys([raw])
        codes = np.repeat(grams.label_codes(["en"]), len(keys))
        data = bytes(4) + raw
        want = [math.log2(p(data[k : k + 5])) for k in range(len(raw))]
        assert np.allclose(quality.log2_probabilities(model, table, codes, keys), want, atol=1e-4)


def test_bands_reject_the_odd_ones(spark):
    plain = [f"a plain text about day {k} and the weather of the {k % 9}th week which was fine and mild and dry as ever before or after" for k in range(300)]
    odd = [" ".join("qzx%#@!"[k % 7 :: 2] * 2 + str(k * j) for j in range(25)) for k in range(3)]
    df = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(plain + odd)], "doc_id long, text string, lang string, source string")
    rows = by_id(quality.quality_rules(df))
    assert all(rows[k]["kept"] for k in range(300)) and not any(rows[k]["kept"] for k in range(300, 303))


def test_empty_table(nothing):
    assert quality.quality_rules(nothing).collect() == []


def test_null_language_has_a_band_of_its_own(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = quality.quality_rules(spark.createDataFrame([(1, text, None), (2, text, None)], "doc_id long, text string, lang string")).collect()
    assert [r["kept"] for r in rows] == [True, True]


def test_bands_reject_junk_and_keep_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    english = docs.where("lang = 'en' AND NOT text RLIKE '[#*$%&|<>]' AND length(text) > 600").orderBy("doc_id").limit(60).collect()
    prose = [r["text"] for r in english[::12]]
    digits = [" ".join(f"{(k + 7) * j * 7919 % 100003:x}q{j * j % 89}" for j in range(120)) for k in range(5)]
    junk = [(-1 - k, t, "en") for k, t in enumerate(digits)] + [(-101 - k, t + " and", "de") for k, t in enumerate(prose)]
    rows = quality.quality_rules(docs.union(spark.createDataFrame(junk, docs.schema))).collect()
    odd = [r for r in rows if r["doc_id"] < 0 and not r["base_failed"]]
    clean = [r for r in rows if r["doc_id"] >= 0 and not r["base_failed"] and 100 * r["n_symbols"] < r["word_chars"]]
    assert len(odd) >= 8 and not any(r["kept"] for r in odd)
    assert sum(r["kept"] for r in clean) > 0.9 * len(clean)


def test_every_entry_is_found_as_itself(spark):
    texts = [" ".join(f"{k * j * 7919 % 1000003:x}" for j in range(1, 900)) for k in range(1, 30)]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    entries = quality.kneser_ney(grams.count_grams(df), Scratch(spark, "test"))
    model = quality.collect_model(entries)
    assert len(model.hashes) == entries.count() > 100_000 and (np.diff(model.hashes) > 0).all()
    table, keys = SortedHashes(model.hashes), grams.gram_keys([t.encode() for t in texts])[0]
    top = grams.label_codes(["en"])[0] << np.uint64(grams.GRAM_BITS)
    assert (model.kind[quality._find(model, table, 2 * grams.ORDER, np.unique(keys) | top)] == 2 * grams.ORDER).all()
    unseen = np.setdiff1d(np.arange(2_000_000, dtype=np.uint64) * np.uint64(524287) % np.uint64(1 << 40), keys)
    assert (quality._find(model, table, 2 * grams.ORDER, unseen | top) < 0).all()


def test_slices_share_out_the_model_and_the_bytes(spark, given):
    docs = given("documents")
    entries = quality.kneser_ney(grams.count_grams(docs), Scratch(spark, "test"))
    rows = [tuple(r) for r in entries.where("home IS NOT NULL").select("kind", "slot", "home").collect()]
    of, met = 7, Counter()
    for k in range(of):
        held = {tuple(r) for r in quality.slice_entries(entries, k, of).select("kind", "slot", "home").collect()}
        own = {r for r in held if r[2] is not None}
        met.update(own)
        homes = np.array([r[2] for r in rows], np.uint64)
        assert {rows[j] for j in np.flatnonzero(quality.in_slice(homes, k, of))} == own
        assert 0.5 < len(own) / (len(rows) / of) < 2
    assert set(met) == set(rows) and set(met.values()) == {1}


@pytest.mark.parametrize("source", ["given", "messy"])
def test_the_result_does_not_depend_on_the_slices(spark, given, messy, source):
    docs = given("documents") if source == "given" else messy
    docs = docs.union(docs.limit(5))
    whole, sliced = [
        sorted(map(tuple, quality.quality_rules(docs, slice_grams=size).collect()), key=lambda r: (repr(r[0]), r[1:6]))
        for size in (10**9, 40_000 if source == "given" else 9_000)
    ]
    assert len(whole) == len(sliced) == docs.count()
    for one, other in zip(whole, sliced):
        assert one[:7] == other[:7] and one[-1] == other[-1]
        for a, b in zip(one[7:-1], other[7:-1]):
            assert a == b or math.isclose(a, b, rel_tol=1e-6)
