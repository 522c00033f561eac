from __future__ import annotations

import hashlib
import zlib

import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from catalogmart.llm import periodic


def plain_runs(words, least=12):
    """(start, period, length) by trying every period at every place."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 2 * q) and not any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, q, length))
            i = max(j, i + 1)
    return sorted(out)


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {k for start, q, length in runs for k in range(start + q, start + length)}
    start, q, length = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else (None, None, None)
    listed = "".join(f"{s},{n},{p}\n" for s, p, n in runs)
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    milli = None if length is None else 1000 * length // q
    return (doc_id, len(runs), start, length, q, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), n)


small_texts = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40)
periods = st.builds(lambda p, k, cut, tail: (p * k)[cut:] + tail, st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 5), small_texts)


@settings(max_examples=300, deadline=None)
@cases(st.lists(st.one_of(small_texts, periods, st.builds(lambda x, y: x + y, periods, periods)), max_size=4), st.sampled_from([2, 3, 7, 12]))
def test_runs_against_every_period(texts, least):
    assert periodic.runs_of(texts, least) == [plain_runs(words, least) for words in texts]


@cases(st.lists(st.integers(0, 9_000), unique=True, min_size=1, max_size=400))
def test_ordered_sets(values):
    first, *rest = values
    held, known = periodic.Places(first), [first]
    for value in rest:
        before = max((v for v in known if v < value), default=None)
        after = min((v for v in known if v > value), default=None)
        assert held.around(value) == (before, after)
        held.add(value)
        known.append(value)
    assert [v for part in held.parts for v in part] == sorted(values) and held.size == len(values)


def test_ordered_sets_split_into_parts():
    held = periodic.Places(0)
    for k in range(1, 5_000):
        held.add(k * 7919 % 5_003)
    assert [v for part in held.parts for v in part] == sorted(k * 7919 % 5_003 for k in range(5_000))
    assert max(map(len, held.parts)) <= periodic.PART and held.around(2_500)[0] is not None


@pytest.mark.parametrize("source", ["given", "messy"])
def test_against_the_plain_version(given, messy, source):
    docs = given("documents") if source == "given" else messy
    docs = docs.where("text IS NULL OR length(text) < 20000")
    got = periodic.digest_runs(periodic.periodic_runs(docs, words=periodic.planted_words)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(plain_row(r["doc_id"], r["text"])) for r in docs.collect())


def test_real_outputs(spark):
    df = spark.createDataFrame([("k", "x " + "a b c " * 6 + "y"), ("l", None), ("m", " \t\r\n"), ("n", "b " * 11), (None, "b\x0b" * 12)], "doc_id string, text string")
    got = {r["doc_id"]: r for r in periodic.periodic_runs(df).collect()}
    assert [tuple(r) for r in got["k"]["runs"]] == [(1, 18, 3)] and got["k"]["collapsed"] == "x a b c y"
    assert got["l"]["runs"] == got["m"]["runs"] == got["n"]["runs"] == [] and got["l"]["collapsed"] == got["m"]["collapsed"] == ""
    assert [tuple(r) for r in got[None]["runs"]] == [(0, 12, 1)] and got[None]["collapsed"] == "b"
    assert got["n"]["collapsed"] == "b " * 10 + "b" and got["n"]["n_words"] == 11


def test_longest_run_ties(spark):
    text = "a b " * 6 + "x " + "c d " * 6 + "y " + "e f g h " * 3
    row = periodic.digest_runs(periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (3, 0, 12, 2, 6000)


def test_very_long_texts():
    """Texts of one word, of one long period, and with a repeat within a repeat: time grows little faster than length."""
    n = 60_000
    assert periodic.runs_of([[b"a"] * n]) == [[(0, 1, n)]]
    assert periodic.runs_of([[b"%d" % (k % 997) for k in range(n)]]) == [[(0, 997, n)]]
    inner = [b"a", b"b"] * 50 + [b"c"]
    found = periodic.runs_of([inner * 100])[0]
    assert (0, 101, 10_100) in found and len(found) == 101


def test_slices_do_not_matter(given):
    rows = [(r["doc_id"], (r["text"] or "").encode().split()) for r in given("documents").collect()]
    words = [periodic.planted_words(*r) for r in rows]
    assert periodic.runs_of(words) == [found for w in words for found in periodic.runs_of([w])]


def test_empty_table(nothing):
    assert periodic.digest_runs(periodic.periodic_runs(nothing)).collect() == []
