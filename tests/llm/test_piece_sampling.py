from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from catalogmart.llm import piece_sampling as p
from catalogmart.llm.queries import PIECES
from tests.llm.conftest import by_id


@pytest.fixture(scope="module")
def pieces():
    return p.Pieces(PIECES)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=200, deadline=None)
@cases(st.lists(st.text(alphabet="abthe \n\t é日😀▁　<0x20>", max_size=40), max_size=4), st.integers(0, 1 << 60))
def test_decoding_gives_the_text_back(pieces, library, values, key):
    raw = [x.encode() for x in values]
    ids, size = p.sample(pieces, raw, np.arange(len(raw), dtype=np.uint64) + np.uint64(key))
    assert pieces.decode(ids, size) == raw
    at = 0
    for text, n in zip(values, size):
        assert library.decode(ids[at : at + n].tolist()) == text
        at += n


def segmentations(pieces, word):
    """All piece sequences of a word and their weights."""
    known = {b: k for k, b in enumerate(pieces.bytes) if b and k not in set(pieces.byte_id)}
    if not word:
        return {(): 1.0}
    out = {}
    for n in range(1, len(word) + 1):
        if word[:n] in known:
            k = known[word[:n]]
            for rest, w in segmentations(pieces, word[n:]).items():
                out[k, *rest] = math.exp(pieces.log_weight[k]) * w
    return out


def test_sampling_follows_the_weights(pieces):
    raw, rounds = b"then the", 40_000
    ids, size = p.sample(pieces, [raw] * rounds, np.arange(rounds, dtype=np.uint64))
    first = Counter()
    at = 0
    for n in size:
        own, length, taken = ids[at : at + n].tolist(), 0, []
        for k in own:
            taken.append(k)
            length += len(pieces.bytes[k])
            if length == 5:
                break
        first[tuple(taken)] += 1
        at += n
    weights = segmentations(pieces, b" then")
    total = sum(weights.values())
    for way, w in weights.items():
        share = w / total
        assert abs(first[way] / rounds - share) < 5 * math.sqrt(share / rounds) + 1e-4
    assert sum(first.values()) == rounds and set(first) <= set(weights)


def test_long_words_keep_their_precision(pieces):
    raw = [b"abcdefgh" * 3_000, b"x" * 5_000]
    ids, size = p.sample(pieces, raw, np.zeros(2, np.uint64))
    assert pieces.decode(ids, size) == raw


def test_reproducible_in_any_partitioning(spark, given):
    docs = given("documents")
    one = by_id(p.sample_pieces(docs, PIECES))
    two = by_id(p.sample_pieces(docs.repartition(5).orderBy("text"), PIECES))
    assert all(one[i]["ids"] == two[i]["ids"] for i in one)
    other = by_id(p.sample_pieces(docs, PIECES, seed=8))
    assert any(one[i]["ids"] != other[i]["ids"] for i in one)


@pytest.mark.parametrize("source", ["given", "messy"])
def test_tables_decode(given, messy, source):
    docs = given("documents") if source == "given" else messy
    sampled = p.sample_pieces(docs, PIECES)
    back = sorted(((r["doc_id"], r["text"]) for r in p.decode_pieces(sampled, PIECES).collect()), key=repr)
    assert back == sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=repr)
    digest = p.digest_pieces(docs, PIECES).collect()
    assert all(r["lossless"] for r in digest) and len(digest) == docs.count()


def test_empty_table(nothing):
    assert p.sample_pieces(nothing, PIECES).collect() == []


def test_long_words_are_cut_without_changing_a_draw(pieces, monkeypatch):
    """Texts without blanks, in scripts with many, few and no pieces, and broken bytes: the same ids as uncut and in step."""
    raw = [b"thecatsatonthematandthedogsatontherug" * 60, "日本語のテキストです漢字かな交じり文".encode() * 30, "ééßüñ中文x".encode() * 40]
    raw += [b"\xe6\x97" * 50 + b"abc", b"a" * 2_000, b"", b" a " + b"q" * 300 + b" b", b"short words only"]
    keys = np.arange(len(raw), dtype=np.uint64)
    cut = p.sample(pieces, raw, keys)
    monkeypatch.setattr(p, "LONG", 1 << 30)
    monkeypatch.setattr(p, "FEW", 0)
    plain = p.sample(pieces, raw, keys)
    assert cut[1].tolist() == plain[1].tolist() and cut[0].tolist() == plain[0].tolist()
    assert pieces.decode(*cut) == raw


def test_cuts_are_where_no_piece_crosses(pieces):
    words = [b" thecatsat", "日本語".encode(), b"x", "é中".encode() * 3]
    for word, parts in zip(words, p.cut_words(pieces, words)):
        assert b"".join(parts) == word and all(parts)
        at, length, _, _, _ = p._edges(pieces, [word])
        inner = {k for a, n in zip(at.tolist(), length.tolist()) for k in range(a + 1, a + n)}
        ends = set(np.cumsum([len(x) for x in parts]).tolist()) - {len(word)}
        assert ends == {k for k in range(1, len(word)) if k not in inner and word[k] & 0xC0 != 0x80}


def test_texts_without_blanks_take_linear_time(pieces):
    import time

    begin = time.process_time()
    body = b"thequickbrownfoxjumpsoverthelazydogwhileotheranimalsarelooking" * 16_000
    ids, size = p.sample(pieces, [body], np.zeros(1, np.uint64))
    assert pieces.decode(ids, size) == [body] and time.process_time() - begin < 20
