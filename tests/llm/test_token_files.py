from __future__ import annotations

import heapq
import zlib

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from catalogmart.llm import token_files as f
from catalogmart.llm.queries import BYTE_BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTE_BPE)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return f.Encoder(BYTE_BPE)


def test_confused_pieces_fall_back_to_the_library(library, monkeypatch):
    encoder = f.Encoder(BYTE_BPE)
    monkeypatch.setattr(f, "_hash", lambda data, start, size: size.astype(np.uint64))
    ids, _ = encoder.encode([b"two old men", b"six new hats"])
    assert ids.tolist() == [*library("two old men"), 0, *library("six new hats"), 0]


def test_forgotten_pieces_are_learned_again(library, monkeypatch):
    monkeypatch.setattr(f, "REMEMBERED", 5)
    encoder = f.Encoder(BYTE_BPE)
    for text in ("a b c d", "e f g h", "a b c d e f g h i j", "x" * 500 + " y"):
        assert encoder.encode([text.encode()])[0].tolist() == [*library(text), 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=1000, deadline=None)
@cases(st.lists(st.text(alphabet="abT \n\t\xa0é'!1,.;: 　<|endoftext|>", max_size=30), max_size=5))
def test_encoder_equals_the_library(library, encoder, values):
    ids, size = encoder.encode([x.encode() for x in values])
    at = 0
    for text, n in zip(values, size):
        assert ids[at : at + n].tolist() == [*library(text), 0]
        at += n


@settings(max_examples=500, deadline=None)
@cases(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "a", " b", "\n", " ", "é"]), max_size=8).map("".join), max_size=5))
def test_added_tokens_are_cut_out_as_the_library_does(library, encoder, values):
    ids, size = encoder.encode([x.encode() for x in values])
    assert size.tolist() == [len(library(x)) + 1 for x in values]
    assert ids.tolist() == [k for x in values for k in [*library(x), 0]]


def test_pieces_of_different_texts_spell_no_added_token(library):
    encoder = f.Encoder(BYTE_BPE)
    encoder.added = [b"x1 y2"]
    assert encoder.encode([b"a x1", b"b", b"c y2"])[0].tolist() == [k for x in ("a x1", "b", "c y2") for k in [*library(x), 0]]


def test_an_added_token_in_a_text(library, encoder):
    assert library("a <|endoftext|> b") == encoder.encode([b"a <|endoftext|> b"])[0].tolist()[:-1] == [64, 220, 50256, 275]


@settings(max_examples=100, deadline=None)
@cases(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=400))
def test_code_lengths_are_limited_and_optimal(counts):
    counts = np.array(counts, np.int64)
    lengths = f.code_lengths(counts, 12).astype(int)
    used = counts > 0
    assert (lengths[~used] == 0).all() and (lengths[used] >= 1).all() and lengths.max(initial=0) <= 12
    if used.sum() > 1:
        assert sum(2.0 ** -lengths[used]) == 1
        heap, cost = sorted(counts[used].tolist()), 0
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        free = f.code_lengths(counts, 16).astype(int)
        if free.max() < 16:
            assert int((counts * free).sum()) == cost


def test_pack_and_unpack():
    rng = np.random.default_rng(1)
    size = np.array([0, 1, 700, 256, 257, 0, 5_000, 3])
    ids = rng.zipf(1.3, int(size.sum())).clip(max=2_000).astype(np.int64)
    lengths = f.code_lengths(np.bincount(ids))
    data, n_bytes, offsets, marks = f.pack(ids, size, lengths, f.canonical_codes(lengths))
    assert len(data) == n_bytes.sum() and len(offsets) == marks.sum() == np.maximum(size - 1, 0).__floordiv__(256).sum()
    assert (f.unpack(data, n_bytes, size, offsets, f.decode_table(lengths)) == ids).all()


@pytest.mark.parametrize("source", ["given", "messy"])
def test_files_hold_the_ids_in_order(spark, given, messy, library, source, tmp_path):
    docs = given("documents") if source == "given" else messy
    f.write_token_files(docs.repartition(3), f"{tmp_path}/files", BYTE_BPE)
    rows = f.read_token_files(spark, f"{tmp_path}/files").collect()
    assert sorted(map(repr, ((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows))) == sorted(
        map(repr, ((r["doc_id"], [*library(r["text"]), 0]) for r in docs.collect()))
    )
    rows.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is None, x))
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1]]


def test_many_blocks_and_files(spark, given, library, monkeypatch, tmp_path):
    monkeypatch.setattr(f, "BLOCK_IDS", 500)
    monkeypatch.setattr(f, "FILE_IDS", 20_000)
    docs = given("documents")
    f.write_token_files(docs, f"{tmp_path}/files", BYTE_BPE)
    assert spark.read.parquet(f"{tmp_path}/files/blocks").count() > 50
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in f.digest_token_files(spark, f"{tmp_path}/files").collect():
        assert (r["n_tokens"], r["ids_crc32"]) == (len(library(text[r["doc_id"]])) + 1, crc([*library(text[r["doc_id"]]), 0]))


def test_empty_table(nothing):
    assert f.token_round_trip(nothing, BYTE_BPE).collect() == []
