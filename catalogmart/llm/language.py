"""Language identification by prediction by partial matching.

One frozen byte context tree of order four per language. A byte costs, from the
longest context seen in training downwards, one escape per context that has not
seen it and then its own share; symbols of the contexts left behind are
excluded. The language with the shortest code length wins.
"""

from __future__ import annotations

import re
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import SLICE_BYTES, Scratch, SortedHashes, cached, held_out, raw_texts, slices, sums, xxhash_long
from catalogmart.llm.grams import GRAM_BITS, ORDER, count_grams, gram_keys, label_codes

#: Expected bytes of training text per language; documents are drawn by the hash of their id.
TRAIN_BYTES = 2_000_000
#: More learned languages than this are refused: a model holds a code length per language and gram.
MAX_LANGUAGES = 1_000
#: Grams whose code lengths a worker remembers, over all languages.
REMEMBERED = 4_000_000

UNKNOWN = "und"
_LETTER = re.compile(rb"[A-Za-z]")


class Trees(NamedTuple):
    """Per language: sorted hashes of (level, gram) with their counts, and of (level, context) with total, symbols and
    the total that the next shorter context has for the same symbols."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]


def training_rows(df: DataFrame, budget: int = TRAIN_BYTES) -> DataFrame:
    """lang and text of labelled rows outside the held-out part, about budget bytes of each language."""
    rows = df.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    size = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"))
    share = F.least(F.lit(1.0), F.lit(float(budget)) / F.greatest(F.col("bytes"), F.lit(1)))
    wanted = size.select("lang", share.alias("share")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(wanted) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not wanted:
        return rows.select("lang", "text").limit(0)
    shares = F.create_map(*[F.lit(x) for row in wanted for x in (row["lang"], float(row["share"]))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(draw < shares[F.col("lang")]).select("lang", "text")


def _hash(level: int, keys: np.ndarray) -> np.ndarray:
    return xxhash_long(keys, 1000 + level)


def _grouped(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *[np.add.reduceat(v[order], first) if len(first) else v for v in values]


def grow(gram: np.ndarray, count: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """The context tree of one language from its counted grams."""
    levels = {ORDER: (gram, count)}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = _grouped(levels[n + 1][0] & np.uint64((1 << (8 * n)) - 1), levels[n + 1][1])
    g_hash, g_count, c_hash, c_stat = [], [], [], []
    for n in range(1, ORDER + 1):
        gram, count = levels[n]
        below = np.zeros(len(gram), np.int64)
        if n > 1:
            place = np.searchsorted(levels[n - 1][0], gram & np.uint64((1 << (8 * (n - 1))) - 1))
            below = levels[n - 1][1][place]
        context, total, symbols, shared = _grouped(gram >> np.uint64(8), count, np.ones(len(gram), np.int64), below)
        g_hash.append(_hash(n, gram))
        g_count.append(count)
        c_hash.append(_hash(n + 100, context))
        c_stat.append(np.column_stack([total, symbols, shared]))

    def ordered(hashes, values):
        hashes, values = np.concatenate(hashes), np.concatenate(values)
        order = np.argsort(hashes)
        return hashes[order], values[order].astype(np.float64)

    return ordered(g_hash, g_count), ordered(c_hash, c_stat)


def train(df: DataFrame, budget: int = TRAIN_BYTES) -> Trees:
    """Context trees from doc_id, lang and text; only labelled rows outside the held-out part count.

    What reaches the driver is bounded by budget bytes per language.
    """
    sample = Scratch(df.sparkSession, "language").keep(training_rows(df, budget))
    languages = sorted(row["lang"] for row in sample.select("lang").distinct().collect())
    codes = label_codes(languages).tolist()
    if len(set(codes)) < len(codes):
        raise ValueError("two languages share a code")
    table = count_grams(sample).toArrow()
    key = table.column("key").to_numpy().view(np.uint64)
    count = table.column("c").to_numpy()
    order = np.argsort(key)
    key, count = key[order], count[order]
    own = key >> np.uint64(GRAM_BITS)
    trees = []
    for code in codes:
        mine = own == np.uint64(code)
        trees.append(grow(key[mine] & np.uint64((1 << GRAM_BITS) - 1), count[mine]))
    return Trees(languages, [t[0] for t in trees], [t[1] for t in trees])


class Coder:
    """Code lengths of grams, remembered over the slices of a worker."""

    def __init__(self, trees: Trees):
        self.trees = trees
        self.grams = [SortedHashes(x[0]) for x in trees.grams]
        self.contexts = [SortedHashes(x[0]) for x in trees.contexts]
        self.forget()

    def forget(self) -> None:
        self.known, self.bits = np.zeros(0, np.uint64), np.zeros((0, len(self.grams)), np.float32)
        self.table = SortedHashes(self.known)

    def _length(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte after the four before it, in the tree of one language."""
        bits, rest = np.zeros(len(keys)), np.arange(len(keys))
        left_total, left_symbols = np.zeros(len(keys)), np.zeros(len(keys))
        for n in range(ORDER, 0, -1):
            gram = keys[rest] & np.uint64((1 << (8 * n)) - 1)
            place = self.contexts[k].find(_hash(n + 100, gram >> np.uint64(8)))
            seen = place >= 0
            stat = np.where(seen[:, None], self.trees.contexts[k][1][np.maximum(place, 0)], 0.0) if len(self.trees.contexts[k][1]) else np.zeros((len(rest), 3))
            total, symbols = stat[:, 0] - left_total[rest], stat[:, 1] - left_symbols[rest]
            at = self.grams[k].find(_hash(n, gram))
            hit = at >= 0
            own = self.trees.grams[k][1][at[hit]]
            bits[rest[hit]] += np.log2((total + symbols)[hit] / own)
            miss = ~hit & seen & (symbols > 0)
            bits[rest[miss]] += np.log2((total + symbols)[miss] / symbols[miss])
            left_total[rest[seen]], left_symbols[rest[seen]] = stat[seen, 2], stat[seen, 1]
            rest = rest[~hit]
            if not len(rest):
                return bits
        bits[rest] += np.log2(np.maximum(256 - left_symbols[rest], 1))
        return bits

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Code lengths of each key, one column per language."""
        hashes = xxhash_long(keys)
        place = self.table.find(hashes)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            if (len(new) + len(self.known)) * len(self.grams) > REMEMBERED:
                self.forget()
                new, first = np.unique(hashes, return_index=True)
                missing = np.arange(len(keys))
            fresh = keys[missing[first]]
            bits = np.column_stack([self._length(k, fresh) for k in range(len(self.grams))]).astype(np.float32)
            known, bits = np.concatenate([self.known, new]), np.concatenate([self.bits, bits])
            order = np.argsort(known)
            self.known, self.bits = known[order], bits[order]
            self.table = SortedHashes(self.known)
            place = self.table.find(hashes)
        return self.bits[place]


def has_letter(raw: bytes) -> bool:
    return bool(_LETTER.search(raw)) or any(map(str.isalpha, raw.decode("utf-8", "replace")))


def code_lengths(coder: Coder, raw: list[bytes]) -> np.ndarray:
    """Bits of each whole text under each language; ASCII capitals count as small letters."""
    keys, start, size = gram_keys(raw)
    return sums(coder.rows(keys).astype(np.float64), start, size) if len(keys) else np.zeros((len(raw), len(coder.grams)))


def identify_languages(df: DataFrame, trees: Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    score is the posterior of the predicted language under equal priors. A text
    that is null or has no letter gets ``und`` with score 0, as does every text
    when nothing was learned. Ties go to the first language by name. Other
    columns of df are ignored.
    """
    shared, name = df.sparkSession.sparkContext.broadcast(tuple(trees)), uuid.uuid4().hex

    def process(part):
        coder = cached(("language", name), lambda: Coder(Trees(*shared.value)))
        raw = raw_texts(part)
        best, score = np.full(len(raw), UNKNOWN, object), np.zeros(len(raw))
        lettered = np.fromiter(map(has_letter, raw), bool, len(raw))
        if coder.trees.languages and lettered.any():
            some = np.flatnonzero(lettered)
            bits = code_lengths(coder, [raw[i] for i in some])
            gap = bits - bits.min(axis=1, keepdims=True)
            score[some] = 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
            best[some] = np.array(coder.trees.languages, object)[bits.argmin(axis=1)]
        arrays = [part.column("doc_id"), part.column("held_out"), pa.array(best, pa.string()), pa.array(score)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "lang_pred", "score"])

    limit = max(1, SLICE_BYTES * 4 // max(4, len(trees.languages)))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", limit):
                yield process(part)

    narrow = df.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    return narrow.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
