"""Quality rules: byte n-gram perplexity under a modified Kneser-Ney model.

Spark counts the 5-grams of all texts per language and derives continuation
counts, discounts, probabilities and backoff weights by grouping and joining.
The finished model is stored in sorted hash arrays, slices of bounded size by
language and by the two bytes before the scored one: in a pass over the texts
each byte is looked up if the pass's slice is its own, so driver and workers hold
one slice, however large the model. The texts of a language are counted in two parts, and each part is scored by the
other's model, so no text and none of its copies is predicted from itself. A
document is rejected when its perplexity leaves the band of its language.

Grams are bytes, not words: the corpus has about as many word bigrams as words,
so shuffling them would take more disk than the input, while the byte grams of a
language are few and their counts still come from every text.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import SLICE_BYTES, Scratch, SortedHashes, cached, joined, per_slice, raw_texts, sums, xxhash_long
from catalogmart.llm.grams import GRAM_BITS, ORDER, count_grams, gram_keys, label_codes

#: A band reaches this many quartile distances beyond the quartiles of its language.
REACH = 3.1
#: Texts fall into so many parts by their hash; each part is scored by the counts of the next one.
PARTS = 2
#: Grams of three bytes and more that a slice of the model holds, about; their contexts come on top.
SLICE_GRAMS = 8_000_000
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"

_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class Model(NamedTuple):
    hashes: np.ndarray
    log2: np.ndarray
    kind: np.ndarray


def _entry(kind: int, key):
    """Hash of a model entry; kind is 2n for probabilities of order n and 2n+1 for backoff weights of contexts.

    XXH64 of a 64-bit integer is a bijection for each seed: with its kind, a hash stands for one entry.
    """
    return F.xxhash64(F.lit(kind).cast("long"), key)


def _hash(kind: int, keys: np.ndarray) -> np.ndarray:
    return xxhash_long(keys, xxhash_long(np.array([kind]), 42)[0])


def _find(model: Model, table: SortedHashes, kind: int, keys: np.ndarray) -> np.ndarray:
    """Place of each entry of the kind, -1 where the model has none."""
    place = table.find(_hash(kind, keys))
    return np.where((place >= 0) & (model.kind[place] == kind), place, -1) if len(model.kind) else place


def kneser_ney(counts: DataFrame, scratch: Scratch) -> DataFrame:
    """Model entries (kind, slot, log2, home) from gram counts (key, c).

    home is the label code and the two bytes before the scored one, null for
    grams of one or two bytes, which every slice holds.

    Discounts are per language and order; where the counts of counts leave one
    undefined it is 0.5, 1 or 1.5.
    """
    code = F.shiftrightunsigned("key", GRAM_BITS)
    level = scratch.keep(counts.select(code.alias("code"), F.col("key").bitwiseAND((1 << GRAM_BITS) - 1).alias("gram"), "c"))
    levels = {ORDER: level}
    for n in range(ORDER - 1, 0, -1):
        mask = (1 << (8 * n)) - 1
        level = scratch.keep(levels[n + 1].groupBy("code", F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.count("*").alias("c")))
        levels[n] = level
    entries, lower = None, None
    for n in range(1, ORDER + 1):
        of = [F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
        y = F.expr("n1 / nullif(n1 + 2 * n2, 0)")
        d = levels[n].groupBy("code").agg(*of).withColumn("y", y)
        for k in (1, 2, 3):
            raw = F.expr(f"{k} - {k + 1} * y * n{k + 1} / nullif(n{k}, 0)")
            d = d.withColumn(f"d{k}", F.when(raw.between(0.01, k - 0.01), raw).otherwise(F.lit(k / 2)))
        grams = levels[n].join(scratch.small(d.select("code", "d1", "d2", "d3")), "code")
        grams = grams.withColumn("d", F.expr("CASE WHEN c = 1 THEN d1 WHEN c = 2 THEN d2 ELSE d3 END"))
        grams = grams.withColumn("context", F.shiftrightunsigned("gram", 8))
        contexts = grams.groupBy("code", "context").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("gamma"))
        own = grams.join(contexts, ["code", "context"])
        if lower is None:
            own = own.withColumn("p", F.expr("(c - d) / total + gamma / 256"))
        else:
            low = lower.select("code", F.col("gram").alias("suffix"), F.col("p").alias("p_low"))
            own = own.withColumn("suffix", F.col("gram").bitwiseAND((1 << (8 * (n - 1))) - 1)).join(low, ["code", "suffix"])
            own = own.withColumn("p", F.expr("(c - d) / total + gamma * p_low"))
        lower = scratch.keep(own.select("code", "gram", "context", "p", "gamma"))
        key = lambda x: F.shiftleft("code", GRAM_BITS).bitwiseOR(F.col(x))
        own_home = lambda before: (_home(F.col("code"), before) if n > 2 else F.lit(None).cast("long")).alias("home")
        entry = lambda kind, x, value: [F.lit(kind).cast("byte").alias("kind"), _entry(kind, key(x)).alias("slot"), F.log2(value).cast("float").alias("log2"), own_home(F.col("context"))]
        level = lower.select(*entry(2 * n, "gram", "p"))
        back = lower.groupBy("code", "context").agg(F.max("gamma").alias("gamma"))
        level = level.union(back.select(*entry(2 * n + 1, "context", "gamma")))
        entries = level if entries is None else entries.union(level)
    return entries


def _home(code, before):
    """Label code and last two bytes of a context, for columns and for arrays."""
    if isinstance(before, Column):
        return F.shiftleft(code, 16).bitwiseOR(before.bitwiseAND(0xFFFF))
    return (code << np.uint64(16)) | (before & np.uint64(0xFFFF))


def in_slice(home: np.ndarray, k: int, of: int) -> np.ndarray:
    """Whether each home belongs to slice k, as slice_entries deals them."""
    return xxhash_long(home).view(np.int64) % of == k


def slice_entries(entries: DataFrame, k: int, of: int) -> DataFrame:
    return entries.where(F.col("home").isNull() | (F.pmod(F.xxhash64("home"), F.lit(of)) == k))


def collect_model(entries: DataFrame) -> Model:
    """The sorted hash array of a slice, with the kind of every entry to verify what is found.

    Two entries of different kinds with one 64-bit hash, which have a chance of
    one in 100,000 even among 2**24, end the query rather than stand for each other.
    """
    table = entries.select("kind", "slot", "log2").toArrow()
    slot = table.column("slot").to_numpy().view(np.uint64)
    order = np.argsort(slot)
    hashes = slot[order]
    if (hashes[1:] == hashes[:-1]).any():
        raise ValueError("two model entries share a 64-bit hash")
    return Model(hashes, table.column("log2").to_numpy()[order], table.column("kind").to_numpy()[order])


def log2_probabilities(model: Model, table: SortedHashes, codes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """log2 probability of each gram's last byte after the others, backing off to shorter grams where one is unseen."""
    out = np.zeros(len(keys), np.float32)
    rest, top = np.arange(len(keys)), codes << np.uint64(GRAM_BITS)
    for n in range(ORDER, 0, -1):
        gram = keys[rest] & np.uint64((1 << (8 * n)) - 1)
        place = _find(model, table, 2 * n, gram | top[rest])
        seen = place >= 0
        out[rest[seen]] += model.log2[place[seen]]
        rest, gram = rest[~seen], gram[~seen]
        if not len(rest):
            return out
        place = _find(model, table, 2 * n + 1, (gram >> np.uint64(8)) | top[rest])
        known = place >= 0
        out[rest[known]] += model.log2[place[known]]
    out[rest] -= 8
    return out


def repeated_words(words: np.ndarray, of: np.ndarray, n: int, width: int = WINDOW) -> np.ndarray:
    """Words per text that lie in a window of width words found twice or more in the text.

    words holds 64-bit hashes; windows compare by a 64-bit hash of theirs.
    """
    out = np.zeros(n, np.int64)
    count = len(words) - width + 1
    if count < 2:
        return out
    with np.errstate(over="ignore"):
        key = np.zeros(count, np.uint64)
        for k in range(width):
            key = key * np.uint64(0xD1342543DE82EF95) + words[k : k + count]
        key = xxhash_long(key) + xxhash_long(of[:count])
    inside = np.flatnonzero(of[:count] == of[width - 1 :])
    ordered = np.sort(key[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    place = np.minimum(np.searchsorted(twice, key[inside]), len(twice) - 1)
    hit = inside[twice[place] == key[inside]]
    cover = np.zeros(len(words) + 1, np.int64)
    cover[hit] += 1
    cover[hit + width] -= 1
    covered = np.cumsum(cover[:-1]) > 0
    return np.bincount(of[covered], minlength=n)


def base_counts(parts: list[bytes]) -> list[np.ndarray]:
    """Words, word characters, symbols, repeated lines and words in repeated windows, per text."""
    data, start, size = joined(parts)
    flag = np.zeros(256, np.int8)
    flag[:] = 1
    flag[0x80:0xC0] = 0
    flag[list(BLANKS)] = 0
    symbol = np.zeros(256, np.int8)
    symbol[list(SYMBOLS)] = 1
    word_lists = [x.split() for x in parts]
    n_words = np.fromiter(map(len, word_lists), np.int64, len(parts))
    total = int(n_words.sum())
    words = np.fromiter((hash(w) for ws in word_lists for w in ws), np.int64, total).view(np.uint64)
    lines = []
    for part in parts:
        with_word = [x for x in part.split(b"\n") if x.strip()] if b"\n" in part else []
        lines.append(len(with_word) - len(set(with_word)))
    repeated = repeated_words(words, np.repeat(np.arange(len(parts)), n_words), len(parts))
    return [n_words, sums(flag[data], start, size), sums(symbol[data], start, size), np.array(lines, np.int64), repeated]


def part_label(text: str, lang: str, ahead: int = 0) -> Column:
    """Label of a language's part: that of the text, or the one so many parts ahead."""
    part = F.pmod(F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(PARTS)) + ahead, F.lit(PARTS))
    return F.concat_ws(" ", part.cast("string"), F.col(lang))


def _table(name: str, own: Model) -> SortedHashes:
    """The sorted hashes of the named slice; a worker holds those of one slice."""
    held = cached(("quality",), dict)
    if name not in held:
        held.clear()
        held[name] = SortedHashes(own.hashes)
    return held[name]


def _scored(df: DataFrame, shared: Broadcast, k: int, of: int, text: str, counted: bool) -> DataFrame:
    """Negative log2 probability (bits) of the bytes of each text whose slice is k of so many, under the counts of label.

    With counted the rows have all their columns but text, and the base counts;
    else only digest, label and bits.
    """
    name = uuid.uuid4().hex
    kept = [c for c in df.columns if c != text] if counted else ["digest", "label"]

    def process(part):
        own = Model(*shared.value)
        table = _table(name, own)
        raw = raw_texts(part, text)
        keys, start, size = gram_keys(raw)
        codes = np.repeat(label_codes(part.column("label").to_pylist()), size)
        if of == 1:
            log2 = log2_probabilities(own, table, codes, keys)
        else:
            here = np.flatnonzero(in_slice(_home(codes, keys >> np.uint64(8)), k, of))
            log2 = np.zeros(len(keys), np.float32)
            log2[here] = log2_probabilities(own, table, codes[here], keys[here])
        columns = [*(part.column(c) for c in kept), pa.array(-sums(log2, start, size))]
        columns += [*map(pa.array, base_counts(raw)), pa.array(size)] if counted else []
        return pa.RecordBatch.from_arrays(columns, names)

    kind = dict(df.dtypes)
    fields = [f"{c} {kind[c]}" for c in kept] + ["bits double"] + ([*_BASE.split(", "), "n_bytes long"] if counted else [])
    names = [x.split()[0] for x in fields]
    return df.mapInArrow(per_slice(process, text, SLICE_BYTES // 4), ", ".join(fields))


def measure(
    df: DataFrame, entries: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    label: Column | None = None, slice_grams: int = SLICE_GRAMS,
) -> DataFrame:
    """doc_id, lang, the base counts, and log2_perplexity (bits per byte; null for an empty text) under the label's counts.

    entries is what kneser_ney returns. The texts are read once per slice of the
    model; the bits of a text's bytes, told by its digest and label, add up over
    the slices.
    """
    of = max(1, -(-entries.where("kind >= 6 AND kind % 2 = 0").count() // slice_grams))
    rows = df.select(
        F.col(doc_id).alias("doc_id"),
        F.col(lang).alias("lang"),
        F.coalesce(F.col(lang) if label is None else label, F.lit("")).alias("label"),
        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("digest"),
        F.col(text).alias("text"),
    )
    passes = []
    for k in range(of):
        shared = df.sparkSession.sparkContext.broadcast(tuple(collect_model(slice_entries(entries, k, of))))
        passes.append(scratch.keep(_scored(rows, shared, k, of, "text", k == 0)))
        shared.destroy()  # the pass is written; the next one has a slice of its own
    found, more = passes[0], [rest.withColumn("k", F.lit(k)) for k, rest in enumerate(passes[1:])]
    if more:
        # Equal texts of one label have equal bits in every pass.
        one = reduce(DataFrame.unionAll, more).groupBy("digest", "label", "k").agg(F.max("bits").alias("bits"))
        further = one.groupBy(F.col("digest").alias("d"), F.col("label").alias("l")).agg(F.sum("bits").alias("further"))
        found = found.join(further, (F.col("digest") == F.col("d")) & (F.col("label") == F.col("l")), "left")
        found = found.withColumn("bits", F.col("bits") + F.col("further"))
    per_byte = F.when(F.col("n_bytes") > 0, F.col("bits") / F.col("n_bytes"))
    return found.select("doc_id", "lang", *[x.split()[0] for x in _BASE.split(", ")], per_byte.alias("log2_perplexity"))


def bands(measured: DataFrame, reach: float = REACH) -> DataFrame:
    """Per language the lower and upper log2 perplexity, from the documents that pass the base rules."""
    q = F.percentile_approx("log2_perplexity", [0.25, 0.75], 10_000)
    spread = measured.where(~base_failed()).groupBy("lang").agg(q.alias("q"))
    low, high = F.col("q")[0], F.col("q")[1]
    wide = reach * (high - low)
    return spread.select("lang", (low - wide).alias("band_low"), (high + wide).alias("band_high"))


def base_failed():
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def quality_rules(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", reach: float = REACH, slice_grams: int = SLICE_GRAMS) -> DataFrame:
    """One row per document: base counts, perplexity, band and verdict.

    A null text counts as empty and fails (no words); a null language is a
    language of its own; repeated rows each get their row. A language without a
    document that passes the base rules has no band, and nothing of it is kept.
    Further columns of df are ignored.
    """
    scratch = Scratch(df.sparkSession, "quality")
    labelled = df.select(F.col(text).alias("text"), part_label(text, lang).alias("lang"))
    entries = kneser_ney(count_grams(labelled), scratch)
    measured = scratch.keep(measure(df, entries, scratch, doc_id, text, lang, part_label(text, lang, 1), slice_grams))
    found = measured.alias("m").join(scratch.small(bands(measured, reach)).alias("b"), F.expr("m.lang <=> b.lang"), "left")
    inside = F.col("log2_perplexity").between(F.col("band_low"), F.col("band_high"))
    return found.select(
        F.col("m.doc_id").alias("doc_id"),
        *[F.col(x.split()[0]) for x in _BASE.split(", ")],
        base_failed().alias("base_failed"),
        F.pow(F.lit(2.0), "log2_perplexity").alias("perplexity"),
        F.pow(F.lit(2.0), "band_low").alias("perplexity_low"),
        F.pow(F.lit(2.0), "band_high").alias("perplexity_high"),
        (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept"),
    )
