"""Periodic runs of words by descending-LCP Kruskal.

A run is a longest stretch of words with smallest period q, at least twice as
long as q. The suffixes of a text are united class by class in the order of
falling LCP; a class holds its places in order. When two classes meet at LCP l,
places that become neighbours at a distance d <= l start a stretch of l + d
words with period d; where the words before the two places differ, the stretch
cannot grow to the left and is a run. Every run is found this way: its start i
and i + q come together at LCP length - q >= q, and a place between them in the
same class would give the run a smaller period.

Only places whose first words, half the least length, occur again in their text
can start a run, so all other places leave before suffixes are sorted.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import per_slice, raw_texts

#: Words of the shortest run that counts.
MIN_LENGTH = 12
#: Places in one part of an ordered set.
PART = 1_024


class Places:
    """An ordered set of places in parts of bounded size, so that adding one does not move all."""

    def __init__(self, place: int):
        self.parts, self.size = [[place]], 1

    def around(self, place: int) -> tuple[int | None, int | None]:
        """The neighbours that place, not in the set, has or would have."""
        parts = self.parts
        k = bisect_right(parts, place, key=lambda part: part[0]) - 1 if len(parts) > 1 else 0
        part = parts[max(k, 0)]
        at = bisect_left(part, place)
        before = part[at - 1] if at else None
        if at < len(part):
            return before, part[at]
        return before, parts[k + 1][0] if k + 1 < len(parts) else None

    def add(self, place: int) -> None:
        parts = self.parts
        k = max(0, bisect_right(parts, place, key=lambda part: part[0]) - 1) if len(parts) > 1 else 0
        insort(parts[k], place)
        if len(parts[k]) > PART:
            parts.insert(k + 1, parts[k][PART // 2 :])
            del parts[k][PART // 2 :]
        self.size += 1


def _repeated(place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key occurs again, key by key, and for each of them the index at which its key begins."""
    order = np.argsort(key)
    place, key = place[order], key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(key)))
    kept = size > 1
    size = size[kept]
    begin = np.cumsum(size) - size
    return place[np.repeat(kept, np.diff(np.append(first, len(key))))], np.repeat(begin, size)


def repeated_grams(word: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """The places whose next length words occur again in their text."""
    n = len(word)
    place = np.flatnonzero(word >= 0)
    place, rank = _repeated(place, text[place] * np.int64(n + 1) + word[place])
    width = 1
    while width < length and len(place):
        step = min(width, length - width)
        gram = np.full(n + length, -1, np.int64)
        gram[place] = rank
        place = place[gram[place + step] >= 0]
        place, rank = _repeated(place, gram[place] * np.int64(n + 1) + gram[place + step])
        width += step
    return place


def sorted_suffixes(word: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in suffix order, and the LCP of each with the one before; 0 for the first of those that share length words.

    word numbers the words of all texts, with -1 after each text. Prefix
    doubling: places of one rank share length * 2^k words. It starts from the
    repeated grams and the places right behind one, since no others are looked
    at: words that occur again up to some place end in a repeated gram.
    """
    place = repeated_grams(word, text, length)
    looked = np.union1d(place, place + length)
    padded = np.append(word, np.full(length, -1, np.int64))
    keys = [padded[looked + k] for k in reversed(range(length))] + [text[looked]]
    by_words = np.lexsort(keys)
    fresh = np.zeros(len(looked), bool)
    fresh[:1] = True
    for key in keys:
        fresh[1:] |= np.diff(key[by_words]) != 0
    rank = np.full(len(padded), -1, np.int64)
    rank[looked[by_words]] = np.maximum.accumulate(np.where(fresh, np.arange(len(looked)), 0))
    ranks, active, width = [], place, length
    while len(active):
        ranks.append(rank.copy())
        first, second = rank[active], rank[active + width]
        order = np.argsort(first * np.int64(len(looked) + 1) + second)
        active, first, second = active[order], first[order], second[order]
        index = np.arange(len(active))
        old = np.append(True, first[1:] != first[:-1])
        new = old | np.append(True, second[1:] != second[:-1])
        last = lambda mark: np.maximum.accumulate(np.where(mark, index, 0))
        rank[active] = first + last(new) - last(old)
        active, width = active[~(new & np.append(new[1:], True))], 2 * width
    order = place[np.argsort(rank[place])]
    lcp = np.zeros(len(order), np.int64)
    if len(order):
        near = 1 + np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]])
        left, right, shared = order[near - 1], order[near], np.zeros(len(near), np.int64)
        for k in reversed(range(len(ranks))):
            shared += np.where(ranks[k][left + shared] == ranks[k][right + shared], length << k, 0)
        for _ in range(length - 1):
            a, b = padded[left + shared], padded[right + shared]
            shared += (a == b) & (a >= 0)
        lcp[near] = shared
    return order, lcp


def _hopeful(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Indices of the pairs (order[i - 1], order[i]) in classes where some distance is within some LCP."""
    if not len(order):
        return np.zeros(0, np.int64)
    begin = np.flatnonzero(lcp == 0)
    group = np.cumsum(lcp == 0) - 1
    most = np.maximum.reduceat(lcp, begin)
    by_place = np.lexsort((order, group))
    gap = np.diff(order[by_place], prepend=0)
    gap[begin] = np.iinfo(np.int64).max
    return np.flatnonzero((lcp > 0) & (np.minimum.reduceat(gap, begin) <= most)[group])


def find_runs(word: np.ndarray, text: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, period, length) of every run, in that order; places count through all texts, word as in sorted_suffixes."""
    order, lcp = sorted_suffixes(word, text, max(1, (min_length + 1) // 2))
    pairs = _hopeful(order, lcp)
    pairs = pairs[np.argsort(-lcp[pairs], kind="stable")]
    words, found = word.tolist() if len(pairs) else [], {}

    def seed(left: int, right: int, shared: int) -> None:
        period = right - left
        if period <= shared and shared + period >= min_length and words[left - 1] != words[right - 1]:
            run = (left, shared + period)
            found[run] = min(period, found.get(run, period))

    home: dict[int, Places] = {}
    for left, right, shared in zip(order[pairs - 1].tolist(), order[pairs].tolist(), lcp[pairs].tolist()):
        large = home.get(left) or home.setdefault(left, Places(left))
        small = home.get(right) or home.setdefault(right, Places(right))
        if large.size < small.size:
            large, small = small, large
        places = [place for part in small.parts for place in part]
        for place in places:
            before, after = large.around(place)
            if before is not None:
                seed(before, place, shared)
            if after is not None:
                seed(place, after, shared)
        for place in places:
            large.add(place)
            home[place] = large
    return sorted((start, period, length) for (start, length), period in found.items())


def plain_words(doc_id, words: list[bytes]) -> list[bytes]:
    return words


def planted_words(doc_id, words: list[bytes]) -> list[bytes]:
    """In a tenth of the texts, chosen by the checksum h of the id, the words from a on repeat the first p of them.

    A null id counts as empty text.
    """
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period, times = words[a : a + p], -(-(n - a) // p)
    return words[:a] + (period * times)[: n - a]


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(start, period, length) of the runs of each text, given as words."""
    number: dict[bytes, int] = {}
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(size + 1) - size - 1
    word = np.full(int((size + 1).sum()), -1, np.int64)
    flat = np.fromiter((number.setdefault(w, len(number)) for words in texts for w in words), np.int64, int(size.sum()))
    text = np.repeat(np.arange(len(texts)), size + 1)
    word[np.flatnonzero(np.arange(len(word)) != (start + size)[text])] = flat
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for place, period, length in find_runs(word, text, min_length):
        k = int(text[place])
        out[k].append((place - int(start[k]), period, length))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space; of every run only the first period stays."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, period, length in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


def periodic_runs(df: DataFrame, min_length: int = MIN_LENGTH, words: Callable = plain_words, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed text of every row.

    words(doc_id, words) may replace the words of a row. A null or empty text has
    no words, no runs and an empty collapsed text; rows that repeat an id count
    on their own; further columns are ignored. One pass without a shuffle; a
    task holds a few megabytes of text, or one text if that is longer.
    """
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def process(part: pa.RecordBatch) -> pa.RecordBatch:
        ids = part.column("doc_id")
        texts = [words(i, t.split()) for i, t in zip(ids.to_pylist(), raw_texts(part))]
        runs = runs_of(texts, min_length)
        columns = [
            ids,
            pa.array(list(map(len, texts)), pa.int64()),
            pa.array([[{"start": s, "length": n, "period": q} for s, q, n in found] for found in runs], run_type),
            pa.array(list(map(collapsed, texts, runs)), pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(per_slice(process), schema)


def digest_runs(runs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the longest run (ties: smallest start, then period;
    null without a run), runs_sha256, collapsed_sha256 and n_words of every row of periodic_runs."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    best = runs.withColumn("best", longest)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
