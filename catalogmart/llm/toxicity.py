"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding, normalised by length, with exception phrases.

The lexicon is learned from labelled rows outside the held-out part: word
beginnings and whole words whose log odds of being in a toxic document are high
and significant. Only a bounded sample of labelled rows is read for it.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from catalogmart.llm.common import Scratch, cached, held_out, per_slice, texts

#: Labelled rows read for learning, by the hash of their id.
TOXIC_ROWS, CLEAN_ROWS = 3_000, 9_000
#: Candidate entries taken into the second count, by support.
CANDIDATES = 20_000
PREFIXES = (4, 5, 6, 7, 8)
MIN_SUPPORT, MIN_WEIGHT, MIN_Z = 4, 3.0, 2.8
#: A beginning with a lower weight is split into longer ones.
SPLIT_BELOW = 5.0
#: A beginning is extended while so many of its documents have the longer one.
SAME_SHARE = 0.95

# Characters that look like a letter, and digits and signs written for one.
# Small l and i fold together since the digit 1 stands for both.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "i", "һ": "h",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ℓ": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ո": "n", "ս": "u", "օ": "o", "ⅼ": "i", "ⅰ": "i",
    "l": "i", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
    "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "", "\ufeff": "", "\u00ad": "",
}
#: Phrases in which an entry is harmless; further ones may be passed.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "not stupid", "sore loser rule", "no idiot")


def fold_table() -> dict[int, str]:
    """Translation of single characters, with the full-width forms of ASCII."""
    table = {ord(a): b for a, b in HOMOGLYPHS.items()}
    for code in range(0x21, 0x7F):
        plain = chr(code).lower()
        table[code + 0xFEE0] = HOMOGLYPHS.get(plain, plain)
    return table


_FOLD = fold_table()


def fold(text: str) -> str:
    return text.lower().translate(_FOLD)


class Lexicon(NamedTuple):
    """Entries with weights (whole words end in a blank), exception phrases, and the coefficients of the score."""

    entries: dict[str, float]
    exceptions: tuple[str, ...]
    coefficients: tuple[float, ...]


def document_features(text: str) -> set[str]:
    """Beginnings of the folded words and the whole words, the latter with a blank."""
    found = set()
    for word in set(re.findall(r"[^\W_]+", fold(text))):
        found.update(word[:k] for k in PREFIXES if len(word) >= k)
        found.add(word + " ")
    return found


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic_rows: int, clean_rows: int) -> DataFrame:
    """text and toxic of at most so many labelled rows of either class outside the held-out part."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out("doc_id") & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    drawn = None
    for value, rows in ((1, toxic_rows), (0, clean_rows)):
        some = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        drawn = some if drawn is None else drawn.union(some)
    narrow = docs.where(~held_out("doc_id")).select("doc_id", "text")
    return narrow.join(F.broadcast(drawn), "doc_id").select("text", "toxic")


def _count(sample: DataFrame, features) -> DataFrame:
    """Documents by class that have each feature."""

    def partial(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist()):
                counts.update((x, toxic) for x in features(text))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
            ["feature", "toxic", "n"],
        )

    return sample.mapInArrow(partial, "feature string, toxic int, n long").groupBy("feature", "toxic").agg(F.sum("n").alias("n"))


def choose_entries(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Weighted entries: significant ones; of one family the shortest that is precise, extended as far as it is always
    followed by the same letters, so that harmless words with the same beginning stay outside."""

    def weight(x: str) -> tuple[float, float]:
        a, b = toxic.get(x, 0) + 0.5, clean.get(x, 0) + 0.5
        w = math.log(a / (n_toxic + 1)) - math.log(b / (n_clean + 1))
        return w, w / math.sqrt(1 / a + 1 / b)

    taken: dict[str, float] = {}
    for x in sorted(toxic, key=lambda x: (len(x), x)):
        w, z = weight(x)
        if w < MIN_WEIGHT or z < MIN_Z or any(x[:k] in taken for k in range(min(PREFIXES), len(x))):
            continue
        if w < SPLIT_BELOW and not x.endswith(" ") and any(
            weight(y)[0] > w + 0.7 and toxic[y] >= 0.5 * toxic[x] for y in toxic if len(y) > len(x) and y.startswith(x)
        ):
            continue  # a longer beginning says more
        taken[x] = w
    return {y: weight(y)[0] for y in (_extended(x, toxic) for x in taken)}


def _extended(x: str, toxic: dict[str, int]) -> str:
    """The longest beginning or word that nearly all documents with x have."""
    longer = [y for y in toxic if y.startswith(x) and toxic[y] >= SAME_SHARE * toxic[x]]
    return max(longer, key=lambda y: (len(y), y), default=x)


def automaton(lexicon: Lexicon):
    """Aho-Corasick over entries and exception phrases, all folded; None when there is nothing to match."""
    found = ahocorasick.Automaton()
    for entry, weight in lexicon.entries.items():
        word = entry.rstrip(" ")
        found.add_word(word, (len(word), weight, entry.endswith(" ")))
    for phrase in lexicon.exceptions:
        folded = fold(phrase)
        if folded and folded not in found:
            found.add_word(folded, (len(folded), 0.0, None))
    if not len(found):
        return None
    found.make_automaton()
    return found


def matches(machine, folded: str) -> list[tuple[int, float]]:
    """Start and weight of each entry at the beginning of a word, outside exception phrases; the heaviest per start."""
    hits: dict[int, float] = {}
    excused = []
    for end, (length, weight, whole) in machine.iter(folded):
        start = end - length + 1
        if start and folded[start - 1].isalnum():
            continue
        if whole is None:
            excused.append((start, end))
        elif not whole or end + 1 == len(folded) or not folded[end + 1].isalnum():
            hits[start] = max(weight, hits.get(start, 0.0))
    if excused:
        hits = {s: w for s, w in hits.items() if not any(a <= s <= b for a, b in excused)}
    return sorted(hits.items())


def text_features(machine, text: str) -> tuple[float, float, float]:
    """Logarithm of the summed weights, the sum over the root of the words, and whether anything matched."""
    hits = matches(machine, fold(text)) if machine else []
    total = sum(w for _, w in hits)
    return math.log1p(total), total / math.sqrt(text.count(" ") + 4), float(len(hits) > 1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Coefficients (the first is the constant) by Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    keep = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - keep @ beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, gradient)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, beta))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Lexicon:
    """Lexicon and score from at most toxic_rows and clean_rows labelled rows; the driver gets counts of at most
    CANDIDATES entries and three numbers per sampled row. Without toxic or without clean rows the lexicon is empty and
    every score is low."""
    sample = Scratch(docs.sparkSession, "toxicity").keep(labelled_sample(docs, labels, toxic_rows, clean_rows))
    size = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, exceptions, (-2.0, 0.0, 0.0, 0.0))
    frequent = _count(sample.where("toxic = 1"), document_features).where(F.col("n") >= max(MIN_SUPPORT, n_toxic // 200))
    toxic = {row["feature"]: row["n"] for row in frequent.orderBy(F.desc("n"), "feature").limit(CANDIDATES).collect()}
    wanted = frozenset(toxic)
    in_clean = _count(sample.where("toxic = 0"), lambda text: document_features(text) & wanted)
    clean = {row["feature"]: row["n"] for row in in_clean.collect()}
    lexicon = Lexicon(choose_entries(toxic, clean, n_toxic, n_clean), exceptions, ())

    def process(part):
        machine = automaton(lexicon)
        rows = np.array([text_features(machine, x) for x in texts(part)]).reshape(-1, 3)
        return pa.RecordBatch.from_arrays([*[pa.array(rows[:, k]) for k in range(3)], part.column("toxic")], ["a", "b", "c", "toxic"])

    table = sample.mapInArrow(per_slice(process), "a double, b double, c double, toxic int").toPandas()
    table = table.sort_values(["a", "b", "c", "toxic"])
    return lexicon._replace(coefficients=_logistic(table[["a", "b", "c"]].to_numpy(), table["toxic"].to_numpy()))


def toxicity(lexicon: Lexicon, text: Column | str) -> Column:
    """Score column, 0 to 1; a null counts as an empty text."""
    name = uuid.uuid4().hex

    @pandas_udf("double")
    def score(values: pd.Series) -> pd.Series:
        machine = cached(("toxicity", name), lambda: automaton(lexicon))
        constant, *slope = lexicon.coefficients
        out = [constant + sum(a * b for a, b in zip(slope, text_features(machine, x or ""))) for x in values]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, float), -30, 30))))

    return score(text)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= 0.5) of every row; nulls count as empty texts."""
    scored = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), toxicity(lexicon, F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score below threshold, all columns kept."""
    return docs.where(toxicity(lexicon, F.col("text")) < threshold)
