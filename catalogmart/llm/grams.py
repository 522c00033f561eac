"""Byte n-grams of texts as integers, counted per label by Spark."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import joined, raw_texts, slices

ORDER = 5
GRAM_BITS = 8 * ORDER
#: Distinct grams that a task holds before it hands them on.
HELD = 2_000_000


def label_codes(labels: list) -> np.ndarray:
    """24 bits per label; a null counts as the empty label. Labels that share a code share a model."""
    known = {x: zlib.crc32((x or "").encode()) & 0xFFFFFF for x in set(labels)}
    return np.array([known[x] for x in labels], np.uint64)


def gram_keys(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One 40-bit gram per text byte (four bytes of context, zero before the text); start and size of each text."""
    data, start, size = joined([x.lower() for x in parts], ORDER - 1)
    if len(data) < ORDER:
        return np.zeros(0, np.uint64), np.cumsum(size) - size, size
    wide = data.astype(np.uint64)
    keys = wide[ORDER - 1 :].copy()
    for k in range(1, ORDER):
        keys |= wide[ORDER - 1 - k : len(wide) - k] << np.uint64(8 * k)
    own = np.ones(len(data), bool)
    for k in range(1, ORDER):
        own[start - k] = False
    return keys[own[ORDER - 1 :]], np.cumsum(size) - size, size


def _counted(keys: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weight is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, weight = keys[order], weight[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if weight is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(weight, first) if len(first) else weight[:0]


def count_grams(df: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """Counts of every gram of every whole text by label: key (label code above the 40 bits of the gram), c."""

    def partial(batches):
        def out(pairs):
            return pa.RecordBatch.from_arrays([pa.array(pairs[0].view(np.int64)), pa.array(pairs[1].astype(np.int64))], ["key", "c"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part in slices(batch, "text"):
                keys, _, size = gram_keys(raw_texts(part))
                codes = label_codes(part.column("label").to_pylist())
                held.append(_counted(keys | (np.repeat(codes, size) << np.uint64(GRAM_BITS))))
                if len(held) == 8:
                    held = [_counted(*map(np.concatenate, zip(*held)))]
                    if len(held[0][0]) > HELD:
                        yield out(held.pop())
        if held:
            yield out(_counted(*map(np.concatenate, zip(*held))))

    narrow = df.select(F.col(text).alias("text"), F.col(label).alias("label"))
    return narrow.mapInArrow(partial, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
