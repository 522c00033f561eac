"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogmart.sources.tables import shared_folder

#: Bytes of text that one step inside a task works on.
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


class Scratch:
    """Tables written below the shared folder of the session; the folder goes when the session ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows of df, written once and read back; survives lost executors and cuts the lineage."""
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def small(self, df: DataFrame, rows: int = 10_000) -> DataFrame:
        """df kept, and marked for broadcasting if it has so few rows; else a plain table that joins by shuffling."""
        kept = self.keep(df)
        return F.broadcast(kept) if kept.count() <= rows else kept


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be none of the columns, in any case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def require_whole_ids(df: DataFrame, doc_id: str) -> str:
    """The type of the ids; TypeError unless they are whole numbers of at most 64 bits."""
    kind = dict(df.select(F.col(doc_id).alias("id")).dtypes)["id"]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{doc_id} must be a whole number of at most 64 bits, not {kind}")
    return kind


def held_out(doc_id: Column | str) -> Column:
    """True for rows that no learner may see: crc32 of the id as text is divisible by 5."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges with at most limit bytes in the column, one row at least."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    total, start = np.cumsum(size + 1), 0
    while start < batch.num_rows:
        before = int(total[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; a null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts; a null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def per_slice(process: Callable, column: str = "text", limit: int = SLICE_BYTES) -> Callable:
    """A function for mapInArrow that turns each slice of a batch into one output batch."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, column, limit):
                yield process(part)

    return run


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, over all its tasks."""
    name = "_catalogmart_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("held", {})


def cached(key: tuple, build: Callable):
    """build() of the first call with this key in the worker; a worker holds few keys."""
    held = worker_cache()
    if key not in held:
        if len(held) >= 8:
            held.clear()
        held[key] = build()
    return held[key]


_P1, _P2, _P3 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_P4, _P5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)


def _rotate(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxhash_long(values: np.ndarray, seed: int | np.uint64 = 42) -> np.ndarray:
    """XXH64 of 64-bit integers, as the SQL function xxhash64 computes it; unsigned."""
    with np.errstate(over="ignore"):
        h = np.uint64(int(seed) & 0xFFFFFFFFFFFFFFFF) + _P5 + np.uint64(8)
        h = h ^ (_rotate(np.asarray(values).astype(np.uint64) * _P2, 31) * _P1)
        h = _rotate(h, 27) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


class SortedHashes:
    """Finds 64-bit hashes in a sorted array; the leading bits index the place to look."""

    def __init__(self, ordered: np.ndarray):
        self.ordered = ordered.astype(np.uint64)
        bits = max(1, min(24, len(ordered).bit_length()))
        self.shift = np.uint64(64 - bits)
        held = np.bincount((self.ordered >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.append(0, np.cumsum(held)).astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is missing."""
        if not len(self.ordered):
            return np.full(len(hashes), -1, np.int32)
        bucket = (hashes >> self.shift).astype(np.int32)
        place, end = self.first[bucket], self.first[bucket + 1]
        last = len(self.ordered) - 1
        right = (self.ordered[np.minimum(place, last)] == hashes) & (place < end)
        found = np.where(right, place, -1).astype(np.int32)
        rest = np.flatnonzero(~right & (place + 1 < end))
        while len(rest):
            place[rest] += 1
            right = self.ordered[place[rest]] == hashes[rest]
            found[rest[right]] = place[rest[right]]
            rest = rest[~right & (place[rest] + 1 < end[rest])]
        return found


def joined(parts: list[bytes], pad: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one byte array, each after pad zero bytes; first byte and length of each text."""
    gap = bytes(pad)
    data = np.frombuffer(b"".join(x for part in parts for x in (gap, part)), np.uint8)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    start = np.cumsum(size + pad) - size
    return data, start, size


def sums(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of values over each range; 0 for an empty one. Ranges ascend and do not overlap."""
    kind = np.float64 if values.dtype.kind == "f" else np.int64
    out = np.zeros((len(start), *values.shape[1:]), kind)
    full = np.flatnonzero(size > 0)
    if len(full):
        edge = np.column_stack([start[full], start[full] + size[full]]).ravel()
        if edge[-1] == len(values):
            edge = edge[:-1]
        out[full] = np.add.reduceat(values, edge, axis=0, dtype=kind)[::2]
    return out


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start[i] to start[i]+size[i]-1 for every i, concatenated."""
    total = int(size.sum())
    shift = np.repeat(start - (np.cumsum(size) - size), size)
    return np.arange(total, dtype=np.int64) + shift
