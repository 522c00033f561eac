"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered by id; a keyed permutation of 0..n-1 shuffles the numbers.
Shard and slot follow from the permuted number alone, so any row can be found
without a lookup table, and shard sizes differ by one row at most (law `rows`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import Scratch, xxhash_long

SHARDS, SEED, ROUNDS = 8, 20_260, 6
#: Rows per range when numbering.
RANGE_ROWS = 1_000_000


class Feistel:
    """A permutation of 0..n-1. The network works on the least number of bits that hold n - 1, at least two; results
    outside walk on along their cycle, which leads back inside."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        self.n, self.seed, self.rounds = n, seed, rounds
        bits = max(2, (max(n, 1) - 1).bit_length())
        self.low = bits // 2
        self.high = bits - self.low

    def _round(self, k: int, half: np.ndarray) -> np.ndarray:
        return xxhash_long(half, self.seed * 1_000_003 + k)

    def _once(self, x: np.ndarray, back: bool = False) -> np.ndarray:
        """An even round changes the high part by the low one, an odd round the low part by the high one."""
        low_mask, high_mask = np.uint64((1 << self.low) - 1), np.uint64((1 << self.high) - 1)
        high, low = x >> np.uint64(self.low), x & low_mask
        for k in reversed(range(self.rounds)) if back else range(self.rounds):
            if k % 2:
                low = low ^ (self._round(k, high) & low_mask)
            else:
                high = high ^ (self._round(k, low) & high_mask)
        return (high << np.uint64(self.low)) | low

    def _walk(self, values: np.ndarray, back: bool) -> np.ndarray:
        out = self._once(np.asarray(values).astype(np.uint64), back)
        outside = np.flatnonzero(out >= np.uint64(self.n))
        while len(outside):
            out[outside] = self._once(out[outside], back)
            outside = outside[out[outside] >= np.uint64(self.n)]
        return out.astype(np.int64)

    def permute(self, values: np.ndarray) -> np.ndarray:
        return self._walk(values, False)

    def restore(self, values: np.ndarray) -> np.ndarray:
        """The row numbers that permute() sends to values."""
        return self._walk(values, True)


def number_rows(df: DataFrame, order: list[str], scratch: Scratch, column: str = "row_number") -> tuple[DataFrame, int]:
    """df with gapless numbers from 0 in the stated order, and the number of rows; equal rows take any order.

    Ranges are sorted on their own and written; a row's number is the rows of
    the files before its own plus its place in the file. Equal rows may spread
    over several ranges, so a repeated id does not gather in one task.
    """
    parts = max(1, -(-df.count() // RANGE_ROWS), min(64, df.sparkSession.sparkContext.defaultParallelism * 4))
    spread = df.withColumn("__tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_last() for c in order] + [F.col("__tie")]
    ranged = spread.repartitionByRange(parts, *keys).withColumn("__range", F.spark_partition_id())
    written = scratch.keep(ranged.sortWithinPartitions(*keys).drop("__tie"))
    sizes = sorted((r["__range"], r["n"]) for r in written.groupBy("__range").agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    offsets = F.create_map(*[F.lit(x) for pair in before for x in pair]) if before else F.create_map(F.lit(0), F.lit(0))
    place = written.select("*", F.col("_metadata.row_index").alias("__place"), F.col("_metadata.file_path").alias("__file"))
    files = written.groupBy("__range").agg(F.countDistinct("_metadata.file_path").alias("files")).where("files > 1").count()
    if files:
        raise RuntimeError("a range was written as several files; raise spark.sql.files.maxRecordsPerFile")
    numbered = place.withColumn(column, (offsets[F.col("__range")].cast("long") + F.col("__place")).cast("long"))
    return numbered.drop("__range", "__place", "__file"), total


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null) and row_number of every row.

    Row numbers follow doc_id, then the text's checksum and size; a null id comes
    last, a null text has size 1. Equal rows get different slots. Further columns
    are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(body).cast("long") + 1
    narrow = df.select(F.col(doc_id).alias("doc_id"), size.alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    scratch = Scratch(df.sparkSession, "sharding")
    numbered, total = number_rows(scratch.keep(narrow), ["doc_id", "text_crc32", "size"], scratch)

    def deal(batches):
        feistel = Feistel(total, seed)
        for batch in batches:
            to = feistel.permute(batch.column("row_number").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((to % shards).astype(np.int32)), pa.array(to // shards)], names)

    schema = f"doc_id {dict(narrow.dtypes)['doc_id']}, size long, text_crc32 long, row_number long, shard int, slot long"
    names = [x.split()[0] for x in schema.split(", ")]
    dealt = numbered.select(names[:4]).mapInArrow(deal, schema)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )
