"""Exact deduplication against a minimal perfect hash over historical digests.

The distinct digests of the history are dealt into ranges; each range gets a
minimal perfect hash whose slots hold the full digest, the winner's locator (its
doc_id) and the number of its rows. Arriving digests look themselves up and are
compared byte by byte: members add to the slot, nonmembers group on their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import Scratch, require_whole_ids, unused, xxhash_long

#: Digests per range of the index, about.
RANGE_DIGESTS = 50_000
#: Bits per key in each level of the perfect hash.
ROOM = 2.0


class PerfectHash:
    """Sends n distinct digests to 0..n-1.

    Level by level, keys that have a bit to themselves keep it; the rest go to
    the next level. The slot is the number of set bits before the key's.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = [np.cumsum(x) - x for x in levels]
        self.base = np.cumsum([0, *[int(x.sum()) for x in levels]])

    @staticmethod
    def words(digests: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4).astype(np.uint64)

    @staticmethod
    def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = xxhash_long(words[:, level % 4] ^ np.uint64(level), 7_919 + level)
        return (mixed % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, digests: list[bytes]) -> PerfectHash:
        words, levels = cls.words(digests), []
        while len(words):
            size = max(8, int(ROOM * len(words)))
            place = cls._place(words, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            words = words[~alone[place]]
        return cls(levels)

    def slots(self, digests: list[bytes]) -> np.ndarray:
        """A slot for every digest; -1 for some that are no member, any slot for others."""
        words = self.words(digests)
        out, rest = np.full(len(words), -1, np.int64), np.arange(len(words))
        for k, bits in enumerate(self.levels):
            if not len(rest):
                break
            place = self._place(words[rest], k, len(bits))
            set_ = bits[place]
            out[rest[set_]] = self.base[k] + self.before[k][place[set_]]
            rest = rest[~set_]
        return out

    def pack(self) -> list[bytes]:
        return [len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in self.levels]

    @classmethod
    def unpack(cls, parts) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(x, np.uint8, offset=8), count=int.from_bytes(x[:8], "little")).astype(bool) for x in parts])


def grouped(rows: DataFrame) -> DataFrame:
    """digest, winner (the largest doc_id) and n of rows (doc_id, digest)."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count("*").alias("n"))


def _range_of(ranges: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(ranges)).cast("int")


def build_index(history: DataFrame, ranges: int) -> DataFrame:
    """One row per range: the packed hash, and by slot the digests, winners and counts."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        digests = list(pdf["digest"])
        function = PerfectHash.build(digests)
        order = np.argsort(function.slots(digests))
        row = {
            "range": key[0],
            "levels": function.pack(),
            "digests": b"".join(digests[i] for i in order),
            "winners": list(pdf["winner"].to_numpy()[order]),
            "counts": list(pdf["n"].to_numpy()[order]),
        }
        return pd.DataFrame([row])

    schema = "range int, levels array<binary>, digests binary, winners array<long>, counts array<long>"
    return history.withColumn("range", _range_of(ranges)).groupBy("range").applyInPandas(one, schema)


def look_up(arrivals: DataFrame, index: DataFrame, ranges: int) -> DataFrame:
    """digest, winner, n and member: one row per digest that the index or the arrivals hold."""

    def one(key: tuple, new: pd.DataFrame, slots: pd.DataFrame) -> pd.DataFrame:
        digests, winner, n = list(new["digest"]), new["winner"].to_numpy(np.int64), new["n"].to_numpy(np.int64)
        out = []
        outside = np.ones(len(digests), bool)
        if len(slots):
            row = slots.iloc[0]
            own = [row["digests"][i : i + 32] for i in range(0, len(row["digests"]), 32)]
            best, total = np.array(row["winners"], np.int64), np.array(row["counts"], np.int64)
            if digests:
                slot = PerfectHash.unpack(row["levels"]).slots(digests)
                outside = np.array([s < 0 or own[s] != d for s, d in zip(slot, digests)], bool)
                np.maximum.at(best, slot[~outside], winner[~outside])
                np.add.at(total, slot[~outside], n[~outside])
            out.append(pd.DataFrame({"digest": own, "winner": best, "n": total, "member": True}))
        if outside.any():
            rest = [d for d, o in zip(digests, outside) if o]
            out.append(pd.DataFrame({"digest": rest, "winner": winner[outside], "n": n[outside], "member": False}))
        return pd.concat(out) if out else pd.DataFrame({"digest": [], "winner": [], "n": [], "member": []})

    keyed = arrivals.withColumn("range", _range_of(ranges))
    return keyed.groupBy("range").cogroup(index.groupBy("range")).applyInPandas(one, "digest binary, winner long, n long, member boolean")


def digest_of(text: Column) -> Column:
    """SHA-256 of the text in UTF-8; a null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def winners(rows: DataFrame, is_history: Column, scratch: Scratch, range_digests: int = RANGE_DIGESTS) -> DataFrame:
    """Winner, rows and membership of every digest of rows (doc_id, digest, ...).

    A null doc_id loses against any other; a group of null ids has a null winner.
    """
    least = -(1 << 63)
    rows = rows.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(least)))
    history, arrivals = grouped(rows.where(is_history)), grouped(rows.where(~is_history))
    history = scratch.keep(history)
    ranges = max(1, -(-history.count() // range_digests), min(24, rows.sparkSession.sparkContext.defaultParallelism * 2))
    index = scratch.keep(build_index(history, ranges))
    found = scratch.keep(look_up(arrivals, index, ranges))
    return found.withColumn("winner", F.expr(f"nullif(winner, {least})"))


def in_history(doc_id: str = "doc_id") -> Column:
    """Rows that count as the history when a table has no earlier one: those whose id hashes to an even number."""
    return F.pmod(F.xxhash64(doc_id, F.lit("history")), F.lit(2)) == 0


def exact_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal when identical; a null counts as empty. The largest doc_id
    of a group stays; rows that repeat both id and text are kept together, as
    nothing tells them apart. doc_id must be a whole number of at most 64 bits.
    Further columns are ignored.
    """
    require_whole_ids(df, doc_id)
    scratch = Scratch(df.sparkSession, "exact")
    rows = scratch.keep(df.select(F.col(doc_id).alias("doc_id"), digest_of(F.col(text)).alias("digest")))
    found = winners(rows, in_history(), scratch).select("digest", F.col("winner").alias("keep_id"), F.col("n").alias("group_size"))
    return rows.join(found, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df that win their group, all columns kept; of rows that repeat id and text, one stays.

    doc_id must be a whole number, as in exact_dedup.
    """
    require_whole_ids(df, doc_id)
    scratch = Scratch(df.sparkSession, "exact")
    rows = scratch.keep(df.select(F.col(doc_id).alias("doc_id"), digest_of(F.col(text)).alias("digest")))
    own, winner, digest = unused(df.columns, "own_digest", "winner", "digest")
    found = winners(rows, in_history(), scratch).select(F.col("winner").alias(winner), F.col("digest").alias(digest))
    marked = df.withColumn(own, digest_of(F.col(text)))
    won = marked.join(found, (F.col(own) == F.col(digest)) & F.col(f"`{doc_id}`").eqNullSafe(F.col(winner)), "left_semi")
    repeated = rows.groupBy("doc_id", "digest").count().where("count > 1").limit(1).count()
    if repeated:
        won = won.dropDuplicates([doc_id, own])
    return won.drop(own)
