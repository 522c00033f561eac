"""Token ids as binary files: canonical length-limited Huffman coding in independent blocks.

Ids are encoded with a public tokenizer, counted over all documents, and given
a canonical Huffman code whose lengths are limited so that one table decodes
any id in one look. A file is a Parquet table of blocks in ascending doc_id
order; a block holds whole documents, each starting at a byte, and the bit
offset of every CHECK-th id of a document, so blocks and stretches between
checkpoints decode on their own. The code lengths lie beside the blocks.
"""

from __future__ import annotations

import bisect
import itertools
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogmart.llm.common import SLICE_BYTES, Scratch, SortedHashes, cached, joined, ragged, raw_texts, require_whole_ids, slices, sums, xxhash_long

MAX_BITS = 16
#: Ids between checkpoints, ids per block (whole documents) and per file, about.
CHECK, BLOCK_IDS, FILE_IDS = 256, 1 << 16, 8 << 20
#: Pieces of text whose ids a worker remembers, their greatest length in bytes, and how many are encoded as one text.
REMEMBERED, LONGEST, JOINED = 1_500_000, 64, 200
END_ID = 0

# Characters that are white space for some tokenizer: ASCII ones, and the UTF-8 bytes that begin or spell the others.
_BLANKS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
_LETTERS = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
_STOPS = np.isin(np.arange(256), list(b",.;:!?"))
_WIDE_BLANKS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")


class Encoder:
    """Ids of texts by the tokenizers library.

    For a byte-level tokenizer a new word always starts at a single blank between
    two other characters, at a stop after an ASCII letter, and at both ends of
    a single line break. Texts are cut there, each distinct piece is
    encoded once and remembered under a hash. Texts with blanks in a row stay
    whole. Pieces are compared byte by byte with the remembered ones; should a
    hash ever confuse two, the texts are encoded as they are. So is a text that
    spells an added token, which the library cuts out before anything else.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        spelled = [_spelled(self.tokenizer.id_to_token(k) or "") for k in range(size)]
        self.length = np.fromiter(map(len, spelled), np.int64, size)
        self.forget()

    def forget(self) -> None:
        self.hashes, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.table, self.flat = SortedHashes(self.hashes), np.zeros(0, self.kind)
        self.blocks, self.first, self.width = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _library(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the values one after the other, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(values, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), self.kind, int(size.sum())), size

    def _joined(self, body: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces in a row that each start a new word: encoded as one text, cut by spelled length."""
        if any(t in body for t in self.added):
            ends = np.cumsum(size).tolist()
            return self._library([body[b - n : b].decode() for b, n in zip(ends, size.tolist())])
        ids, _ = self._library([body.decode()])
        at = np.searchsorted(np.cumsum(self.length[ids]), np.cumsum(size), "left") + 1
        return ids, np.diff(np.append(0, at))

    def _words(self, body: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of ASCII letters after at most one blank."""
        text, tokenize, ids = body.decode("ascii").replace(" ", _CHARACTER[32]), self.tokenizer.model.tokenize, []
        ends = [0, *np.cumsum(size).tolist()]
        counts = np.empty(len(size), np.int64)
        for k, (a, b) in enumerate(zip(ends, ends[1:])):
            own = [token.id for token in tokenize(text[a:b])]
            ids.extend(own)
            counts[k] = len(own)
        return np.array(ids, self.kind), counts

    def _learn(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray, apart: np.ndarray) -> None:
        """Remember the ids and the bytes of new pieces of data, given by ascending hashes.

        A word of ASCII letters goes straight to the model, as the pattern keeps
        it whole; other pieces of a blank and what follows it are encoded many at
        a time; those set apart, and odd ones, each by itself.
        """
        end = start + size - 1
        lead = (data[start] == 32) & (size > 1)
        strange = np.add.reduceat((~_LETTERS[data[ragged(start, size)]]).astype(np.int64), np.cumsum(size) - size) - lead
        plain = strange == 0
        alike = ~plain & ~apart & lead & ~_BLANKS[data[np.minimum(start + 1, end)]] & ~_BLANKS[data[end]]
        odd = ~plain & ~alike
        order, parts = np.concatenate([np.flatnonzero(x) for x in (plain, alike, odd)]), []
        if plain.any():
            parts.append(self._words(data[ragged(start[plain], size[plain])].tobytes(), size[plain]))
        many = np.flatnonzero(alike)
        for k in range(0, len(many), JOINED):
            some = many[k : k + JOINED]
            parts.append(self._joined(data[ragged(start[some], size[some])].tobytes(), size[some]))
        if odd.any():
            parts.append(self._library([data[a : a + n].tobytes().decode() for a, n in zip(start[odd], size[odd])]))
        ids, count = (np.concatenate(x) for x in zip(*parts))
        begin = np.empty(len(order), np.int64)
        begin[order] = len(self.flat) + np.cumsum(count) - count
        counts = np.empty(len(order), np.int64)
        counts[order] = count
        self.flat = np.append(self.flat, ids)
        at = np.searchsorted(self.hashes, hashes)
        self.start, self.size = np.insert(self.start, at, begin), np.insert(self.size, at, counts)
        own = -(-size // 8)
        first = np.cumsum(own) - own
        blocks = np.zeros(int(own.sum()), np.uint64)
        for k, lanes, value in _eights(data, start, size):
            blocks[first[lanes] + k] = value
        self.first = np.insert(self.first, at, first + len(self.blocks))
        self.width, self.blocks = np.insert(self.width, at, size), np.append(self.blocks, blocks)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.table = SortedHashes(self.hashes)

    def encode(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text followed by the end id, and the number of ids of each text."""
        spelled = np.array([any(t in x for t in self.added) for x in raw], bool)
        if not spelled.any():
            return self._encode(raw)
        ids, size = self._encode([x for x, own in zip(raw, spelled) if not own])
        own, n = self._library([x.decode() for x, own in zip(raw, spelled) if own])
        own = np.insert(own.astype(np.uint32), np.cumsum(n), END_ID)
        counts, begin = np.empty(len(raw), np.int64), np.empty(len(raw), np.int64)
        counts[~spelled], counts[spelled] = size, n + 1
        begin[~spelled], begin[spelled] = np.cumsum(size) - size, len(ids) + np.cumsum(n + 1) - (n + 1)
        return np.append(ids, own)[ragged(begin, counts)], counts

    def _encode(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """encode() for texts that spell no added token."""
        data, first, length = joined(raw)
        if not len(data):
            return np.full(len(raw), END_ID, np.uint32), np.ones(len(raw), np.int64)
        space = data == 32
        blank = _BLANKS[data]
        odd = np.zeros(len(data), bool)
        odd[1:] |= space[1:] & blank[:-1]
        odd[:-1] |= space[:-1] & blank[1:]
        whole = sums(odd.view(np.int8), first, length) > 0 if odd.any() else np.zeros(len(raw), bool)
        whole |= np.array([not x.isascii() and any(c in x for c in _WIDE_BLANKS) for x in raw])
        cut = space.copy()
        cut[1:] |= _STOPS[data[1:]] & _LETTERS[data[:-1]]
        line = data == 10
        line[1:] &= ~blank[:-1]
        cut |= line
        cut[1:] |= line[:-1] & ~blank[1:]
        if whole.any():
            cut &= ~np.repeat(whole, length)
        cut[first[length > 0]] = True
        start = np.flatnonzero(cut)
        size = np.diff(np.append(start, len(data)))
        short = size <= LONGEST
        hashes = _hash(data, start, np.where(short, size, 0))
        found = self.table.find(hashes)
        new = np.flatnonzero((found < 0) & short)
        if len(new):
            fresh, at = np.unique(hashes[new], return_index=True)
            at = new[at]
            if len(self.hashes) + len(fresh) > REMEMBERED:
                self.forget()
                fresh, at = np.unique(hashes[short], return_index=True)
                at = np.flatnonzero(short)[at]
            apart = np.repeat(whole, length)[start[at]]
            self._learn(fresh, data, start[at], size[at], apart)
            found = self.table.find(hashes)
        long = np.flatnonzero(~short)
        flat, begin, count = self.flat, np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        begin[short], count[short] = self.start[found[short]], self.size[found[short]]
        if len(long):
            ids, n = self._library([data[a : a + k].tobytes().decode() for a, k in zip(start[long], size[long])])
            begin[long], count[long] = len(flat) + np.cumsum(n) - n, n
            flat = np.append(flat, ids)
        if self._confused(data, start, size, short, found):
            ids, total = self._library([x.decode() for x in raw])
        else:
            ids, total = flat[ragged(begin, count)], sums(count, *_within(start, first, length))
        at_end = np.cumsum(total + 1) - 1
        out = np.full(len(ids) + len(raw), END_ID, np.uint32)
        body = np.ones(len(out), bool)
        body[at_end] = False
        out[body] = ids
        return out, total + 1


    def _confused(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, short: np.ndarray, found: np.ndarray) -> bool:
        """Whether a piece differs from the remembered one of its hash."""
        known = found[short]
        if (self.width[known] != size[short]).any():
            return True
        first = self.first[known]
        return any((self.blocks[first[lanes] + k] != value).any() for k, lanes, value in _eights(data, start[short], size[short]))


def _eights(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Eight bytes of the pieces at a time as integers, zero beyond the end: the turn, the pieces that have it, the values."""
    wide = np.ndarray((len(data) + 1,), "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    keep = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    lanes = np.flatnonzero(size > 0)
    for k in range(int(-(-size.max(initial=0) // 8))):
        lanes = lanes[size[lanes] > 8 * k] if k else lanes
        yield k, lanes, wide[start[lanes] + 8 * k] & keep[np.minimum(size[lanes] - 8 * k, 8)]


def _hash(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = size.astype(np.uint64) * np.uint64(0x9E3779B185EBCA87)
    for _, lanes, value in _eights(data, start, size):
        mixed = (out[lanes] ^ value) * np.uint64(0xC2B2AE3D27D4EB4F)
        out[lanes] = mixed ^ (mixed >> np.uint64(32))
    return out * np.uint64(0x9E3779B185EBCA87)


def _within(start: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the first of the pieces that start in it, and their number."""
    low = np.searchsorted(start, first)
    return low, np.searchsorted(start, first + length) - low


def _spelled(token: str) -> bytes:
    """Bytes that a token of a byte-level vocabulary stands for; its own text for any other."""
    return bytes(_BYTE_OF[c] for c in token) if all(c in _BYTE_OF for c in token) else token.encode()


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as the characters from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


_BYTE_OF = _byte_alphabet()
_CHARACTER = {b: c for c, b in _BYTE_OF.items()}


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with at most limit bits, by package-merge; 0 for ids that never occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need more than {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    level, leaves = leaf, [np.ones(len(leaf), bool)]
    for _ in range(limit - 1):
        even = len(level) // 2 * 2
        merged = np.concatenate([leaf, level[0:even:2] + level[1:even:2]])
        by = np.argsort(merged, kind="stable")
        level = merged[by]
        leaves.append(by < len(leaf))
    need = 2 * len(leaf) - 2
    for is_leaf in reversed(leaves):
        taken = int(is_leaf[:need].sum())
        lengths[order[:taken]] += 1
        need = 2 * (need - taken)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    code = last = 0
    for k in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[k])
        if n:
            code <<= n - last
            codes[k], code, last = code, code + 1, n
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and length for every value of the next MAX_BITS bits."""
    codes = canonical_codes(lengths)
    ids, bits = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.int64)
    used = np.flatnonzero(lengths)
    width = 1 << (MAX_BITS - lengths[used].astype(np.int64))
    place = ragged(codes[used].astype(np.int64) * width, width)
    ids[place], bits[place] = np.repeat(used, width), np.repeat(lengths[used], width)
    return ids, bits


def pack(ids: np.ndarray, size: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Bits of all documents, each from a byte on; bytes per document; checkpoints, and how many a document has.

    A checkpoint is the bit offset of a document's CHECK-th, 2*CHECK-th, ... id from the document's first bit.
    """
    width = lengths[ids].astype(np.int64)
    first = np.cumsum(size) - size
    total = np.append(0, np.cumsum(width))
    bits = total[first + size] - total[first]
    n_bytes = -(-bits // 8)
    shift = 8 * (np.cumsum(n_bytes) - n_bytes) - total[first]
    place = total[:-1] + np.repeat(shift, size)
    words = int(n_bytes.sum()) // 4 + 2
    wide = codes[ids] << (np.uint64(64) - (place & 31).astype(np.uint64) - width.astype(np.uint64))
    at = place >> 5
    high = np.bincount(at, weights=(wide >> np.uint64(32)).astype(np.float64), minlength=words)
    low = np.bincount(at + 1, weights=(wide & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=words)
    data = (high + low[: len(high)] if len(low) == len(high) else high + low[:words]).astype(">u4").tobytes()
    marks = np.maximum(size - 1, 0) // CHECK
    marked = ragged(np.zeros(len(size), np.int64), marks)
    at_mark = np.repeat(first, marks) + (marked + 1) * CHECK
    offsets = total[at_mark] - np.repeat(total[first], marks)
    return data[: int(n_bytes.sum())], n_bytes, offsets.astype(np.uint32), marks


def unpack(data: bytes, n_bytes: np.ndarray, size: np.ndarray, offsets: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """All ids of the documents; every stretch between checkpoints advances by one id per step."""
    symbol, bits = table
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    look = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    marks = np.maximum(size - 1, 0) // CHECK
    lanes = marks + (size > 0)
    first_bit = 8 * (np.cumsum(n_bytes) - n_bytes)
    number = ragged(np.zeros(len(size), np.int64), lanes)
    of = np.repeat(np.arange(len(size)), lanes)
    position = first_bit[of]
    position[number > 0] += offsets.astype(np.int64)
    left = np.minimum(CHECK, size[of] - number * CHECK)
    to = (np.cumsum(size) - size)[of] + number * CHECK
    order = np.argsort(-left, kind="stable")
    position, to, left = position[order], to[order], left[order]
    out = np.zeros(int(size.sum()), np.uint32)
    for step in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -step, "left"))
        position, to = position[:live], to[:live]
        value = (look[position >> 3] >> (8 - (position & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
        out[to + step] = symbol[value]
        position = position + bits[value]
    return out


_BLOCK = (
    "part int, first_id long, n_docs int, n_ids long, doc_ids binary, doc_sizes binary, doc_bytes binary, checkpoints binary, payload binary"
)


def _binary(values: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """values cut at ends, as bytes."""
    raw, width = np.ascontiguousarray(values).tobytes(), values.itemsize
    edges = np.append(0, ends) * width
    return [raw[a:b] for a, b in zip(edges[:-1], edges[1:])]


def encode_documents(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id (a whole number), tie (a checksum) and ids (little-endian 16-bit, 32-bit for larger vocabularies) with the end id; a null counts as empty."""

    def run(batches):
        encoder = cached(("encoder", path), lambda: Encoder(path))
        for batch in batches:
            for part in slices(batch, "text", 2 * SLICE_BYTES):
                ids, size = encoder.encode(raw_texts(part))
                cells = _binary(ids.astype(np.dtype(encoder.kind).newbyteorder("<")), np.cumsum(size))
                tie = pa.array([zlib.crc32(x) for x in cells], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), tie, pa.array(cells, pa.binary())], ["doc_id", "tie", "ids"])

    require_whole_ids(df, doc_id)
    narrow = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, tie long, ids binary")


def _key(doc_id: int | None, tie: int) -> tuple:
    return (doc_id is None, doc_id or 0, tie)


def range_bounds(keys: DataFrame, ranges: int, sampled: int = 50_000) -> list[tuple]:
    """Lower bounds of all ranges but the first, from about so many sampled keys (doc_id, tie).

    Bounds only balance the files; any bounds give the same order of documents.
    """
    n = keys.count()
    some = keys.sample(fraction=min(1.0, sampled / max(n, 1)), seed=1) if n > sampled else keys
    found = sorted(_key(*row) for row in some.collect())
    return sorted({found[k * len(found) // ranges] for k in range(1, ranges)}) if found else []


def write_token_files(df: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every document of df and write blocks and code lengths below folder.

    path is the tokenizer file. Documents come in ascending doc_id order, a null
    id last and equal ids by the digest of their ids; a null text counts as
    empty and holds the end id alone. Further columns are ignored.
    """
    from tokenizers import Tokenizer

    spark, vocabulary = df.sparkSession, Tokenizer.from_file(path).get_vocab_size()
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    encoded = f"{folder}/encoded"
    encode_documents(df, path, doc_id, text).write.option("compression", "zstd").parquet(encoded)
    rows = spark.read.schema("doc_id long, tie long, ids binary").parquet(encoded)

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for part in slices(batch, "ids"):
                ids = np.frombuffer(b"".join(part.column("ids").to_pylist()), kind)
                total += np.bincount(ids, minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["id", "n"])

    counts = np.zeros(vocabulary, np.int64)
    for row in rows.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    code_table = [(int(k), int(lengths[k])) for k in np.flatnonzero(lengths)]
    spark.createDataFrame(code_table, "id int, bits int").coalesce(1).write.parquet(f"{folder}/codes")
    files = max(1, -(-int(counts.sum()) // FILE_IDS))
    bounds = range_bounds(rows.select("doc_id", "tie"), files)

    def code(batches):
        codes = canonical_codes(lengths)
        for batch in batches:
            for part in slices(batch, "ids", SLICE_BYTES // 2):
                raw = part.column("ids").to_pylist()
                ids = np.frombuffer(b"".join(raw), kind).astype(np.int64)
                size = np.fromiter(map(len, raw), np.int64, len(raw)) // np.dtype(kind).itemsize
                data, n_bytes, offsets, marks = pack(ids, size, lengths, codes)
                keys = zip(part.column("doc_id").to_pylist(), part.column("tie").to_pylist())
                place = [bisect.bisect_right(bounds, _key(*k)) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place, pa.int32()),
                        part.column("doc_id"),
                        part.column("tie"),
                        pa.array(size),
                        pa.array(_binary(offsets, np.cumsum(marks)), pa.binary()),
                        pa.array(_binary(np.frombuffer(data, np.uint8), np.cumsum(n_bytes)), pa.binary()),
                    ],
                    ["part", "doc_id", "tie", "size", "offsets", "bits"],
                )

    coded = rows.mapInArrow(code, "part int, doc_id long, tie long, size long, offsets binary, bits binary")
    keys = [F.col("part"), F.col("doc_id").asc_nulls_last(), F.col("tie"), F.xxhash64("bits")]
    ordered = coded.repartition(files, "part").sortWithinPartitions(*keys).drop("tie")

    def block(batches):
        part, first, held, ids = None, 0, [], 0

        def out():
            nonlocal first, held, ids
            size = np.array([x[2] for x in held], "<i8")
            known = pa.array([x[1] for x in held], pa.int64()).fill_null(0).to_numpy().astype("<i8")
            row = {
                "part": part,
                "first_id": first,
                "n_docs": len(held),
                "n_ids": ids,
                "doc_ids": known.tobytes() + np.packbits([x[1] is None for x in held]).tobytes(),
                "doc_sizes": size.tobytes(),
                "doc_bytes": np.array([len(x[4]) for x in held], "<u4").tobytes(),
                "checkpoints": b"".join(x[3] for x in held),
                "payload": b"".join(x[4] for x in held),
            }
            first, held, ids = first + ids, [], 0
            return pa.RecordBatch.from_pylist([row], schema=block_schema)

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("part", "doc_id", "size", "offsets", "bits")]):
                if row[0] != part:
                    if held:
                        yield out()
                    part, first = row[0], 0
                held.append(row)
                ids += row[2]
                if ids >= BLOCK_IDS:
                    yield out()
        if held:
            yield out()

    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    block_schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in _BLOCK.split(", ")])
    ordered.mapInArrow(block, _BLOCK).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (little-endian 32-bit) of every document in the files."""
    codes = spark.read.schema("id int, bits int").parquet(f"{folder}/codes").collect()
    lengths = np.zeros(1 + max((row["id"] for row in codes), default=0), np.uint8)
    for row in codes:
        lengths[row["id"]] = row["bits"]
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    parts = sorted((row["part"], row["n"]) for row in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    begin, total = {}, 0
    for part, n in parts:
        begin[part], total = total, total + n
    name = uuid.uuid4().hex

    def run(batches):
        table = cached(("codes", name), lambda: decode_table(lengths))
        for batch in batches:
            for some in slices(batch, "payload", SLICE_BYTES // 2):
                rows = some.to_pylist()
                n_docs = [r["n_docs"] for r in rows]
                ids = np.concatenate([np.frombuffer(r["doc_ids"][: 8 * r["n_docs"]], "<i8") for r in rows])
                missing = np.concatenate([np.unpackbits(np.frombuffer(r["doc_ids"], np.uint8, offset=8 * n), count=n) for r, n in zip(rows, n_docs)]).astype(bool)
                size = np.concatenate([np.frombuffer(r["doc_sizes"], "<i8") for r in rows])
                n_bytes = np.concatenate([np.frombuffer(r["doc_bytes"], "<u4") for r in rows]).astype(np.int64)
                offsets = np.concatenate([np.frombuffer(r["checkpoints"], "<u4") for r in rows])
                out = unpack(b"".join(r["payload"] for r in rows), n_bytes, size, offsets, table)
                base = np.repeat([begin[r["part"]] + r["first_id"] for r in rows], n_docs)
                before = np.cumsum(size) - size
                of_block = np.repeat(before[np.cumsum(n_docs) - n_docs], n_docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=missing), pa.array(base + before - of_block), pa.array(size), pa.array(_binary(out.astype("<u4"), np.cumsum(size)), pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def digest_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def token_round_trip(df: DataFrame, path: str) -> DataFrame:
    """Write the files of df and read them back as digests."""
    folder = Scratch(df.sparkSession, "tokens").folder
    write_token_files(df, folder, path)
    return digest_token_files(df.sparkSession, folder)
