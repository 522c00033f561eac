"""Sampled segmentation into SentencePiece pieces by forward filtering and backward sampling; lossless decoding.

The pieces of a public model span a lattice over the text. Forward filtering
sums the weights of all segmentations up to every position; backward sampling
draws one piece after the other from the end. Every draw is a hash of the row
key and the position, so a row gets the same segmentation in any partitioning.

No piece of the model crosses from a character into a blank, so the lattice
falls apart at the blanks and each distinct word is filtered once per slice.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import SortedHashes, cached, per_slice, ragged, raw_texts, xxhash_long

SEED = 7
#: A piece of merge rank r weighs (1 + r) ** -FLATNESS before normalising: the model has ranks, no probabilities.
FLATNESS = 1.0
#: Log weight of a byte that stands for a character without a piece.
BYTE_LOG_WEIGHT = -20.0

#: Words of more bytes are cut where no piece crosses; steps with fewer edges or draws than FEW go one by one.
LONG, FEW = 64, 48
_WORDS = re.compile(rb" +[^ ]*|[^ ]+")


class Pieces:
    """Pieces of a SentencePiece model as bytes (the blank for its mark), their log weights, and a trie over them."""

    def __init__(self, path: str, flatness: float = FLATNESS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes: list[bytes] = [b""] * n
        self.byte_id = np.full(256, -1, np.int64)
        self.log_weight = np.full(n, BYTE_LOG_WEIGHT)
        rank = np.minimum(-np.array([model.get_score(k) for k in range(n)]), n)
        log_weight = -flatness * np.log1p(rank)
        children: dict[tuple[int, int], int] = {}
        piece = [-1]
        plain = []
        for k in range(n):
            if model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                continue
            if model.is_byte(k):
                self.byte_id[int(model.id_to_piece(k)[3:5], 16)] = k
                self.bytes[k] = bytes([int(model.id_to_piece(k)[3:5], 16)])
                continue
            own = model.id_to_piece(k).replace("▁", " ").encode()
            if b" " in own.lstrip(b" "):
                raise ValueError("a piece crosses into a blank")
            self.bytes[k] = own
            plain.append(k)
            node = 0
            for byte in own:
                if (node, byte) not in children:
                    children[node, byte] = len(piece)
                    piece.append(-1)
                node = children[node, byte]
            piece[node] = k
        self.log_weight[plain] = log_weight[plain] - np.logaddexp.reduce(log_weight[plain])
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces")
        self.size = np.fromiter(map(len, self.bytes), np.int64, n)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.piece = np.array(piece, np.int64)
        self.one = np.full(256, -1, np.int64)
        self.two = np.full(1 << 16, -1, np.int64)
        rest_key, rest_child = [], []
        for (node, byte), child in children.items():
            if node == 0:
                self.one[byte] = child
            rest_key.append(node << 8 | byte)
            rest_child.append(child)
        first_byte = {child: byte for (node, byte), child in children.items() if node == 0}
        for (node, byte), child in children.items():
            if node in first_byte:
                self.two[first_byte[node] << 8 | byte] = child
        hashes = xxhash_long(np.array(rest_key, np.uint64))
        order = np.argsort(hashes)
        self.table, self.child = SortedHashes(hashes[order]), np.array(rest_child, np.int64)[order]

    def below(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The trie node one byte on, -1 for none."""
        place = self.table.find(xxhash_long((node << 8 | byte.astype(np.int64)).astype(np.uint64)))
        return np.where(place >= 0, self.child[np.maximum(place, 0)], -1)

    def decode(self, ids: np.ndarray, size: np.ndarray) -> list[bytes]:
        """Texts of id sequences; size is the number of ids of each."""
        data = self.flat[ragged(self.start[ids], self.size[ids])].tobytes()
        length = np.append(0, np.cumsum(self.size[ids]))
        ends = length[np.append(0, np.cumsum(size))]
        return [data[a + 1 : b] for a, b in zip(ends[:-1], ends[1:])]


def words_of(raw: bytes) -> list[bytes]:
    """The text after a leading blank, cut before every blank that follows another character; none if empty."""
    if not raw:
        return []
    if raw[0] != 32 and b"  " not in raw:
        return [b" " + x for x in raw.split(b" ")]
    return _WORDS.findall(b" " + raw)


def cut_words(pieces: Pieces, words: list[bytes]) -> list[list[bytes]]:
    """Each word cut at the characters that no piece crosses.

    All ways through the lattice meet there, so the parts are filtered and
    sampled apart with the same result. Scripts without blanks fall into short
    parts this way.
    """
    at, length, _, begin, size = _edges(pieces, words)
    crossed = np.zeros(int(size.sum()) + 1, np.int64)
    np.add.at(crossed, at + 1, 1)
    np.add.at(crossed, at + length, -1)
    body = b"".join(words)
    data = np.frombuffer(body, np.uint8)
    free = (np.cumsum(crossed)[:-1] == 0) & ((data & 0xC0) != 0x80)
    free[begin] = True
    cuts = np.append(np.flatnonzero(free), len(data)).tolist()
    parts = [body[a:b] for a, b in zip(cuts, cuts[1:])]
    ends = np.searchsorted(cuts, np.append(begin, len(data))).tolist()
    return [parts[a:b] for a, b in zip(ends, ends[1:])]


class Lattice(NamedTuple):
    """Edges by end node; of the edges of a node, the running share of the filtered weight."""

    first: np.ndarray  # of each node its first edge
    upto: np.ndarray  # running share, 1 at a node's last edge
    origin: np.ndarray  # node where the edge starts
    piece: np.ndarray
    node_of: np.ndarray  # first node of each word
    size: np.ndarray  # bytes of each word


def _edges(pieces: Pieces, words: list[bytes]) -> tuple[np.ndarray, ...]:
    """Start byte, length and piece of every edge in the joined words; first byte and size of each word."""
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(size) - size
    limit = np.repeat(begin + size, size)
    head = (data & 0xC0) != 0x80
    lane = np.flatnonzero(head)
    node = pieces.one[data[lane]]
    at, length, piece = [], [], []
    depth = 1
    covered = np.zeros(len(data), bool)
    wide = np.select([data < 0xC0, data < 0xE0, data < 0xF0], [1, 2, 3], 4)
    wide = np.minimum(wide, limit - np.arange(len(data)))
    while True:
        alive = node >= 0
        lane, node = lane[alive], node[alive]
        if not len(lane):
            break
        own = pieces.piece[node]
        ends = own >= 0
        at.append(lane[ends])
        length.append(np.full(int(ends.sum()), depth))
        piece.append(own[ends])
        covered[lane[ends][wide[lane[ends]] == depth]] = True
        more = lane + depth < limit[lane]
        lane, node = lane[more], node[more]
        if not len(lane):
            break
        byte = data[lane + depth]
        node = pieces.two[data[lane].astype(np.int64) << 8 | byte] if depth == 1 else pieces.below(node, byte)
        depth += 1
    # a byte that is no part of a whole character stands alone
    bare = np.flatnonzero(head & ~covered)
    span = ragged(bare, wide[bare])
    whole = np.zeros(len(data), bool)
    heads = np.flatnonzero(head)
    whole[ragged(heads, wide[heads])] = True
    span = np.unique(np.concatenate([span, np.flatnonzero(~whole)]))
    at.append(span)
    length.append(np.ones(len(span), np.int64))
    piece.append(pieces.byte_id[data[span]])
    return np.concatenate(at), np.concatenate(length), np.concatenate(piece), begin, size


def forward_filter(pieces: Pieces, words: list[bytes]) -> Lattice:
    """Lattice of the words; a position's weight is the sum over all ways to it, taken level by level.

    Levels that only a few long words reach have few edges and go node by node.
    """
    at, length, piece, begin, size = _edges(pieces, words)
    word = np.repeat(np.arange(len(words)), size)[at]
    origin, end = at + word, at + word + length  # a word of n bytes has n + 1 nodes
    level = at + length - begin[word]
    order = np.argsort((level << 44) | (end << 8) | (255 - np.minimum(length, 255)), kind="stable")
    origin, end, piece, level = origin[order], end[order], piece[order], level[order]
    first = np.flatnonzero(np.append(True, end[1:] != end[:-1])) if len(end) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(end)))
    node = end[first]
    log_sum = np.full(int(size.sum()) + len(words), -np.inf)
    log_sum[begin + np.arange(len(words))] = 0.0
    weight = pieces.log_weight[piece]
    value = np.empty(len(end))
    node_level = level[first]
    steps = np.flatnonzero(np.append(True, node_level[1:] != node_level[:-1])) if len(first) else np.zeros(0, np.int64)
    edges_of = np.diff(np.append(first[steps], len(end)))
    many = np.flatnonzero(edges_of >= FEW)
    tail = int(many[-1]) + 1 if len(many) else 0
    for a, b in zip(steps[:tail], np.append(steps[1:], len(first))[:tail]):
        lo, hi = first[a], first[b] if b < len(first) else len(end)
        part = log_sum[origin[lo:hi]] + weight[lo:hi]
        edge = first[a:b] - lo
        top = np.maximum.reduceat(part, edge)
        top[~np.isfinite(top)] = 0.0
        share = np.exp(part - np.repeat(top, count[a:b]))
        total = np.add.reduceat(share, edge)
        with np.errstate(divide="ignore", invalid="ignore"):
            log_sum[node[a:b]] = top + np.log(total)
            value[lo:hi] = share / np.repeat(total, count[a:b])
    if tail < len(steps):
        a = steps[tail]
        value[first[a] :] = _node_by_node(log_sum, node[a:], count[a:], origin[first[a] :], weight[first[a] :])
    value = np.nan_to_num(value)
    running = np.cumsum(value)
    upto = running - np.repeat(running[first] - value[first], count) if len(first) else running
    upto[first + count - 1] = 1.0
    at_node = np.zeros(len(log_sum), np.int64)
    at_node[node] = first
    return Lattice(at_node, upto, origin, piece, begin + np.arange(len(words)), size)


def _node_by_node(log_sum: np.ndarray, node: np.ndarray, count: np.ndarray, origin: np.ndarray, weight: np.ndarray) -> list[float]:
    """Shares of the edges, which end in the nodes in their order; sets the nodes' weights."""
    known, k, out = memoryview(log_sum), 0, []
    origins, weights = origin.tolist(), weight.tolist()
    for at, n in zip(node.tolist(), count.tolist()):
        part = [known[o] + w for o, w in zip(origins[k : k + n], weights[k : k + n])]
        top = max(part)
        if top == -math.inf:
            known[at] = top
            out.extend([0.0] * n)
        else:
            share = [math.exp(x - top) for x in part]
            total = sum(share)
            known[at] = top + math.log(total)
            out.extend([x / total for x in share])
        k += n
    return out


def _draws(key: np.ndarray | np.uint64, place: np.ndarray) -> np.ndarray:
    """A number from 0 to 1 for each row key and byte position."""
    with np.errstate(over="ignore"):
        return (xxhash_long(key + place * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _walk(lattice: Lattice, node: int, home: int, offset: int, key: np.uint64) -> list[int]:
    """The pieces drawn from a node back to the word's first, last one first."""
    if node <= home:
        return []
    u = _draws(key, np.arange(offset, offset + node - home + 1, dtype=np.uint64)).tolist()
    first, upto, origin, piece = (memoryview(np.ascontiguousarray(x)) for x in (lattice.first, lattice.upto, lattice.origin, lattice.piece))
    out = []
    while node > home:
        edge, drawn = first[node], u[node - home]
        while upto[edge] <= drawn:
            edge += 1
        out.append(piece[edge])
        node = origin[edge]
    return out


def sample(pieces: Pieces, raw: list[bytes], keys: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """One sampled segmentation per text: all ids, and the number of ids of each text."""
    index: dict[bytes, int] = {}
    codes, counts = [], np.zeros(len(raw), np.int64)
    listed = list(map(words_of, raw))
    long = list({w for words in listed for w in words if len(w) > LONG})
    parts = dict(zip(long, cut_words(pieces, long))) if long else {}
    for k, words in enumerate(listed):
        if parts:
            words = [x for w in words for x in (parts[w] if len(w) > LONG else (w,))]
        codes.extend([index.setdefault(w, len(index)) for w in words])
        counts[k] = len(words)
    if not codes:
        return np.zeros(0, np.int64), counts
    lattice = forward_filter(pieces, list(index))
    word = np.array(codes, np.int64)
    size = lattice.size[word]
    before = np.cumsum(size) - size
    of = np.repeat(np.arange(len(raw)), counts)
    first = np.append(0, np.cumsum(counts))[of]
    offset = (before - before[first]).astype(np.uint64)
    own = xxhash_long(keys, 31 * seed + 1)[of]
    home = lattice.node_of[word]
    node, lane = home + size, np.arange(len(word))
    drawn: list[tuple[np.ndarray, np.ndarray]] = []
    while len(lane):
        u = _draws(own[lane], offset[lane] + (node - home[lane]).astype(np.uint64))
        edge = lattice.first[node]
        rest = np.flatnonzero(lattice.upto[edge] <= u)
        while len(rest):
            edge[rest] += 1
            rest = rest[lattice.upto[edge[rest]] <= u[rest]]
        drawn.append((lane, lattice.piece[edge]))
        node = lattice.origin[edge]
        on = node > home[lane]
        lane, node = lane[on], node[on]
        if len(lane) < FEW:
            break
    rest = {int(k): _walk(lattice, int(n), int(home[k]), int(offset[k]), own[k]) for k, n in zip(lane, node)}
    taken = np.zeros(len(word), np.int64)
    for lanes, _ in drawn:
        taken[lanes] += 1
    for k, walked in rest.items():
        taken[k] += len(walked)
    last = np.cumsum(taken) - 1
    ids = np.empty(int(taken.sum()), np.int64)
    for step, (lanes, piece) in enumerate(drawn):
        ids[last[lanes] - step] = piece
    for k, walked in rest.items():
        ids[last[k] - len(drawn) - len(walked) + 1 : last[k] - len(drawn) + 1] = walked[::-1]
    total = np.append(0, np.cumsum(taken))
    return ids, np.diff(total[np.append(0, np.cumsum(counts))])


def _run(df: DataFrame, path: str, key: str, text: str, seed: int, flatness: float, schema: str, finish) -> DataFrame:
    narrow = df.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(key)).alias("row_key"), F.col(text).alias("text"))
    schema = f"doc_id {dict(narrow.dtypes)['doc_id']}, {schema}"
    names = [x.split()[0] for x in schema.split(", ")]

    def process(part):
        pieces = cached(("pieces", path, flatness), lambda: Pieces(path, flatness))
        raw = raw_texts(part)
        ids, size = sample(pieces, raw, part.column("row_key").to_numpy().view(np.uint64), seed)
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *finish(pieces, raw, ids, size)], names)

    return narrow.mapInArrow(per_slice(process), schema)


def sample_pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", seed: int = SEED, flatness: float = FLATNESS) -> DataFrame:
    """doc_id and ids (the sampled segmentation) of every row; path is the model file.

    A null or empty text has no ids. Rows that share key and text share the
    segmentation. Further columns are ignored.
    """

    def finish(pieces, raw, ids, size):
        ends = np.append(0, np.cumsum(size)).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))]

    return _run(df, path, key, text, seed, flatness, "ids array<int>", finish)


def decode_pieces(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and text of id sequences."""
    narrow = df.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids"))

    def run(batches):
        pieces = cached(("pieces", path, FLATNESS), lambda: Pieces(path))
        for batch in batches:
            lists = [x or [] for x in batch.column("ids").to_pylist()]
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((i for x in lists for i in x), np.int64, int(size.sum()))
            decoded = [x.decode() for x in pieces.decode(flat, size)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.string())], ["doc_id", "text"])

    return narrow.mapInArrow(run, f"doc_id {dict(narrow.dtypes)['doc_id']}, text string")


def digest_pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", seed: int = SEED, flatness: float = FLATNESS) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (little-endian 32-bit ids), lossless (decoding gives the text back) and bytes per row."""
    import zlib

    def finish(pieces, raw, ids, size):
        flat = ids.astype("<u4").tobytes()
        ends = 4 * np.append(0, np.cumsum(size))
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        decoded = pieces.decode(ids, size)
        same = [a == b for a, b in zip(decoded, raw)]
        return [pa.array(size), pa.array(crc, pa.int64()), pa.array(same, pa.bool_()), pa.array([len(x) for x in raw], pa.int64())]

    return _run(df, path, key, text, seed, flatness, "n_pieces long, ids_crc32 long, lossless boolean, n_bytes long", finish)
