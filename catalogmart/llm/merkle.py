"""Merkle dataset manifest by bitmap-rank indexing.

Leaves need gapless coordinates: a leaf's place among the ids of its source.
Tasks turn the ids they see into compressed bitmaps, one per source and stretch
of ids; bitmaps of one stretch are merged by union, and a directory of their
popcounts, summed stretch by stretch, tells how many ids lie before each. The
rank of an id, its stretch's offset plus the popcount below its bit, is then
read off without sorting the leaves.

The tree is reduced by slot arrays: the leaves of an array, keyed by (source,
place // ARRAY), land in their slots and are hashed up several levels at once;
the arrays' roots are the leaves of the next round. On the way down an array
hands its path to the root to its slots, so that each leaf has its proof.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogmart.llm.common import Scratch, require_whole_ids
from catalogmart.llm.sharding import number_rows

#: Children of a node, and leaves of a slot array (a power of FAN).
FAN, ARRAY = 3, 3**6
#: Ids of one bitmap, as a power of two, and of one step of the directory above it.
STRETCH_BITS, STEP_BITS = 10, 16
#: Bitmaps a task holds before it passes them on.
HELD = 20_000

def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the fields, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


# Bitmaps. A bitmap is sent as a deflated bit array, or as 16-bit places where that is shorter; ids that occur more
# often than once are counted beside it.


def pack(places: np.ndarray) -> bytes:
    """Distinct places below 2^STRETCH_BITS as a compressed bitmap."""
    bits = np.zeros(1 << STRETCH_BITS, np.uint8)
    bits[places] = 1
    dense = b"B" + zlib.compress(np.packbits(bits).tobytes(), 1)
    sparse = b"P" + np.flatnonzero(bits).astype("<u2").tobytes()
    return min(dense, sparse, key=len)


def unpack(packed: bytes) -> np.ndarray:
    """The bitmap as one byte per place."""
    if packed[:1] == b"B":
        return np.unpackbits(np.frombuffer(zlib.decompress(packed[1:]), np.uint8))
    bits = np.zeros(1 << STRETCH_BITS, np.uint8)
    bits[np.frombuffer(packed, "<u2", offset=1)] = 1
    return bits


def ranks(bits: np.ndarray) -> np.ndarray:
    """Set bits before each place."""
    return np.cumsum(bits, dtype=np.int64) - bits


def partial_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """source_no and doc_id to source_no, stretch, bitmap and again (places that this task has seen more than once)."""
    names = ["source_no", "stretch", "bitmap", "again"]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int32())]
    held: dict[tuple[int, int], tuple[np.ndarray, set]] = {}

    def flush():
        rows = [(s, k, pack(np.flatnonzero(bits)), sorted(again)) for (s, k), (bits, again) in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds[c]) for c in range(4)], names)

    for batch in batches:
        source, ids = batch.column("source_no").to_numpy(), batch.column("doc_id").to_numpy()
        stretch, place = ids >> STRETCH_BITS, ids & ((1 << STRETCH_BITS) - 1)
        order = np.lexsort((place, stretch, source))
        source, stretch, place = source[order], stretch[order], place[order]
        edge = np.flatnonzero(np.append(True, (np.diff(source) != 0) | (np.diff(stretch) != 0))) if len(source) else []
        for a, b in zip(edge, [*edge[1:], len(source)]):
            key, here = (int(source[a]), int(stretch[a])), place[a:b]
            if key not in held:
                held[key] = (np.zeros(1 << STRETCH_BITS, np.uint8), set())
            bits, again = held[key]
            again.update(here[1:][here[1:] == here[:-1]].tolist())
            again.update(here[bits[here] > 0].tolist())
            bits[here] = 1
        if len(held) >= HELD:
            yield flush()
    yield flush()


def merged_bitmaps(group: pa.Table) -> pa.Table:
    """One bitmap of a source's stretch from its partial ones: the union, its popcount, and the ids met more than once."""
    count = np.zeros(1 << STRETCH_BITS, np.int64)
    for packed, again in zip(group.column("bitmap").to_pylist(), group.column("again").to_pylist()):
        count += unpack(packed)
        count[again] += 1
    places, base = np.flatnonzero(count), group.column("stretch")[0].as_py() << STRETCH_BITS
    columns = [
        group.column("source_no").slice(0, 1).combine_chunks(),
        group.column("stretch").slice(0, 1).combine_chunks(),
        pa.array([pack(places)], pa.binary()),
        pa.array([len(places)], pa.int64()),
        pa.array([(np.flatnonzero(count > 1) + base).tolist()], pa.list_(pa.int64())),
    ]
    return pa.Table.from_arrays(columns, ["source_no", "stretch", "bitmap", "n", "repeated"])


def stretch_offsets(counts: DataFrame) -> DataFrame:
    """source_no, stretch and before: the rows of the source in earlier stretches; counts has source_no, stretch and n.

    The directory has a level for every STEP_BITS bits of the stretch number, so
    that no running sum goes over more than 2^STEP_BITS rows.
    """
    level, levels, bits = counts.withColumn("at", F.col("stretch")), [], 64 - STRETCH_BITS
    while bits > 0:
        up = F.shiftright("at", min(STEP_BITS, bits))
        within = Window.partitionBy("source_no", up).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("n").over(within), F.lit(0)).cast("long")
        levels.append(level.select("source_no", "at", up.alias("up"), before.alias("before")))
        level = level.groupBy("source_no", up.alias("up")).agg(F.sum("n").alias("n")).withColumnRenamed("up", "at")
        bits -= STEP_BITS
    # The highest level holds a row per sign of the id: negative ones come first, since -1 < 0.
    sign = Window.partitionBy("source_no").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    total = level.select("source_no", "at", F.coalesce(F.sum("n").over(sign), F.lit(0)).cast("long").alias("before"))
    for lower in reversed(levels):
        above = total.select(F.col("source_no").alias("s"), F.col("at").alias("a"), F.col("before").alias("more"))
        total = lower.join(above, (F.col("source_no") == F.col("s")) & (F.col("up") == F.col("a")))
        total = total.select("source_no", "at", (F.col("before") + F.col("more")).alias("before"))
    return total.withColumnRenamed("at", "stretch")


def ranked(group: pa.Table, index: pa.Table) -> pa.Table:
    """The rows of a source's stretch with place and total, read off the bitmap of the stretch."""
    place = group.column("doc_id").to_numpy() & ((1 << STRETCH_BITS) - 1)
    total, found = 0, np.zeros(0, np.int64)
    if group.num_rows:
        (row,) = index.to_pylist()
        rank = ranks(unpack(row["bitmap"]))
        for more in row["more"] or []:
            rank[more["at"] + 1 :] += more["n"]
        found, total = row["before"] + rank[place], row["total"]
    columns = [*(group.column(c) for c in ("source_no", "doc_id", "leaf", "tampered")), pa.array(found), pa.array([total] * len(found), pa.int64())]
    return pa.Table.from_arrays(columns, ["source_no", "doc_id", "leaf", "tampered", "place", "total"])


def repeated_rows(leaves: DataFrame, repeated: DataFrame) -> DataFrame:
    """source_no, doc_id, leaf, tampered and n (equal rows) of the leaves whose id is null or repeated in its source."""
    again = repeated.select(F.col("source_no").alias("s"), F.col("doc_id").alias("d"))
    known = leaves.where("doc_id IS NOT NULL").join(again, (F.col("source_no") == F.col("s")) & (F.col("doc_id") == F.col("d")), "left_semi")
    rows = known.unionAll(leaves.where("doc_id IS NULL"))
    return rows.groupBy("source_no", "doc_id", "leaf", "tampered").agg(F.count("*").alias("n"))


def placed_repeats(tallied: DataFrame, firsts: DataFrame) -> DataFrame:
    """The repeated leaves with place and total: by digest, from the first place of their id on, equal rows side by side.

    firsts has source_no, doc_id, place and total of every null or repeated id.
    Running sums go by the digest's first two bytes; equal rows are told apart
    in two steps, so that neither a hot id nor a hot row is one task's work.
    """
    rows = tallied.withColumn("head", F.substring("leaf", 1, 2))
    one_id = ["source_no", "doc_id"]
    within = Window.partitionBy(*one_id, "head").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy(*one_id, "head").agg(F.sum("n").alias("n"))
    ahead = Window.partitionBy(*one_id).orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(*[F.col(c).alias(f"{c}_") for c in (*one_id, "head")], F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("earlier"))
    rows = rows.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
    same = lambda side: (F.col("source_no") == F.col(f"source_no{side}")) & F.col("doc_id").eqNullSafe(F.col(f"doc_id{side}"))
    rows = rows.join(heads, same("_") & (F.col("head") == F.col("head_"))).drop("source_no_", "doc_id_", "head_")
    start = firsts.select(F.col("source_no").alias("source_no1"), F.col("doc_id").alias("doc_id1"), F.col("place").alias("first"), "total")
    rows = rows.join(start, same("1")).withColumn("at", F.col("first") + F.col("earlier") + F.col("before"))
    step = 10_000
    dealt = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {step}"))).alias("block")).repartition("at", "block")
    left = F.least(F.lit(step), F.col("n") - F.col("block") * step) - 1
    one = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), left)).alias("k"))
    return one.select("source_no", "doc_id", "leaf", "tampered", (F.col("at") + F.col("block") * step + F.col("k")).alias("place"), "total")


def placed_leaves(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """leaves (source_no, doc_id, leaf, tampered) with place, gapless in each source, and total, the leaves of the source."""
    ids = leaves.where("doc_id IS NOT NULL").select("source_no", F.col("doc_id").cast("long"))
    partial = ids.mapInArrow(partial_bitmaps, "source_no int, stretch long, bitmap binary, again array<int>")
    merged = "source_no int, stretch long, bitmap binary, n long, repeated array<long>"
    bitmaps = scratch.keep(partial.groupBy("source_no", "stretch").applyInArrow(merged_bitmaps, merged))
    repeated = scratch.keep(bitmaps.select("source_no", F.explode("repeated").alias("doc_id")))
    tallied = scratch.keep(repeated_rows(leaves, repeated))
    totals = tallied.groupBy("source_no", "doc_id").agg(F.sum("n").alias("n"))
    stretch = F.shiftright("doc_id", STRETCH_BITS)
    more = totals.where("doc_id IS NOT NULL").select("source_no", stretch.alias("stretch"), F.col("doc_id").bitwiseAND((1 << STRETCH_BITS) - 1).alias("at"), (F.col("n") - 1).alias("n"))
    more = more.groupBy("source_no", "stretch").agg(F.collect_list(F.struct(F.col("at").cast("long").alias("at"), "n")).alias("more"), F.sum("n").alias("extra"))
    sized = scratch.keep(bitmaps.join(more, ["source_no", "stretch"], "left").withColumn("n", F.col("n") + F.coalesce("extra", F.lit(0))))
    nulls = totals.where("doc_id IS NULL").select("source_no", F.col("n").alias("nulls"))
    sizes = sized.groupBy("source_no").agg(F.sum("n").alias("held")).join(nulls, "source_no", "full")
    nulls = F.coalesce("nulls", F.lit(0)).alias("nulls")
    sizes = scratch.keep(sizes.select("source_no", nulls, (nulls + F.coalesce("held", F.lit(0))).alias("total")))
    index = sized.join(stretch_offsets(sized.select("source_no", "stretch", "n")), ["source_no", "stretch"]).join(sizes, "source_no")
    index = index.select("source_no", "stretch", "bitmap", "more", (F.col("before") + F.col("nulls")).alias("before"), "total")
    # Rank queries: every id that occurs once, and one for each repeated id.
    again = repeated.select(F.col("source_no").alias("s"), F.col("doc_id").alias("d"))
    single = leaves.where("doc_id IS NOT NULL").join(again, (F.col("source_no") == F.col("s")) & (F.col("doc_id") == F.col("d")), "left_anti")
    nothing = F.lit(None).cast("binary")
    asked = single.unionAll(repeated.select("source_no", "doc_id", nothing, nothing)).withColumn("stretch", stretch)
    schema = "source_no int, doc_id long, leaf binary, tampered binary, place long, total long"
    keys = ["source_no", "stretch"]
    answered = scratch.keep(asked.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(ranked, schema))
    first = answered.where("leaf IS NULL").select("source_no", "doc_id", "place", "total")
    without = sizes.where("nulls > 0").select("source_no", F.lit(None).cast("long"), F.lit(0).cast("long"), "total")
    return answered.where("leaf IS NOT NULL").unionAll(placed_repeats(tallied, first.unionAll(without)))


# The tree. Digests inside arrays are hex text, as they enter the hash.


def node_hash(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(children)).hexdigest().encode()


def climb(slots: list[bytes], total: int) -> list[list[bytes]]:
    """The levels above an array's slots, slots first: up to its root. total counts the nodes of its tree beside the slots.

    In a tree of one array the root is reached when one node is left; else every
    array goes up all its levels, a last one too, however few slots it has.
    """
    levels, size = [slots], ARRAY
    while len(levels[-1]) > 1 if total <= ARRAY else size > 1:
        row = levels[-1]
        levels.append([node_hash(row[k : k + FAN]) for k in range(0, len(row), FAN)])
        size //= FAN
    return levels


def steps(levels: list[list[bytes]], slot: int) -> list[tuple[int, list[bytes]]]:
    """Per level up to the array's root: the place of the slot's ancestor in its run, and the run's others."""
    out = []
    for row in levels[:-1]:
        first = slot - slot % FAN
        out.append((slot % FAN, row[first:slot] + row[slot + 1 : first + FAN]))
        slot //= FAN
    return out


def fold(digest: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that digest leads to along the path."""
    for at, others in path:
        digest = node_hash(others[:at] + [digest] + others[at:])
    return digest


def proof_hash(path: list[tuple[int, list[bytes]]]) -> bytes:
    return node_hash([other for _, others in path for other in others])


def path_bytes(path: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes([at, len(others)]) + b"".join(others) for at, others in path)


def read_path(raw: bytes) -> list[tuple[int, list[bytes]]]:
    path, k = [], 0
    while k < len(raw):
        at, n = raw[k], raw[k + 1]
        path.append((at, [raw[k + 2 + 64 * j : k + 66 + 64 * j] for j in range(n)]))
        k += 2 + 64 * n
    return path


def slot_array(group: pa.Table) -> tuple[list[bytes], np.ndarray, int]:
    """The digests of an array in their slots, the slot of each row, and the nodes of the tree."""
    slot = group.column("place").to_numpy() % ARRAY
    slots = [b""] * len(slot)
    for k, digest in zip(slot.tolist(), group.column("digest").to_pylist()):
        slots[k] = digest.hex().encode()
    return slots, slot, group.column("total")[0].as_py()


NODE = "tree int, place long, digest binary, total long"


def array_root(group: pa.Table) -> pa.Table:
    slots, _, total = slot_array(group)
    root = bytes.fromhex(climb(slots, total)[-1][0].decode())
    place = group.column("place")[0].as_py() // ARRAY
    values = [[group.column("tree")[0].as_py()], [place], [root], [-(-total // ARRAY)]]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64()]
    return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["tree", "place", "digest", "total"])


def slot_paths(group: pa.Table, above: pa.Table) -> pa.Table:
    """tree, place, digest and path (to the root) of every slot of an array; above has the array's own path."""
    if not group.num_rows:
        return pa.Table.from_arrays([pa.array([], k) for k in (pa.int32(), pa.int64(), pa.binary(), pa.binary())], ["tree", "place", "digest", "path"])
    slots, slot, total = slot_array(group)
    levels, upper = climb(slots, total), above.column("path")[0].as_py()
    paths = [path_bytes(steps(levels, k)) + upper for k in slot.tolist()]
    return pa.Table.from_arrays([*(group.column(c) for c in ("tree", "place", "digest")), pa.array(paths, pa.binary())], ["tree", "place", "digest", "path"])


def array(place: str = "place") -> Column:
    return F.expr(f"{place} div {ARRAY}")


def rounds_up(nodes: DataFrame, most: int, scratch: Scratch) -> list[DataFrame]:
    """nodes and the rounds above it, until every tree is one node; most is the number of nodes of the largest tree."""
    rounds = [nodes]
    while most > 1:
        up = rounds[-1].select("tree", "place", "digest", "total", array().alias("array")).groupBy("tree", "array").applyInArrow(array_root, NODE)
        rounds.append(scratch.keep(up))
        most = -(-most // ARRAY)
    return rounds


def paths_down(rounds: list[DataFrame], top: DataFrame, scratch: Scratch) -> DataFrame:
    """tree, place, digest and path of the nodes of rounds[0]; top has tree, place and path of the last round."""
    for nodes in reversed(rounds[:-1]):
        slots = nodes.select("tree", "place", "digest", "total", array().alias("array")).groupBy("tree", "array")
        down = slots.cogroup(top.select("tree", F.col("place").alias("array"), "path").groupBy("tree", "array"))
        top = scratch.keep(down.applyInArrow(slot_paths, "tree int, place long, digest binary, path binary"))
    return top


PROVEN = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def proven(root: bytes):
    """A function of an array's leaves and the array's path that proves each leaf."""

    def prove(group: pa.Table, above: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if group.num_rows:
            slots, slot, total = slot_array(group)
            (over,) = above.to_pylist()
            levels, upper = climb(slots, total), read_path(over["path"])
            for k, tampered in zip(slot.tolist(), group.column("tampered").to_pylist()):
                path = steps(levels, k) + upper
                folded = fold(tampered.hex().encode(), path)
                rows.append((slots[k], over["subroot"], root, proof_hash(path), folded, folded == root))
        names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        columns = [pa.array([r[c] for r in rows], pa.binary()).cast(pa.string()) for c in range(5)]
        return pa.Table.from_arrays([group.column("doc_id"), *columns, pa.array([r[5] for r in rows], pa.bool_())], ["doc_id", *names])

    return prove


def manifest(df: DataFrame, tampered: Column | None = None, doc_id: str = "doc_id", source: str = "source", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    fields are hashed in their order, the last one being the text; tampered is
    the text under which the leaf is proven against the manifest (none: the
    text itself). Leaves of a source go by doc_id, null first, then by digest;
    rows equal in all fields have places side by side. A null source is a source
    of its own and comes first. doc_id must be a whole number. Further columns
    are ignored; an empty table has an empty manifest.
    """
    kind = require_whole_ids(df, doc_id)
    scratch = Scratch(df.sparkSession, "merkle")
    values = [F.col(c) for c in fields]
    other = values[:-1] + [values[-1] if tampered is None else tampered]
    hashed = scratch.keep(df.select(F.col(source).alias("source"), F.col(doc_id).cast("long").alias("doc_id"), leaf_digest(*values).alias("leaf"), leaf_digest(*other).alias("tampered")))
    sources = hashed.select("source").distinct().withColumn("named", F.col("source").isNotNull())
    numbered, n_sources = number_rows(sources, ["named", "source"], scratch, "source_no")
    if not n_sources:
        return df.sparkSession.createDataFrame([], PROVEN).withColumn("doc_id", F.col("doc_id").cast(kind))
    known = scratch.small(numbered.select(F.col("source").alias("s"), F.col("source_no").cast("int").alias("source_no")))
    leaves = scratch.keep(hashed.join(known, F.col("source").eqNullSafe(F.col("s"))).select("source_no", "doc_id", "leaf", "tampered"))
    nodes = scratch.keep(placed_leaves(leaves, scratch).select(F.col("source_no").alias("tree"), "place", F.col("leaf").alias("digest"), "total", "doc_id", "tampered"))
    most = nodes.agg(F.max("total")).first()[0]
    rounds = rounds_up(nodes, max(most, 2), scratch)
    subroots = rounds[-1].select(F.lit(0).alias("tree"), F.col("tree").cast("long").alias("place"), "digest", F.lit(n_sources).cast("long").alias("total"))
    over = rounds_up(subroots, max(n_sources, 2), scratch)
    root = over[-1].first()["digest"].hex().encode()
    top = paths_down(over, over[-1].select("tree", "place", F.lit(b"").alias("path")), scratch)
    top = top.select(F.col("place").cast("int").alias("tree"), F.lit(0).cast("long").alias("place"), "path", F.lower(F.hex("digest")).alias("subroot"))
    upper = paths_down(rounds[1:], top, scratch).select("tree", "place", "path")
    upper = upper.join(top.select("tree", "subroot"), "tree").select("tree", F.col("place").alias("array"), "path", F.col("subroot").cast("binary").alias("subroot"))
    slots = nodes.select("tree", "place", "digest", "total", "doc_id", "tampered", array().alias("array")).groupBy("tree", "array")
    rows = slots.cogroup(upper.groupBy("tree", "array")).applyInArrow(proven(root), PROVEN)
    return rows.withColumn("doc_id", F.col("doc_id").cast(kind))


def stripped_text(doc_id: Column, text: Column) -> Column:
    """The text without line breaks where 2 divides the checksum of the id (null id: of empty text), else the text."""
    even = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
