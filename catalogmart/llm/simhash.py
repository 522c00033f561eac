"""SimHash near-duplicates found by the generalised pigeonhole principle.

Correlated bits are grouped into partitions. Each partition gets a threshold,
-1 for "not probed"; the thresholds add up to the distance minus the partitions
plus one, so that two fingerprints within the distance agree in some partition
up to its threshold. Dynamic programming chooses them by estimated candidates.
Fingerprints probe the partitions' values, candidates are verified, and linked
fingerprints join into components.

A value shared by many fingerprints makes no pairs: its fingerprints, and those
that probe it, meet at the points one bit away from each. Two fingerprints at
distance two or less share such a point, and a point has 65 neighbours at most.
"""

from __future__ import annotations

import itertools
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import Scratch, per_slice, raw_texts, sums, unused
from catalogmart.llm.components import components

BITS, SHINGLE, DISTANCE, SEED = 64, 3, 2, 42
#: Fingerprints from which correlations and candidate counts are estimated; the results do not depend on them.
ESTIMATE_ROWS = 1_000_000
#: A value of a partition with more fingerprints takes the way over shared points.
HOT = 64
#: Weight of a candidate against a probing row in the choice of thresholds.
CANDIDATE_COST = 0.25


class Partition(NamedTuple):
    bits: tuple[int, ...]
    threshold: int


def fingerprints_of(raw: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of every text; 0 for one without words."""
    hashes: list[int] = []
    counts = np.zeros(len(raw), np.int64)
    digest = xxhash.xxh64_intdigest
    for k, text in enumerate(raw):
        words = text.lower().split()
        if not words:
            continue
        body = b" ".join(words)
        ends = list(itertools.accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[:-1]]
        if len(words) <= shingle:
            hashes.append(digest(body, SEED))
            counts[k] = 1
        else:
            hashes.extend([digest(body[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :])])
            counts[k] = len(words) - shingle + 1
    flat = np.array(hashes, np.uint64)
    begin = np.cumsum(counts) - counts
    out = np.zeros(len(raw), np.uint64)
    step = 1 << 18  # bit rows of so many hashes at once
    totals = np.zeros((len(raw), BITS), np.int64)
    for a in range(0, len(flat), step):
        b = min(a + step, len(flat))
        bits = np.unpackbits(flat[a:b].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        lo, hi = np.clip(begin, a, b), np.clip(begin + counts, a, b)
        totals += sums(bits, lo - a, hi - lo)
    over = 2 * totals > counts[:, None]
    out = np.packbits(over, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def fingerprint(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row; a null text counts as empty."""

    def process(part):
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fingerprints_of(raw_texts(part), shingle).view(np.int64))], ["doc_id", "fp"])

    narrow = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(per_slice(process), f"doc_id {dict(narrow.dtypes)['doc_id']}, fp long")


def _bits_of(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype(np.int64).view(np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1]


def correlations(nodes: DataFrame) -> np.ndarray:
    """Absolute correlation of every two bits over the fingerprints (column fp); bit 0 is the lowest."""

    def moments(batches):
        total = np.zeros((BITS + 1, BITS + 1))
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for a in range(0, len(fp), 1 << 16):
                x = _bits_of(fp[a : a + (1 << 16)]).astype(np.float32)
                x = np.column_stack([np.ones(len(x), np.float32), x])
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["k", "v"])

    total = np.zeros((BITS + 1) ** 2)
    for row in nodes.select("fp").mapInArrow(moments, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        total[row["k"]] = row["v"]
    total = total.reshape(BITS + 1, BITS + 1)
    n = max(total[0, 0], 1.0)
    mean = total[0, 1:] / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return np.abs((total[1:, 1:] / n - np.outer(mean, mean)) / np.outer(spread, spread))


def group_bits(correlation: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Partitions of near equal size; each grows from a free bit by the bit most correlated with it."""
    free, groups = set(range(len(correlation))), []
    for k in range(parts):
        size = len(free) // (parts - k)
        seed = max(sorted(free), key=lambda b: sum(correlation[b, x] for x in free))
        group = [seed]
        free.remove(seed)
        while len(group) < size:
            best = max(sorted(free), key=lambda b: sum(correlation[b, x] for x in group))
            group.append(best)
            free.remove(best)
        groups.append(tuple(sorted(group)))
    return groups


def value_of(fp: Column, bits: tuple[int, ...]) -> Column:
    """The partition's bits of a fingerprint, the others zero."""
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def shared_pairs(nodes: DataFrame, groups: list[tuple[int, ...]]) -> list[float]:
    """Pairs of fingerprints with the same value, per partition."""
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("part"), value_of(F.col("fp"), g).alias("value")) for k, g in enumerate(groups)]))
    values = nodes.select(keys.alias("x")).groupBy("x.part", "x.value").agg(F.count("*").alias("c"))
    pairs = values.groupBy("part").agg(F.sum(F.expr("cast(c as double) * (c - 1) / 2")).alias("pairs"))
    found = {row["part"]: row["pairs"] for row in pairs.collect()}
    return [found.get(k, 0.0) for k in range(len(groups))]


def ball(width: int, radius: int) -> int:
    return sum(math.comb(width, j) for j in range(radius + 1))


def allocate(groups: list[tuple[int, ...]], pairs: list[float], n: float, distance: int) -> tuple[float, list[int]]:
    """Thresholds that add up to distance - parts + 1 at the least estimated cost, and that cost.

    A partition with threshold t costs its probing rows (a ball of radius t per
    fingerprint) and its candidates, taken as the pairs at distance 0 times the
    values in the ball, but at least those of evenly spread values.
    """

    def cost(k: int, t: int) -> float:
        if t < 0:
            return 0.0
        width = len(groups[k])
        even = n * n / 2 / 2.0**width
        return n * (1 + (ball(width, t) if t else 0)) + CANDIDATE_COST * ball(width, t) * max(pairs[k], even)

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for k in range(len(groups)):
        following: dict[int, tuple[float, list[int]]] = {}
        for total, (so_far, chosen) in best.items():
            for t in range(-1, distance + 1):
                option = (so_far + cost(k, t), [*chosen, t])
                if total + t not in following or option < following[total + t]:
                    following[total + t] = option
        best = following
    return best[distance - len(groups) + 1]


def plan_partitions(nodes: DataFrame, n: int, distance: int = DISTANCE) -> list[Partition]:
    """The cheapest of one to distance + 1 partitions; candidate counts come from a bounded sample, scaled up."""
    share = min(1.0, ESTIMATE_ROWS / max(n, 1))
    some = nodes if share == 1.0 else nodes.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30)))
    correlation = correlations(some)
    best = None
    for parts in range(1, distance + 2):
        groups = group_bits(correlation, parts)
        pairs = [x / share**2 for x in shared_pairs(some, groups)]
        cost, thresholds = allocate(groups, pairs, float(n), distance)
        if best is None or cost < best[0]:
            best = (cost, [Partition(g, t) for g, t in zip(groups, thresholds)])
    return [p for p in best[1] if p.threshold >= 0]


def _flips(bits: tuple[int, ...], radius: int) -> list[int]:
    """Masks of one to radius of the bits."""
    masks = [sum(1 << b for b in c) for r in range(1, radius + 1) for c in itertools.combinations(bits, r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _far(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(nodes: DataFrame, plan: list[Partition], distance: int, scratch: Scratch, hot: int = HOT) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within distance 2 of one another, directly or over common neighbours."""
    if distance > 2:
        raise ValueError("fingerprints of a hot value meet over points one bit away: distance 2 at most")
    fp = F.col("fp")
    struct = lambda k, value: F.struct(F.lit(k).alias("part"), value.alias("value"))
    held = scratch.keep(nodes.select("fp", F.explode(F.array(*[struct(k, value_of(fp, p.bits)) for k, p in enumerate(plan)])).alias("x")).select("fp", "x.part", "x.value"))
    crowded = scratch.keep(held.groupBy("part", "value").agg(F.count("*").alias("c")).where(F.col("c") > hot).select("part", "value"))
    any_hot = crowded.limit(1).count() > 0
    far = [(k, p) for k, p in enumerate(plan) if p.threshold > 0]
    probes = held.where(F.col("part").isin([k for k, p in enumerate(plan) if p.threshold == 0])) if any(p.threshold == 0 for p in plan) else None
    for k, p in far:
        near = F.explode(F.array(*[value_of(fp, p.bits).bitwiseXOR(F.lit(m)) for m in [0, *_flips(p.bits, p.threshold)]]))
        rows = nodes.select("fp", F.lit(k).alias("part"), near.alias("value"))
        probes = rows if probes is None else probes.union(rows)
    cool, cool_probes = held, probes
    edges = None
    if any_hot:
        cool = held.join(crowded, ["part", "value"], "left_anti")
        cool_probes = probes.join(crowded, ["part", "value"], "left_anti")
        warm = scratch.keep(probes.join(crowded, ["part", "value"], "left_semi").select("fp").union(held.join(crowded, ["part", "value"], "left_semi").select("fp")).distinct())
        points = F.explode(F.array(*[fp.bitwiseXOR(F.lit(m)) for m in [0, *_flips(tuple(range(BITS)), 1 if distance > 1 else 0)]]))
        at = warm.select("fp", points.alias("point")) if distance > 1 else warm.select("fp", F.explode(F.array(fp, *[fp.bitwiseXOR(F.lit(m)) for m in _flips(tuple(range(BITS)), distance)])).alias("point"))
        meet = at.groupBy("point").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1)
        star = meet.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b")
        edges = star if distance > 1 else star.where(_far(F.col("a"), F.col("b")) <= distance)
    left, right = cool.alias("l"), cool_probes.alias("r")
    near = (F.col("l.part") == F.col("r.part")) & (F.col("l.value") == F.col("r.value")) & (F.col("l.fp") != F.col("r.fp"))
    one_way = F.col("l.fp") < F.col("r.fp") if not far else F.lit(True)
    pairs = left.join(right, near & one_way & (_far(F.col("l.fp"), F.col("r.fp")) <= distance))
    pairs = pairs.select(F.least("l.fp", "r.fp").alias("a"), F.greatest("l.fp", "r.fp").alias("b"))
    return pairs if edges is None else edges.union(pairs)


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable) of every row.

    Null and empty texts share fingerprint zero and link like any other. Rows
    that repeat an id get a row each; a component of null ids alone has a null
    component_id. Further columns are ignored.
    """
    scratch = Scratch(df.sparkSession, "simhash")
    rows = scratch.keep(fingerprint(df, doc_id, text, shingle))
    nodes = scratch.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    n = nodes.count()
    if n > 1:
        plan = plan_partitions(nodes, n, distance)
        roots = components(links(nodes.select("fp"), plan, distance, scratch, hot), scratch)
        rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    else:
        rooted = nodes.select("fp", "least", F.col("fp").alias("root"))
    rooted = scratch.keep(rooted)
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.keep(rooted.join(classes, "root").select("fp", "component_id"))
    text_of = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(named, "fp").select("doc_id", text_of.alias("fingerprint"), "component_id")


def keep_representatives(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df whose id is the component_id of their group, all columns kept; a null id stays only alone among nulls."""
    (name,) = unused(df.columns, "id")
    found = near_duplicates(df, doc_id, text).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name)).distinct()
    return df.join(found, F.col(f"`{doc_id}`").eqNullSafe(F.col(name)), "left_semi")
