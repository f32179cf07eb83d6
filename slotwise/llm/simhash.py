"""Operator 2: SimHash near-duplicates, found exactly with vantage-point trees.

Fingerprints: 64 bits, majority of the XXH64 (seed 42) of a text's 3-word shingles. Two
fingerprints link at a Hamming distance of at most 3; a component is a class of near copies.

Search: equal fingerprints are folded first. A vantage-point tree, built from a bounded sample of
fingerprints, deals all of them to shards. A node keeps a vantage point p and a radius m: what lies
within m + 3 of p goes to the near side, what lies beyond m to the far side. By the triangle
inequality two fingerprints within 3 of each other always meet on one side, so every pair is
found in some shard; only the boundary is copied. Inside a shard the same tree goes on down to
small leaves that are compared in full. A shard reports a spanning forest of its links, never all pairs.

A shard that no vantage point can divide (a dense ball of near copies) is cut into blocks, and pairs
of blocks become shards of their own, so no task grows with such a group.

Bounds: the sample has about ``SAMPLE`` fingerprints; shards aim at ``SHARD`` fingerprints.

Defined results: a null or empty text has fingerprint zero and links like any other; a component's
id is the least non-null doc_id in it (null if it has none); repeated rows share fingerprint and
component; an empty table gives no rows; whole texts are hashed; only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, map_batches, pieces
from .components import connected

RADIUS, SEED, SHINGLE = 3, 42, 3
SAMPLE, SHARD, LEAF = 16_384, 40_000, 512


def shingle_hashes(text: str, size: int = SHINGLE) -> list[int]:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and the six ASCII blanks
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-size] + 1).tolist()]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist(), strict=True)]


def fingerprint(hashes: list[np.ndarray]) -> np.ndarray:
    """Majority bits of each array of 64-bit hashes.

    Bits are summed eight at a time in the bytes of 64-bit words, over blocks of at most 255 hashes.
    """
    sizes = np.array([len(h) for h in hashes], np.int64)
    full = np.flatnonzero(sizes)
    out = np.zeros(len(hashes), np.uint64)
    if not len(full):
        return out
    flat, n = np.concatenate([hashes[i] for i in full]), sizes[full]
    blocks = -(-n // 255)
    firsts = np.cumsum(blocks) - blocks
    inside = np.arange(blocks.sum()) - np.repeat(firsts, blocks)
    begins = np.repeat(np.cumsum(n) - n, blocks) + 255 * inside
    counts = np.empty((len(begins), 64), np.int64)
    for k in range(8):
        lanes = np.add.reduceat(flat >> np.uint64(k) & np.uint64(0x0101010101010101), begins)
        counts[:, k::8] = lanes.view(np.uint8).reshape(-1, 8)
    set_bits = np.add.reduceat(counts, firsts, axis=0) * 2 > n[:, None]
    out[full] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a signed long)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for part in pieces(batch, "_text"):
            found.append(fingerprint([np.array(shingle_hashes(t.as_py() or ""), np.uint64) for t in part.column("_text")]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(np.concatenate(found).view(np.int64))], names=["doc_id", "text_hash", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_text"))
    return map_batches(own, run, f"doc_id {kind}, text_hash bigint, fp bigint")


def distance(points: np.ndarray, point) -> np.ndarray:
    return np.bitwise_count(points ^ point)


def split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that divide the points best; None if nothing divides them well.

    Both sides together hold the boundary twice; the larger side must lose at least a tenth.
    """
    best, least = None, 0.9 * len(points)
    for vantage in points[np.linspace(0, len(points) - 1, 6).astype(int)]:
        upto = np.cumsum(np.bincount(distance(points, vantage), minlength=65 + RADIUS))
        for m in range(65):
            larger = max(upto[min(m + RADIUS, 64)], len(points) - upto[m])
            if larger < least:
                best, least = (vantage, m), larger
    return best


class Tree:
    """Upper levels of the vantage-point tree; its leaves are shards."""

    def __init__(self, sample: np.ndarray, weight: float, shard: int = SHARD):
        self.weight, self.shard, self.shards = weight, shard, 0
        self.root = self._build(np.unique(sample))

    def _build(self, points: np.ndarray):
        size = len(points) * self.weight
        cut = split(points) if size > self.shard and len(points) > 32 else None
        if cut is None:
            self.shards += 1
            return self.shards - 1, max(1, round(size / self.shard)) if size > 2 * self.shard else 1
        d = distance(points, cut[0])
        return (*cut, self._build(points[d <= cut[1] + RADIUS]), self._build(points[d > cut[1]]))

    def deal(self, points: np.ndarray):
        """Arrays (shard, index of the point): each point once or more."""
        shards, rows = [], []

        def down(node, at):
            if not len(at):
                return
            if len(node) == 2:
                leaf, blocks = node
                own = (points[at] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % blocks
                for other in range(blocks):  # the block pairs that hold a point's own block
                    shards.append((leaf << 32) | (np.minimum(own, other) << 16) | np.maximum(own, other))
                    rows.append(at)
                return
            d = distance(points[at], node[0])
            down(node[2], at[d <= node[1] + RADIUS])
            down(node[3], at[d > node[1]])

        down(self.root, np.arange(len(points)))
        return np.concatenate(shards), np.concatenate(rows)


def leaf_links(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of a small set, as (index, index of the component's first)."""
    near = distance(points[:, None], points[None, :]) <= RADIUS
    at = np.flatnonzero(near.sum(1) > 1)
    if not len(at):
        return at, at
    near, label = near[np.ix_(at, at)], np.arange(len(at))
    while True:
        new = np.where(near, label[None, :], len(at)).min(1)
        new = new[new]
        if (new == label).all():
            return at, at[label]
        label = new


def ball_links(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for a set that no vantage point divides.

    Points are asked one by one. When all within 3 + k of the asked point are in one class already,
    the points within k of it can add nothing and are not asked.
    """
    label, open_ = np.arange(len(points)), np.ones(len(points), bool)
    for i in range(len(points)):
        if not open_[i]:
            continue
        d = distance(points, points[i])
        classes = np.unique(label[d <= RADIUS])
        if len(classes) > 1:
            label[np.isin(label, classes)] = classes[0]
        for k in range(RADIUS, -1, -1):
            if (label[d <= RADIUS + k] == label[i]).all():
                open_[d <= k] = False
                break
    return np.arange(len(points)), label


def shard_links(points: np.ndarray) -> np.ndarray:
    """Pairs (member, least member of its class) of distinct linked fingerprints in one shard."""
    points, parent = np.unique(points), {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    stack = [np.arange(len(points))]
    while stack:
        at = stack.pop()
        if len(at) <= LEAF:
            a, b = leaf_links(points[at])
        elif (cut := split(points[at])) is None:
            a, b = ball_links(points[at])
        else:
            d = distance(points[at], cut[0])
            stack += [at[d <= cut[1] + RADIUS], at[d > cut[1]]]
            continue
        tie = a != b
        for x, y in zip(at[a[tie]].tolist(), at[b[tie]].tolist(), strict=True):
            x, y = find(x), find(y)
            parent[max(x, y)] = min(x, y)
    ends = np.array([(x, find(x)) for x in list(parent) if find(x) != x], np.int64).reshape(-1, 2)
    return points[ends]


def links(points: DataFrame, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints (column fp) within the radius."""
    n = points.count()
    share = min(1.0, sample / max(1, n))
    some = points.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))).toPandas()  # about ``sample`` rows
    tree = Tree(some["fp"].to_numpy(np.int64).view(np.uint64), n / max(1, len(some)), shard)

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.asarray(batch.column("fp"))
        shards, rows = tree.deal(fp.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(fp[rows])], names=["shard", "fp"])

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        found = shard_links(group["fp"].to_numpy(np.int64).view(np.uint64)).view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    dealt = map_batches(points.select("fp"), deal, "shard bigint, fp bigint")
    return dealt.groupBy("shard").applyInPandas(solve, "a bigint, b bigint")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, text_hash, root (least fingerprint of the component) of every document."""
    own = durable(fingerprints(docs, doc_id, text))
    points = durable(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected(links(points, shard, sample)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    linked = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = linked.join(least, "root").select("fp", "root", "component_id")
    return own.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash", "root")


def firsts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """One document of each component: the least id (null last), then the least text hash; of repeated rows one."""
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    first = near_copies(docs, doc_id, text, **bounds).groupBy("root").agg(F.min(rank).alias("f"))
    first = first.select(F.coalesce(F.col("f.id").cast("string"), F.lit("")).alias("_id"), F.col("f.hash").alias("_hash"))
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.xxhash64(text).alias("_hash"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    kept = keyed.join(first, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
