"""Near-dedup of the pipeline: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

In the pipeline, candidates are the components of operator 2's vantage-point tree (``fingerprint_keys``). A SimHash radius alone does
not reach all such pairs (at 0.8 about ten of 64 bits differ, and a tree that searches so far copies every
point to every shard), so further candidates come from MinHash: ``BANDS`` keys a text, each from ``ROWS`` minima. A pair at 0.8 shares no
key with a chance of (1 - 0.8 ** ROWS) ** BANDS, 7 in 100,000; more similar pairs are missed less often. Each candidate is confirmed by
the exact similarity of the whole sets, and a component of confirmed links is a class.

Texts that share a key first meet one hub, another for each key; the texts of a key that are not in one class after that are compared
in full, block by block within tasks, which give back a forest of links. So a large class costs its members times ``BANDS``
comparisons, and what a key of many unlike texts costs stays inside the tasks.

Defined results: null and empty texts have no shingle and are alike; a text of fewer words is one shingle; equal texts
are compared once; an empty table gives no rows; whole texts are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import durable, map_batches, pieces
from .components import connected
from .simhash import shingle_hashes

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
#: Texts in a block of a key, and shingles in a matrix of shared ones.
BLOCK, WIDTH = 256, 16_384
_FACTORS = np.random.default_rng(17).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    return np.unique(np.array(shingle_hashes(text or "", size), np.uint64))


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``BANDS`` keys for each set."""
    full = [i for i, s in enumerate(sets) if len(s)]
    keys = np.zeros((len(sets), BANDS), np.uint64)
    if full:
        flat, sizes = np.concatenate([sets[i] for i in full]), np.array([len(sets[i]) for i in full])
        begins = np.cumsum(sizes) - sizes
        for band in range(BANDS):
            key = np.zeros(len(full), np.uint64)
            for factor in _FACTORS[band * ROWS:(band + 1) * ROWS]:
                key = (key ^ key >> np.uint64(29)) * _MIX + np.minimum.reduceat(flat * factor, begins)
            keys[full, band] = key
    return (keys ^ keys >> np.uint64(32)) * _MIX + np.arange(BANDS, dtype=np.uint64)


def keyed(docs: DataFrame, doc_id: str, text: str, size: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, keys of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [band_keys([shingles(t.as_py(), size) for t in part.column("_text")]) for part in pieces(batch, "_text")]
        flat = pa.array(np.concatenate(found).view(np.int64).ravel())
        keys = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS), flat)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), keys], names=["doc_id", "text_hash", "keys"])

    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_text"))
    return map_batches(own, run, f"doc_id {kind}, text_hash bigint, keys array<bigint>")


def confirmed(pairs: DataFrame, docs: DataFrame, text: str, size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of text hashes whose sets are that similar."""
    asked = pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct()
    texts = docs.select(F.xxhash64(text).alias("h"), F.col(text).alias("_text")).join(asked, "h", "left_semi")

    def gather(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t.as_py(), size).tobytes() for t in batch.column("_text")]
        return pa.RecordBatch.from_arrays([batch.column("h"), pa.array(sets, pa.binary())], names=["h", "s"])

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= similarity * max(len(x), len(y)) else 0
            keep.append(both >= similarity * (len(x) + len(y) - both))
        return batch.select(["a", "b"]).filter(pa.array(keep))

    sets = durable(map_batches(texts, gather, "h bigint, s binary", "_text").groupBy("h").agg(F.first("s").alias("s")))
    both = pairs.join(sets.select(F.col("h").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("h").alias("b"), F.col("s").alias("sb")), "b")
    return durable(map_batches(both.select("a", "b", "sa", "sb"), compare, "a bigint, b bigint", "sa"))


def forest(sets: list[np.ndarray], side: np.ndarray, roots: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links (i, j) that join all similar sets of different sides and roots: a spanning forest over the roots, not all pairs.

    A side of 0 or 1 marks the block of a set; where all are on one side, all pairs count.
    """
    size = np.array([len(s) for s in sets])
    flat, of = np.concatenate([*sets, np.empty(0, np.uint64)]), np.repeat(np.arange(len(sets)), size)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    of, column = of[shared[column]], number[column[shared[column]]]
    both = np.zeros((len(sets), len(sets)))
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    for low in range(0, int(shared.sum()), WIDTH):  # so many shared shingles at a time
        at = slice(*np.searchsorted(column, (low, low + WIDTH)))
        m = np.zeros((len(sets), WIDTH), np.float32)
        m[of[at], column[at] - low] = 1
        both += m @ m.T
    near = both >= similarity * (size[:, None] + size[None, :] - both)
    near &= roots[:, None] != roots[None, :]
    if side.any() and not side.all():
        near &= side[:, None] != side[None, :]
    root, out = np.unique(roots, return_inverse=True)[1], []
    for i, j in zip(*np.nonzero(np.triu(near)), strict=True):
        if root[i] != root[j]:
            root[root == root[j]] = root[i]
            out.append((int(i), int(j)))
    return out


def linked(placed: DataFrame, docs: DataFrame, text: str, size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): links that join every similar pair of different roots within a key. ``placed``: key, text_hash, root, parts.

    A key's texts are cut into ``parts`` blocks, and a task compares two blocks at a time in full and gives a forest back, so
    what a key of many texts makes is rows of blocks, and never pairs.
    """
    placed = durable(placed.withColumn("part", F.pmod(F.xxhash64("text_hash", F.lit(3)), F.col("parts")).cast("int")))
    texts = docs.select(F.xxhash64(text).alias("h"), F.col(text).alias("_text")).join(placed.select(F.col("text_hash").alias("h")).distinct(), "h", "left_semi")

    def gather(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t.as_py(), size).tobytes() for t in batch.column("_text")]
        return pa.RecordBatch.from_arrays([batch.column("h"), pa.array(sets, pa.binary())], names=["text_hash", "s"])

    sets = map_batches(texts, gather, "text_hash bigint, s binary", "_text").groupBy("text_hash").agg(F.first("s").alias("s"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = other.select("key", "text_hash", "root", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), (F.col("part") > F.col("other")).cast("int").alias("side"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own = group["text_hash"].to_numpy()
        found = forest([np.frombuffer(s, np.uint64) for s in group["s"]], group["side"].to_numpy(), group["root"].to_numpy(), similarity)
        return pd.DataFrame([sorted((own[i], own[j])) for i, j in found], columns=["a", "b"], dtype=np.int64)

    found = rows.join(sets, "text_hash").groupBy("key", "low", "high").applyInPandas(compare, "a bigint, b bigint")
    return durable(found.distinct())


def fingerprint_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(text_hash, key): one key for each component of operator 2, so that all texts that its fingerprints link share one."""
    return simhash.near_copies(docs, doc_id, text).select("text_hash", F.xxhash64("root", F.lit("fingerprint")).alias("key")).distinct()


def classes(own: DataFrame, docs: DataFrame, text: str = "text", more: DataFrame | None = None, **measure) -> DataFrame:
    """(u, v): every text hash that is not the least of its class, and the least. ``own`` is what keyed() gives; ``more`` has further keys (text_hash, key)."""
    shared = own.groupBy("text_hash").agg(F.first("keys").alias("keys")).select("text_hash", F.explode("keys").alias("key"))
    if more is not None:
        shared = shared.unionByName(more)
    hubs = shared.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "text_hash").alias("draw"), F.col("text_hash").alias("hub"))).alias("first"), F.count(F.lit(1)).alias("n"))
    met = durable(shared.join(hubs.where("n > 1").select("key", F.col("first.hub").alias("hub")), "key"))
    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    stars = durable(met.where("text_hash != hub").select(*pair("text_hash", "hub")).distinct())
    links = confirmed(stars, docs, text, **measure)
    roots = connected(links)
    placed = met.join(roots.withColumnRenamed("u", "text_hash"), "text_hash", "left").select("key", "text_hash", F.coalesce("v", "text_hash").alias("root"))
    split = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).where("low != high")
    split = split.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    return connected(links.union(linked(placed.join(split, "key"), docs, text, **measure)))


def firsts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", more: DataFrame | None = None, **measure) -> DataFrame:
    """One document of each class: the least id (null last), then the least text hash; of repeated rows one."""
    own = durable(keyed(docs, doc_id, text, measure.get("size", SHINGLE)))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    least = own.groupBy("text_hash").agg(F.min(rank).alias("f"))
    rooted = least.join(classes(own, docs, text, more, **measure).withColumnRenamed("u", "text_hash"), "text_hash", "left")
    first = rooted.groupBy(F.coalesce("v", "text_hash").alias("root")).agg(F.min("f").alias("f"))
    first = first.select(F.coalesce(F.col("f.id").cast("string"), F.lit("")).alias("_id"), F.col("f.hash").alias("_hash"))
    named = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.xxhash64(text).alias("_hash"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    kept = named.join(first, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
