"""Operator 11: hard-negative mining over Strassen products of integer tiles.

Anchors and candidates are sorted by label and cut into blocks. A pair of blocks is a tile: an int64 matrix of anchors times one of
candidates, multiplied by Strassen's recursion (seven half-sized products in place of eight, odd sides padded with zeros). Integer
additions are exact, so the scores are, as long as they fit into 64 bits; in between sums may wrap, which cancels out.

Two rounds over the tiles. The first keeps for every anchor a heap of its best candidates of the same label; only tiles whose
label ranges overlap take part, and in them only the rows and columns of one label meet. The second knows these positives and
keeps, for every anchor and positive, a heap of the best candidates of other labels within the positive's window. A heap is
at most k rows; heaps of the same key merge by keeping the first k, within a task before the shuffle and after it.

A block has ``BLOCK`` candidates or ``ANCHORS`` anchors at most, whatever share of the rows has one label, so a hot label is spread over
tiles. Anchor blocks, the smaller side, are copied to the candidate blocks: the work is anchors times candidates by the
method, and is divided evenly.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part; a shorter vector reads as
padded with zeros; a row with a null id is no anchor, and as a candidate ranks behind all ids of its score and comes
back as null (so does the id 2**63 - 1); rows of an anchor's own id are not others to it; repeated rows are
rows of their own, anchors included; a negative positive score has an empty window; components must fit into 64 bits
times 256; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import durable

BLOCK, ANCHORS, LEAF = 4096, 512, 16
NO_ID = 2**63 - 1


def padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    return x if x.shape == (rows, columns) else np.pad(x, ((0, rows - x.shape[0]), (0, columns - x.shape[1])))


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, modulo 2**64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    h, i, j = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a, b = padded(a, 2 * h, 2 * i), padded(b, 2 * i, 2 * j)
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    out = np.zeros((2 * h, 2 * j), np.int64)
    c11, c12, c21, c22 = out[:h, :j], out[:h, j:], out[h:, :j], out[h:, j:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11 += p
    c22 += p
    p = strassen(a21 + a22, b11, leaf)
    c21 += p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12 += p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


def vectors(df: DataFrame, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding") -> DataFrame:
    """id, code, v: the rows that take part, the label as an integer and floor(256 x) of every component x."""
    x = F.col(embedding)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    code = F.col(label).cast("long") if isinstance(df.schema[label].dataType, IntegralType) else F.xxhash64(label)
    own = df.where(F.col(label).isNotNull() & F.coalesce(finite, F.lit(False)))
    return own.select(F.col(vec_id).cast("long").alias("id"), code.alias("code"), F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("long")).alias("v"))


def blocks(own: DataFrame, size: int, dims: int) -> DataFrame:
    """block (0, 1, ...), low, high (codes), ids, codes, width, data: rows sorted by label and cut into equal blocks."""
    spread = own.repartitionByRange("code", "id", F.xxhash64("v")).sortWithinPartitions("code", "id")
    spread = durable(spread.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_i")))
    before = F.sum("n").over(Window.orderBy("_p")) - F.col("n")
    offsets = spread.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).select("_p", before.alias("_o"))  # a row a partition
    placed = spread.join(F.broadcast(offsets), "_p").select("code", "id", "v", (F.col("_o") + F.col("_i")).alias("_at"))
    placed = placed.withColumn("block", F.floor(F.col("_at") / size))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_at")
        m = np.zeros((len(group), dims), np.int64)
        for row, v in zip(m, group["v"], strict=True):
            row[:len(v)] = v
        width = next((w for w in ("<i2", "<i4") if abs(m.min(initial=0)) < np.iinfo(w).max and m.max(initial=0) < np.iinfo(w).max and m.min(initial=0) > -2**62), "<i8")
        codes = group["code"].to_numpy(np.int64)
        return pd.DataFrame({"block": [group["block"].iloc[0]], "low": [codes[0]], "high": [codes[-1]], "ids": [group["id"].fillna(NO_ID).to_numpy(np.int64).tobytes()],
                             "codes": [codes.tobytes()], "width": [width], "data": [m.astype(width).tobytes()]})

    # A null id would make pandas read the others as floats, so it is replaced before.
    placed = placed.withColumn("id", F.coalesce("id", F.lit(NO_ID)))
    return durable(placed.groupBy("block").applyInPandas(pack, "block bigint, low bigint, high bigint, ids binary, codes binary, width string, data binary"))


def _matrix(width: str, data: bytes, dims: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, width).astype(np.int64).reshape(rows, dims)


def positives_of(a, ids_a, codes_a, c, ids_c, codes_c, k: int):
    """(anchor row, score, id) of each anchor's k best candidates of its label in a tile. Codes are sorted."""
    for code in np.unique(codes_a):
        rows = np.arange(np.searchsorted(codes_a, code), np.searchsorted(codes_a, code, "right"))
        low, high = np.searchsorted(codes_c, code), np.searchsorted(codes_c, code, "right")
        if low == high:
            continue
        scores, ids = strassen(a[rows], c[low:high].T), ids_c[low:high]
        for row, s in zip(rows, scores, strict=True):
            at = np.flatnonzero(ids != ids_a[row])
            if len(at) > k:  # what ties with the kth may be in front of it by its id
                at = at[s[at] >= np.partition(s[at], -k)[-k]]
            for i in at[np.lexsort((ids[at], -s[at]))][:k]:
                yield int(row), int(s[i]), int(ids[i])


def negatives_of(a, codes_a, windows, c, ids_c, codes_c, k: int):
    """(anchor row, positive, score, id) of the k best of each window in a tile. ``windows``: per anchor (low, high) of every positive."""
    scores = strassen(a, c.T)
    for row, own in enumerate(windows):
        own = [(j, low, high) for j, (low, high) in enumerate(own) if low <= high]
        if not own:
            continue
        s = scores[row]
        at = np.flatnonzero((s >= min(w[1] for w in own)) & (s <= max(w[2] for w in own)) & (codes_c != codes_a[row]))
        at = at[np.lexsort((ids_c[at], -s[at]))]
        down = -s[at]
        for j, low, high in own:
            first, end = np.searchsorted(down, -high, "left"), np.searchsorted(down, -low, "right")
            for i in at[first:min(end, first + k)]:
                yield row, j, int(s[i]), int(ids_c[i])


def first_k(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The merged heaps: k rows a key by falling score and rising id, with their place from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def window(score: int, least: int, most: int) -> tuple[int, int]:
    """Lowest and highest s with least * score <= 100 * s <= most * score."""
    return -(-least * score // 100), most * score // 100


def mine(df: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, vec_id: str = "vec_id",
         label: str = "label", embedding: str = "embedding", block: int = BLOCK, anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``least`` and ``most`` bound a window in per cent of the positive's score."""
    own = durable(vectors(df, vec_id, label, embedding))
    dims = own.agg(F.max(F.size("v"))).first()[0] or 1
    data = blocks(own, block, dims)
    asked = blocks(own.where(F.coalesce(is_anchor(F.col("id")), F.lit(False))), anchors, dims)
    count = data.count()
    tasks = max(1, min(4 * count, 16 * df.sparkSession.sparkContext.defaultParallelism))
    right = data.select("block", F.col("low").alias("c_low"), F.col("high").alias("c_high"), F.col("ids").alias("c_ids"), F.col("codes").alias("c_codes"), F.col("width").alias("c_width"), F.col("data").alias("c_data"))
    left = asked.select(F.col("block").alias("a_block"), *[c for c in asked.columns if c != "block"])

    def tiles(frame: DataFrame, meets: Column) -> DataFrame:
        spread = frame.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(count - 1, 0)).cast("long"))))
        pairs = spread.select("a_block", "low", "high", "block").join(right.select("block", "c_low", "c_high"), "block").where(meets).select("a_block", "block")
        return pairs.join(frame, "a_block").repartition(tasks, "block").join(right.repartition(tasks, "block"), "block")

    def mapped(frame: DataFrame, columns: list[str], fn, names: list[str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    t = {n: batch.column(n)[i].as_py() for n in columns}
                    ids_a, codes_a, ids_c, codes_c = (np.frombuffer(t[n], np.int64) for n in ("ids", "codes", "c_ids", "c_codes"))
                    found = [(t["a_block"], *r) for r in fn(t, _matrix(t["width"], t["data"], dims, len(ids_a)), ids_a, codes_a, _matrix(t["c_width"], t["c_data"], dims, len(ids_c)), ids_c, codes_c)]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)

        return frame.select(*columns).mapInArrow(run, ", ".join(f"{n} bigint" for n in names))

    columns = ["a_block", "ids", "codes", "width", "data", "c_ids", "c_codes", "c_width", "c_data"]
    overlap = (F.col("low") <= F.col("c_high")) & (F.col("high") >= F.col("c_low"))
    best = mapped(tiles(left, overlap), columns, lambda t, a, ia, ca, c, ic, cc: positives_of(a, ia, ca, c, ic, cc, positives), ["a_block", "row", "score", "id"])
    best = durable(first_k(best, ["a_block", "row"], positives).select("a_block", "row", F.col("rank").cast("long").alias("place"), "score", "id"))

    # Bounded by the anchors of a block times their positives.
    known = best.groupBy("a_block").agg(F.collect_list(F.struct("row", "place", "score")).alias("known"))

    def windows_of(t, a, ia, ca, c, ic, cc):
        windows: list[list[tuple[int, int]]] = [[] for _ in ia]
        for p in sorted((p["row"], p["place"], p["score"]) for p in t["known"]):
            windows[p[0]].append(window(p[2], least, most))
        return ((row, j + 1, s, i) for row, j, s, i in negatives_of(a, ca, windows, c, ic, cc, negatives))

    differ = ~((F.col("low") == F.col("high")) & (F.col("c_low") == F.col("c_high")) & (F.col("low") == F.col("c_low")))
    found = mapped(tiles(left.join(known, "a_block"), differ), [*columns, "known"], windows_of, ["a_block", "row", "place", "score", "id"])
    found = first_k(found, ["a_block", "row", "place"], negatives).select("a_block", "row", "place", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, ids in zip(batch.column("a_block"), batch.column("ids"), strict=True):
                ids = np.frombuffer(ids.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), at.as_py())), pa.array(np.arange(len(ids))), pa.array(ids)], names=["a_block", "row", "anchor_id"])

    named = left.select("a_block", "ids").mapInArrow(unfold, "a_block bigint, row bigint, anchor_id bigint")
    out = found.join(best.select("a_block", "row", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["a_block", "row", "place"]).join(named, ["a_block", "row"])
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return out.select("anchor_id", real("positive_id"), "rank", real("negative_id"), "positive_score", "negative_score")
