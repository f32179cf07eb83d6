"""Operator 10: exact top-k by inner product, dual-tree search over cover trees.

Data vectors are dealt to cells, each around a pivot; the pivots are the upper level of a cover tree
grown on a bounded sample. A cell holds a cover tree of its own vectors. Queries are grouped by the
same pivots and get a cover tree a group. A pair of nodes is pruned when no vector under the one can reach,
with any query under the other, the worst kth score of that query group:

    <q, x>  <=  <cq, cx> + rq |cx| + rx |cq| + rq rx

with centres c and covering radii r. Two rounds: each query group first searches the cells of highest
bound, which gives it k candidates and a floor; then the cells whose bound reaches the floor. Pairs of group and cell are
Spark rows, so the work of one group spreads over tasks and no task holds more than a block of either side.

Bounds: ``SAMPLE`` vectors choose the pivots; a block has at most about ``BLOCK`` vectors, a query block ``GROUP``
queries, whatever a pivot attracts: a larger cell is cut into several.

Defined results: vectors that are null, or hold a null or non-finite component, or none, take no part; a query without
candidates has no rows; ties go to the smaller id; equal ids are separate rows, and a query leaves
out its own row only (one of several equal rows); vectors of another dimension than the first query's score on
their common length; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

SAMPLE, BLOCK, GROUP, LEAF, FAN = 4096, 4096, 256, 128, 16


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    begin: int
    end: int
    children: list[Node] = field(default_factory=list)

    def __post_init__(self):
        self.norm = float(np.sqrt(self.centre @ self.centre))


def spread(points: np.ndarray, most: int, within: float = 0.0) -> np.ndarray:
    """Indices of centres: the farthest point from those chosen, until all lie within the radius."""
    chosen, far = [0], np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < most and far.max() > within:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return np.array(chosen)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2 * points @ centres.T).argmin(1)


def cover_tree(points: np.ndarray) -> tuple[Node, np.ndarray]:
    """Cover tree of the points and their order in it: a node's points are order[begin:end].

    A node's children lie about a net of half its radius (at most ``FAN`` of them, then radii fall more slowly).
    """
    order = np.arange(len(points))

    def grow(begin: int, end: int) -> Node:
        own = points[order[begin:end]]
        centre = own.mean(0)
        far = np.linalg.norm(own - centre, axis=1)
        node = Node(centre, float(far.max()), begin, end)
        if end - begin <= LEAF or node.radius == 0:
            return node
        net = spread(own, FAN, node.radius / 2)
        if len(net) < 2:
            return node
        to = nearest(own, own[net])
        order[begin:end] = order[begin:end][np.argsort(to, kind="stable")]
        edges = begin + np.concatenate([[0], np.cumsum(np.bincount(to, minlength=len(net)))])
        node.children = [grow(int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a and b - a < end - begin]
        return node

    root = grow(0, len(points))
    return root, order


def bound(a: Node, b: Node) -> float:
    """No inner product of vectors under the two nodes is larger."""
    top = float(a.centre @ b.centre) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
    return top + 1e-9 * abs(top) + 1e-3


def dual_search(queries, q_rows, data, d_ids, d_rows, k: int, floors) -> list[tuple[int, int, int, int]]:
    """(query row, id, row, score) of each query's k best in the block that reach its floor."""
    q_root, q_order = cover_tree(queries)
    d_root, d_order = cover_tree(data)
    q, x = queries[q_order], data[d_order]
    q_row, ids, rows = q_rows[q_order], d_ids[d_order], d_rows[d_order]
    floor = floors[q_order].copy()
    best = [[] for _ in q]
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] < 2**53
    stack = [(bound(q_root, d_root), q_root, d_root)]
    while stack:
        top, a, b = stack.pop()
        if top < floor[a.begin:a.end].min():
            continue
        if a.children and (not b.children or a.radius >= b.radius):
            stack += sorted(((bound(c, b), c, b) for c in a.children), key=lambda t: t[0])
        elif b.children:
            stack += sorted(((bound(a, c), a, c) for c in b.children), key=lambda t: t[0])
        else:
            block = x[b.begin:b.end]
            scores = q[a.begin:a.end] @ block.T if exact else np.array(
                [[sum(int(u) * int(v) for u, v in zip(r, s, strict=True)) for s in block] for r in q[a.begin:a.end]], object)
            good = (scores >= floor[a.begin:a.end, None]) & (rows[None, b.begin:b.end] != q_row[a.begin:a.end, None])
            for i in np.flatnonzero(good.any(1)):
                at = np.flatnonzero(good[i])
                if len(at) > k:  # only its k best can stay, and what ties with them
                    least = np.sort(scores[i, at])[-k]
                    at = at[scores[i, at] >= least]
                own = best[a.begin + i] + [(-int(scores[i, j]), int(ids[b.begin + j]), int(rows[b.begin + j])) for j in at]
                own.sort()
                best[a.begin + i] = own = own[:k]
                if len(own) == k:
                    floor[a.begin + i] = max(floor[a.begin + i], -own[-1][0])
    return [(int(r), i, row, -s) for r, own in zip(q_row, best, strict=True) for s, i, row in own]


def vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """_row, vec_id, v: the rows that take part, with floor(256 x) of every component x, as a double.

    _row is fixed by the written table.
    """
    x = F.col(embedding)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    own = df.where(F.coalesce(finite & (F.size(x) > 0), F.lit(False)) & F.col(vec_id).isNotNull())
    own = own.select(F.col(vec_id).alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("double")).alias("v"))
    return durable(own.withColumn("_row", F.monotonically_increasing_id()))


def _pack(matrix: np.ndarray) -> bytes:
    return np.ascontiguousarray(matrix, "<f8").tobytes()


def _unpack(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(-1, dims)


def blocks(own: DataFrame, pivots: np.ndarray, size: int) -> DataFrame:
    """cell, block, n, centre, radius, ids, rows, data: vectors by nearest pivot, cut to blocks.

    A cell's blocks are dealt by a hash of the row, as many as its count needs, so a cell
    of any size (one vector repeated, say) is spread.
    """
    dims = pivots.shape[1]

    def place(batches):
        for b in batches:
            v = np.array([np.resize(x, dims) if len(x) >= dims else np.pad(x, (0, dims - len(x))) for x in b["v"]], float).reshape(-1, dims)
            yield pd.DataFrame({"cell": nearest(v, pivots).astype(np.int32), "_row": b["_row"], "vec_id": b["vec_id"], "v": [_pack(x) for x in v]})

    placed = own.mapInPandas(place, f"cell int, _row bigint, vec_id {own.schema['vec_id'].dataType.simpleString()}, v binary")
    counts = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))  # a row a pivot
    placed = placed.join(F.broadcast(counts), "cell").withColumn("block", F.pmod(F.xxhash64("_row"), F.col("parts")).cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_row")
        m = _unpack(b"".join(group["v"]), dims)
        centre = m.mean(0)
        return pd.DataFrame({"cell": [group["cell"].iloc[0]], "block": [group["block"].iloc[0]], "n": [len(m)], "centre": [centre.tolist()],
                             "radius": [float(np.linalg.norm(m - centre, axis=1).max())], "ids": [group["vec_id"].to_numpy(np.int64).tobytes()],
                             "rows": [group["_row"].to_numpy(np.int64).tobytes()], "data": [_pack(m)]})

    return placed.groupBy("cell", "block").applyInPandas(build, "cell int, block int, n bigint, centre array<double>, radius double, ids binary, rows binary, data binary")


def _pairs(groups: DataFrame, cells: pd.DataFrame, pivots: np.ndarray, k: int, first: bool) -> DataFrame:
    """The blocks that each query group visits. First round: the likeliest cells that hold k others;
    second round: every other cell whose bound reaches the group's worst kth score (column floor)."""
    nodes = [Node(pivots[c], r, 0, 0) for c, r in zip(cells["cell"], cells["radius"], strict=True)]
    near, parts, sizes = cells["cell"].to_numpy(), cells["parts"].to_numpy(), cells["n"].to_numpy()

    def visit(batches):
        for b in batches:
            out = []
            for g in b.itertuples(index=False):
                node = Node(np.array(g.centre), g.radius, 0, 0)
                likely = np.argsort(-np.array([node.centre @ x.centre for x in nodes]), kind="stable")
                enough = int(np.searchsorted(np.cumsum(sizes[likely]), k + 1)) + 1
                todo = likely[:enough] if first else [i for i in likely[enough:] if bound(node, nodes[i]) >= g.floor]
                out += [(g.cell, g.block, near[i], part) for i in todo for part in range(parts[i])]
            yield pd.DataFrame(out, columns=["q_cell", "q_block", "cell", "block"])

    kept = groups.select("cell", "block", "centre", "radius", *([] if first else ["floor"]))
    return kept.mapInPandas(visit, "q_cell int, q_block int, cell int, block int")


def top_k(df: DataFrame, is_query: Callable[[Column], Column], k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", sample: int = SAMPLE,
          block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products. ``is_query`` is a condition on the id."""
    own = vectors(df, vec_id, embedding)
    n = own.count()
    share = min(1.0, sample / max(1, n))
    some = own.where(F.pmod(F.xxhash64("_row", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))).select("_row", "v").toPandas().sort_values("_row")
    kind = own.schema["vec_id"].dataType.simpleString()
    out_schema = "query bigint, vec_id bigint, _row bigint, score bigint"
    if not len(some):
        return own.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score bigint")
    dims = max(map(len, some["v"]))
    points = np.array([np.pad(x, (0, dims - len(x))) for x in some["v"]], float)
    pivots = points[spread(points, max(1, min(256, -(-n // block))))]
    data = durable(blocks(own, pivots, block))
    groups = durable(blocks(own.where(is_query(F.col("vec_id"))), pivots, group))
    # A row a pivot: what the driver and every task know of the index.
    at = F.sqrt(F.aggregate(F.zip_with("centre", "pivot", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    table = own.sparkSession.createDataFrame([(i, p.tolist()) for i, p in enumerate(pivots)], "cell int, pivot array<double>")
    cells = (data.select("cell", "n", "centre", "radius").join(F.broadcast(table), "cell")
             .groupBy("cell").agg(F.sum("n").alias("n"), F.count(F.lit(1)).cast("int").alias("parts"), F.max(at + F.col("radius")).alias("radius"))
             .toPandas().sort_values("cell", ignore_index=True))

    def run(batches):
        for b in batches:
            out = []
            for p in b.itertuples(index=False):
                rows = np.frombuffer(p.q_rows, "<i8")
                floors = np.full(len(rows), -np.inf) if p.q_floors is None else np.array(p.q_floors, float)
                out += dual_search(_unpack(p.q_data, dims), rows, _unpack(p.data, dims), np.frombuffer(p.ids, "<i8"), np.frombuffer(p.rows, "<i8"), k, floors)
            yield pd.DataFrame(out, columns=["query", "vec_id", "_row", "score"]).astype(np.int64)

    def search(pairs, floors):
        asked = pairs.join(floors, ["q_cell", "q_block"]).join(data.select("cell", "block", "ids", "rows", "data"), ["cell", "block"])
        found = asked.select("q_rows", "q_data", "q_floors", "ids", "rows", "data").mapInPandas(run, out_schema)
        return best(found)

    def best(found):
        w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "_row")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    asked = groups.select(F.col("cell").alias("q_cell"), F.col("block").alias("q_block"), F.col("rows").alias("q_rows"), F.col("data").alias("q_data"))
    one = durable(search(_pairs(groups, cells, pivots, k, True), asked.withColumn("q_floors", F.lit(None).cast("array<double>"))))
    # The kth score of each query so far, in the order of its group's rows.
    floors = one.where(F.col("rank") == k).select("query", F.col("score").cast("double").alias("floor"))

    def unfold(batches):
        for b in batches:
            parts = [pd.DataFrame({"cell": g.cell, "block": g.block, "query": np.frombuffer(g.rows, "<i8")}) for g in b.itertuples(index=False)]
            yield pd.concat([x.assign(place=range(len(x))) for x in parts])

    # Bounded by the queries of a group.
    known = (groups.select("cell", "block", "rows").mapInPandas(unfold, "cell int, block int, query bigint, place int").join(floors, "query", "left")
             .withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))).groupBy("cell", "block")
             .agg(F.array_sort(F.collect_list(F.struct("place", "floor"))).alias("f"))
             .select("cell", "block", F.transform("f", lambda s: s["floor"]).alias("q_floors"), F.array_min(F.transform("f", lambda s: s["floor"])).alias("floor")))
    known = durable(known)
    more = _pairs(groups.join(known, ["cell", "block"]), cells, pivots, k, False)
    asked = asked.join(known.select(F.col("cell").alias("q_cell"), F.col("block").alias("q_block"), "q_floors"), ["q_cell", "q_block"])
    two = search(more, asked)
    final = best(one.drop("rank").unionByName(two.drop("rank")))
    names = own.select(F.col("_row").alias("query"), F.col("vec_id").alias("query_id")).where(is_query(F.col("query_id")))
    return final.join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").cast(kind).alias("vec_id"), "score")
