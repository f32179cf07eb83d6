"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

#: Edges up to this number (a megabyte) are joined in one partition, without shuffles.
FEW = 1 << 16


def _star(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _star(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of these. ``edges`` point from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = _star(edges, least)
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(u, v) for every node u that is not the least of its component, v being that least node.

    ``edges`` has two columns of one orderable type. Every round is written to the checkpoint
    folder; the number of rounds grows with the logarithm of a component's diameter. Hub
    nodes meet only map-side combined minima, and joins that AQE may split. Once ``FEW`` edges or less are left, a round is one
    task: shuffles of that little would mostly write empty files, as many as there are partitions.
    """
    a, b = edges.columns
    now = durable(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now
        if mark[0] <= FEW:
            now = now.coalesce(1)
        before, now = mark, durable(_small(_large(now)))
