"""Ranks and dense ids over a whole table without a single-task window."""

from __future__ import annotations

import tempfile
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .keyed import shared

#: Rows that share a range of hashes, about.
ROWS = 1 << 16


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors and the driver share.

    Without ``spark.checkpoint.dir`` a local session gets a folder of its own; on a cluster that is an error, since
    no machine's own folder is shared.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="slotwise-"))
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write the frame to the checkpoint folder of the session and read it from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def rank_by_hash(df: DataFrame, keys, ids, seed: int, rank: str = "pos") -> DataFrame:
    """Number the rows of each key 0..n-1 in a seeded random order of their ids.

    Equal to row_number over (key, hash), but the hashes are cut into as many equal ranges as the table has times ROWS rows: range
    counts give each range its offset, and rows are only ranked inside their key and range. ``ids`` must be unique within a
    key. The key's size comes along as ``<rank>_n``. The order doesn't depend on the number of ranges.
    """
    keys, ids = list(keys), list(ids)
    h = F.xxhash64(*[F.col(c) for c in ids], F.lit(seed))
    buckets = F.greatest(F.ceil(df.agg(F.count(F.lit(1))).scalar() / ROWS), F.lit(1))
    place = F.floor((F.col("_h").cast("double") / F.lit(2.0**64) + 0.5) * buckets)
    rows = df.withColumn("_h", h).withColumn("_b", F.least(place, buckets - 1))
    counts = rows.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    sofar = F.sum("_c").over(w.orderBy("_b")) - F.col("_c")
    counts = counts.select(*keys, "_b", sofar.alias("_off"), F.sum("_c").over(w).alias(f"{rank}_n"))
    local = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy("_h", *ids))
    rows = rows.withColumn("_r", local).join(counts, keys + ["_b"])
    return rows.withColumn(rank, F.col("_off") + F.col("_r") - 1).drop("_h", "_b", "_r", "_off")


def rank_in_order(df: DataFrame, keys, order, out: str = "rank", **totals: Column) -> DataFrame:
    """Number the rows of each key 1..n in the given order, however many rows a key has.

    Equal to ``row_number()`` over (key, order), without a task that holds a key. Rows are range-partitioned by
    (key, order) and sorted, so a hot key lies in several partitions in the right order; a row's number is its
    position among the key's rows of the partition plus the key's rows in the partitions before. These pieces are one row per
    key and partition it touches, combined map-side. ``totals`` are sums (``F.sum`` columns) over the key that ride
    along. The order must name every tie. The partitioned rows are kept (memory and disk), so positions and pieces agree; what
    a lost executor held is made again by the same partitioner, whose borders are fixed by then.
    """
    keys, order = list(keys), [F.col(o) if isinstance(o, str) else o for o in order]
    by = [*[F.col(k) for k in keys], *order]
    spread = df.repartitionByRange(*by).sortWithinPartitions(*by)
    spread = shared(spread.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_i")))
    pieces = spread.groupBy(*keys, "_p").agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_c"), *[t.alias(f"_t_{n}") for n, t in totals.items()])
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = F.sum("_c").over(whole.orderBy("_p")) - F.col("_c")
    pieces = pieces.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_p").alias("_kp"), (before - F.col("_first") + 1).alias("_shift"),
                           *[F.sum(f"_t_{n}").over(whole).alias(n) for n in totals])
    same = F.col("_p") == F.col("_kp")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    ranked = spread.join(pieces, same).withColumn(out, F.col("_i") + F.col("_shift"))
    return ranked.select(*df.columns, out, *totals)


def disc_quantile(df: DataFrame, keys, value: str, q: float, out: str) -> DataFrame:
    """Exact discrete quantile per key, as SQL's PERCENTILE_DISC: the value at position ceil(q x n), read off the distributed rank."""
    rows = df.where(F.col(value).isNotNull()).select(*keys, value)
    rows = rank_in_order(rows, keys, [F.asc(value)], "_at", _n=F.sum(F.lit(1)))
    place = F.greatest(F.ceil(F.col("_n").cast("decimal(18,0)") * F.lit(Decimal(str(q)))).cast("long"), F.lit(1).cast("long"))
    return rows.where(F.col("_at") == place).select(*keys, F.col(value).alias(out))


def dense_ids(df: DataFrame, key: str, out: str = "id") -> DataFrame:
    """0-based ids of the distinct keys in sorted order.

    Keys are range-partitioned and sorted; a key's id is its position in the partition plus
    the sizes of the partitions before it. The partitioned rows are written once, so the
    sizes and the ids come from the same partitioning.
    """
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    spread = keys.repartitionByRange(key).sortWithinPartitions(key).select(
        key, F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_i"))
    spread = durable(spread)
    sizes = spread.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_p", before.alias("_o"))  # one row per partition
    return spread.join(F.broadcast(offsets), "_p").select(key, (F.col("_o") + F.col("_i")).alias(out))


def pick(n: Column, *seed) -> Column:
    """Index in 0..n-1 chosen by the hash of the seed columns."""
    return F.pmod(F.xxhash64(*seed), n)
