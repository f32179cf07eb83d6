"""Counting item pairs that occur in the same group, balanced for very large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .indexing import durable, rank_in_order

BLOCK = 256
#: Groups of more items than this are counted by bitmaps.
HEAVY = 512


def sized_baskets(df: DataFrame, group, item: str, low: int, high: int) -> DataFrame:
    """(group columns, _items): the sorted distinct items of the groups with low..high distinct items.

    One sort serves both windows and can spill: a repeated item goes, then all beyond a group's (high + 1)th item, by which an
    oversized group is known without ever being collected. The rows are read once and no task holds a table of its rows.
    """
    group = list(group)
    rows = df.select(*group, item).dropna(subset=group)
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*group, item).orderBy(item))).where("_r = 1")
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(item))).where(F.col("_r") <= high + 1)
    arr = rows.groupBy(*group).agg(F.max("_r").alias("_n"), F.sort_array(F.collect_list(item)).alias("_items"))
    return arr.where(F.col("_n").between(low, high)).drop("_n")


def array_pairs(arr: DataFrame, group) -> DataFrame:
    """Pairs a < b of sorted arrays of bounded size (column _items)."""
    left = arr.select(*group, "_items", F.posexplode("_items").alias("_i", "item_a"))
    rest = F.expr("slice(_items, _i + 2, size(_items))")
    return left.select(*group, "item_a", F.explode(rest).alias("item_b"))


def basket_pairs(baskets: DataFrame, group, item: str) -> DataFrame:
    """Pairs a < b of groups whose size is bounded by the caller."""
    return array_pairs(baskets.groupBy(*group).agg(F.sort_array(F.collect_list(item)).alias("_items")), group)


def block_pairs(rows: DataFrame, group, item: str, block: int | None = None) -> DataFrame:
    """Pairs a < b of every group, for groups of any size: (group columns, item_a, item_b).

    A group is cut into blocks of about ``block`` items (``BLOCK``) and each pair of blocks is one join key, so a group
    that holds a third of the data becomes many small independent pieces.
    """
    group = list(group)
    sizes = rows.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / (block or BLOCK)).cast("int").alias("_blocks"))
    rows = rows.withColumnRenamed(item, "_x").join(sizes, group).withColumn("_blk", F.pmod(F.xxhash64("_x"), F.col("_blocks")).cast("int"))
    left = rows.select(*group, F.col("_x").alias("_a"), F.col("_blk").alias("_i"), F.explode(F.sequence("_blk", F.col("_blocks") - 1)).alias("_j"))
    right = rows.select(*group, F.col("_x").alias("_b"), F.col("_blk").alias("_j"), F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_i"))
    joined = left.join(right, [*group, "_i", "_j"]).where((F.col("_i") < F.col("_j")) | (F.col("_a") < F.col("_b")))
    return joined.select(*group, F.least("_a", "_b").alias("item_a"), F.greatest("_a", "_b").alias("item_b"))


def heavy_words(members: DataFrame, key) -> DataFrame:
    """(key, _x, _word, _bits): the heavy groups of every item as bitmaps, 64 group numbers a row."""
    bit = F.expr("shiftleft(1L, cast(_g % 64 as int))")
    return members.groupBy(*key, "_x", F.floor(F.col("_g") / 64).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def prefix_members(members: DataFrame, key, min_support: int) -> DataFrame:
    """The membership rows that can bring up a pair of ``min_support`` common heavy groups.

    Groups are numbered by size. Two items that share s groups share one among the first n - s + 1 of each item's n, so an item
    enters by these alone and leaves out its s - 1 largest groups; one of fewer than s groups leaves out all.
    """
    if min_support < 2:
        return members
    last = Window.partitionBy(*key, "_x").orderBy(F.desc("_g"))
    return members.withColumn("_r", F.row_number().over(last)).where(F.col("_r") >= min_support).drop("_r")


def pair_counts(df: DataFrame, group, item: str, min_support: int, within=(), heavy: int = HEAVY) -> DataFrame:
    """Number of distinct groups that hold both items, for pairs with enough support.

    ``within`` columns are part of the pair key (e.g. a segment of the group).

    Exact for groups of any size. Items below the support cannot be in a result pair, so they go first. Groups of at most
    ``heavy`` items are expanded in place. Larger ones, at most rows / heavy of them, are not expanded: each item gets a
    bitmap of the heavy groups it is in, and a pair's common heavy groups are counted by the bits that both have. Pairs to count
    come from the light groups and, for those that meet in heavy groups only, from ``prefix_members``. A single huge
    group therefore makes no pairs at all unless the support is 1, when its pairs are the result.
    """
    key, group = list(within), list(group)
    rows = df.select(*key, *group, F.col(item).alias("_x")).dropna(subset=[*key, *group, "_x"]).distinct()
    frequent = rows.groupBy(*key, "_x").agg(F.count(F.lit(1)).alias("_f")).where(F.col("_f") >= min_support)
    rows = durable(rows.join(frequent.drop("_f"), [*key, "_x"], "left_semi") if min_support > 1 else rows)
    big = durable(rows.groupBy(*key, *group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy))
    pair = [*key, "item_a", "item_b"]
    none_big = big.isEmpty()
    light = rows if none_big else rows.join(big.drop("_n"), [*key, *group], "left_anti")
    light = basket_pairs(light, [*key, *group], "_x").groupBy(*pair).agg(F.count(F.lit(1)).alias("co_count"))
    if none_big:
        return light.where(F.col("co_count") >= min_support)
    numbers = rank_in_order(big, [], ["_n", *key, *group], "_g").drop("_n")
    members = durable(rows.join(numbers, [*key, *group]).select(*key, "_x", "_g"))
    words = durable(heavy_words(members, key))
    met = block_pairs(prefix_members(members, key, min_support), [*key, "_g"], "_x").select(*pair).distinct()
    light = durable(light)
    both = light.unionByName(met.withColumn("co_count", F.lit(0).cast("long"))).groupBy(*pair).agg(F.sum("co_count").alias("co_count"))
    side = lambda n: words.select(*key, F.col("_x").alias(f"item_{n}"), "_word", F.col("_bits").alias(f"_bits_{n}"))
    common = both.select(*pair).join(side("a"), [*key, "item_a"]).join(side("b"), [*key, "item_b", "_word"])
    common = common.groupBy(*pair).agg(F.sum(F.bit_count(F.col("_bits_a").bitwiseAND(F.col("_bits_b")))).alias("_heavy"))
    out = both.join(common, pair, "left").withColumn("co_count", F.col("co_count") + F.coalesce("_heavy", F.lit(0))).drop("_heavy")
    return out.where(F.col("co_count") >= min_support)
