"""Products bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.indexing import durable
from ..functions.keyed import top_n_per_key
from ..functions.pairs import array_pairs, pair_counts, sized_baskets


def copurchase_basket(purchases: DataFrame, low: int, high: int, group=("user_id", "order_date"),
                      min_count: int = 2, weight: float = 3.0) -> DataFrame:
    """Unordered sku pairs of baskets with low..high distinct skus.

    The range defines a basket; ``pairs.pair_counts`` counts the pairs of groups of any size.
    """
    pairs = array_pairs(sized_baskets(purchases, group, "sku", low, high), group)
    return pairs.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("pair_count")).where(
        F.col("pair_count") >= min_count).withColumn("boost", X.log_score("pair_count", weight))


def copurchase_orders(purchases: DataFrame, low: int, high: int, min_count: int = 5, weight: float = 5.0) -> DataFrame:
    """Pairs of orders with low..high distinct skus, in both directions."""
    pairs = copurchase_basket(purchases, low, high, ("order_id",), min_count, weight)
    return both_directions(pairs, "pair_count", "boost")


def both_directions(pairs: DataFrame, *values: str) -> DataFrame:
    """Undirected pairs as source/target rows of either direction, one pass over the pairs."""
    ends = F.explode(F.array(
        F.struct(F.col("item_a").alias("source"), F.col("item_b").alias("target")),
        F.struct(F.col("item_b").alias("source"), F.col("item_a").alias("target")))).alias("e")
    return pairs.select(ends, *values).select("e.source", "e.target", *values)


def copurchase_conditional(purchases: DataFrame, min_support: int = 5, segment=("seg_make", "seg_model")) -> DataFrame:
    """Per segment, pairs bought by enough users, with both conditional probabilities."""
    segment = list(segment)
    rows = purchases.select(*segment, "user_id", "sku").distinct()
    pairs = pair_counts(rows, ["user_id"], "sku", min_support, within=segment)
    buyers = rows.groupBy(*segment, "sku").agg(F.count(F.lit(1)).alias("n"))
    a = buyers.withColumnsRenamed({"sku": "item_a", "n": "buyers_a"})
    b = buyers.withColumnsRenamed({"sku": "item_b", "n": "buyers_b"})
    out = pairs.join(a, segment + ["item_a"]).join(b, segment + ["item_b"])
    return out.withColumns({
        "p_b_given_a": F.round(F.col("co_count") / F.col("buyers_a"), 3),
        "p_a_given_b": F.round(F.col("co_count") / F.col("buyers_b"), 3),
        "score": F.round(X.log_score("co_count", 5.0), 2),
    })


def copurchase_recommend(purchases: DataFrame, pairs: DataFrame, segment=("seg_make", "seg_model")) -> DataFrame:
    """The other item of a pair for users who own the first one and not the other."""
    segment = list(segment)
    owned = purchases.select("user_id", *segment, "sku").distinct()
    hits = owned.join(pairs.withColumnRenamed("item_a", "sku"), segment + ["sku"]).withColumnRenamed("sku", "owned_sku")
    have = owned.select("user_id", F.col("sku").alias("item_b")).distinct()
    return hits.join(have, ["user_id", "item_b"], "left_anti").select(
        "user_id", *segment, "owned_sku", F.col("item_b").alias("sku"), "score", "p_b_given_a").distinct()


def copurchase_coverage(recs: DataFrame) -> DataFrame:
    """Summary of reachable users and skus."""
    return recs.agg(F.count_distinct("user_id").alias("users"), F.count_distinct("sku").alias("skus"),
                    F.count(F.lit(1)).alias("recs"), F.round(F.avg("score"), 2).alias("avg_score"))


def category_copurchase(purchases: DataFrame, catalog: DataFrame, low: int, high: int, group=("user_id", "order_date"),
                        min_count: int = 50) -> DataFrame:
    """Categories that share baskets of low..high distinct categories.

    Products that the catalogue lacks, or lists without a category, count as UNIVERSAL.
    """
    known = catalog.groupBy("sku").agg(F.max("category").alias("category"))
    category = F.coalesce(F.nullif(F.trim("category"), F.lit("")), F.lit("UNIVERSAL"))
    rows = purchases.join(known, "sku", "left").select(*group, category.alias("category"))
    pairs = array_pairs(sized_baskets(rows, group, "category", low, high), group)
    return pairs.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("pair_count")).where(F.col("pair_count") >= min_count)


def category_copurchase_skus(purchases: DataFrame, catalog: DataFrame, low: int, high: int, group=("user_id", "order_date"),
                             min_count: int = 5) -> DataFrame:
    """D23, backtest form: categories of the sku pairs of baskets with low..high distinct skus.

    The pair keeps the order of its skus; products without a category and pairs of one
    category do not count. Sku pairs are counted before the categories are looked up.
    """
    counts = array_pairs(sized_baskets(purchases, group, "sku", low, high), group).groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n"))
    known = catalog.where("category is not null").groupBy("sku").agg(F.max("category").alias("category"))
    for side in ("a", "b"):
        counts = counts.join(known.select(F.col("sku").alias(f"item_{side}"), F.col("category").alias(f"category_{side}")), f"item_{side}")
    return counts.where("category_a <> category_b").groupBy("category_a", "category_b").agg(F.sum("n").alias("pair_count")).where(
        F.col("pair_count") >= min_count)


def user_copurchase_boost(purchases: DataFrame, pairs: DataFrame) -> DataFrame:
    """Best boost over bought neighbours, either direction, one row per (user, sku)."""
    directed = both_directions(pairs, "boost")
    bought = purchases.select("user_id", F.col("sku").alias("source")).distinct()
    return bought.join(directed, "source").groupBy("user_id", F.col("target").alias("sku")).agg(
        F.max("boost").alias("boost"))


def user_copurchase_sum(strength: DataFrame, directed: DataFrame) -> DataFrame:
    """D24, backtest form: pair score times ln(1 + intent strength), summed over neighbours."""
    s = strength.select("user_id", F.col("sku").alias("source"), F.log1p("strength").alias("w"))
    return s.join(directed, "source").groupBy("user_id", F.col("target").alias("sku")).agg(
        F.sum(F.col("boost") * F.col("w")).alias("boost"))


def copurchase_pmi(order_items: DataFrame, products: DataFrame, min_count: int, top_k: int) -> DataFrame:
    """Pairs of one order with positive PMI; kept if among the top k of either end."""
    rows = durable(order_items.join(products.select("base_sku").distinct(), "base_sku", "left_semi").select(
        "order_id", "base_sku").distinct())
    pairs = pair_counts(rows, ["order_id"], "base_sku", min_count)
    freq = durable(rows.groupBy("base_sku").agg(F.count(F.lit(1)).alias("f")))
    total = rows.agg(F.count_distinct("order_id")).scalar()
    scored = (pairs.join(freq.withColumnsRenamed({"base_sku": "item_a", "f": "fa"}), "item_a")
              .join(freq.withColumnsRenamed({"base_sku": "item_b", "f": "fb"}), "item_b")
              .withColumn("pmi", F.log(F.col("co_count") * total.cast("double") / (F.col("fa") * F.col("fb"))))
              .withColumn("weight", F.log1p(F.col("co_count").cast("double"))).where("pmi > 0"))
    rows = scored.select("item_a", "item_b", "co_count", "pmi", "weight")
    order = [F.desc("co_count")]
    top_a = top_n_per_key(rows, ["item_a"], [*order, F.asc("item_b")], top_k).drop("rn")
    top_b = top_n_per_key(rows, ["item_b"], [*order, F.asc("item_a")], top_k).drop("rn")
    return top_a.unionByName(top_b).distinct()
