"""Order counts turned into popularity scores per segment, make and overall.

Orders are counted per (user key, sku) before any join, so the join to users carries one
row per pair however often a pair was ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.indexing import rank_in_order
from ..functions.keyed import top_n_per_key
from ..functions.ranges import interval_join
from ..params import RecParams
from ..sources.bags import ORDER_EVENTS

SEGMENT = ("seg_make", "seg_model")


def window_orders(imported: DataFrame, p: RecParams) -> DataFrame:
    """Imported orders of the popularity window, variant-normalised (email, sku)."""
    return imported.where(F.col("order_date").between(F.lit(p.pop_start).cast("date"), F.lit(p.pop_end).cast("date"))) \
        .select("email", X.normalize_variant("sku").alias("sku"))


def event_orders(staged: DataFrame, normalize: bool = True) -> DataFrame:
    """Order events as (user_id, sku)."""
    sku = X.normalize_variant("sku") if normalize else F.col("sku")
    return staged.where(F.upper("event_name").isin(*ORDER_EVENTS) & F.col("sku").isNotNull()).select(
        "user_id", sku.alias("sku"))


def _counts(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def history_counts(imported: DataFrame, p: RecParams) -> DataFrame:
    """Imported orders per (email, sku); one such frame serves D12 and D14."""
    return _counts(window_orders(imported, p), "email", "sku")


def _both_sources(hist, staged, users, by) -> DataFrame:
    hist = hist.join(users.select("email", *by), "email")
    recent = _counts(event_orders(staged), "user_id", "sku").join(users.select("user_id", *by), "user_id")
    keys = [*by, "sku"]
    return hist.select(*keys, "n").unionByName(recent.select(*keys, "n")).groupBy(*keys).agg(F.sum("n").alias("orders"))


def segment_popularity(hist, staged, users, p: RecParams, segment=SEGMENT) -> DataFrame:
    """Orders of both sources per (segment, sku), at least the minimum, scored and ranked.

    ``hist`` comes from ``history_counts``.
    """
    rows = _both_sources(hist, staged, users, segment).where(F.col("orders") >= p.min_segment_orders)
    rows = rows.select(*segment, "sku", F.col("orders").alias("total_segment_orders"),
                       F.round(X.log_score("orders", p.segment_weight), 2).alias("segment_score"))
    return ranked(rows, segment, "total_segment_orders", "rank_in_segment", "segment_total")


def ranked(rows: DataFrame, keys, by: str, name: str, total: str) -> DataFrame:
    """Rank inside a key by an order count, and the key's total. A key of any number of skus is spread over tasks."""
    return rank_in_order(rows, keys, [F.desc(by), F.asc("sku")], name, **{total: F.sum(by)})


def segment_top(segments: DataFrame, n: int, segment=SEGMENT) -> DataFrame:
    """D12, prototype: the n best skus of each segment."""
    return top_n_per_key(segments, segment, [F.desc("total_segment_orders"), F.asc("sku")], n, "pick")


def make_popularity(segments: DataFrame, p: RecParams, make: str = "seg_make") -> DataFrame:
    """Segment counts (after their own minimum) rolled up to the make."""
    rows = segments.groupBy(make, "sku").agg(F.sum("total_segment_orders").alias("total_make_orders"))
    rows = rows.where(F.col("total_make_orders") >= p.min_make_orders).withColumn(
        "make_score", F.round(X.log_score("total_make_orders", p.make_weight), 2))
    return ranked(rows, [make], "total_make_orders", "rank_in_make", "make_total")


def global_popularity(hist, staged, users, p: RecParams) -> DataFrame:
    """Orders of known users per sku. Recent skus are normalised only if asked for."""
    hist = hist.join(users.select("email").distinct(), "email", "left_semi")
    recent = _counts(event_orders(staged, p.normalize_both), "user_id", "sku").join(
        users.select("user_id"), "user_id", "left_semi")
    return hist.select("sku", "n").unionByName(recent.select("sku", "n")).groupBy("sku").agg(
        F.sum("n").alias("total_orders")).withColumn("global_score", X.log_score("total_orders", p.global_weight))


def global_popularity_all(imported, staged, p: RecParams) -> DataFrame:
    """D14, all buyers: full outer join of the two sources."""
    hist = _counts(window_orders(imported, p), "sku").withColumnRenamed("n", "hist")
    recent = _counts(event_orders(staged), "sku").withColumnRenamed("n", "recent")
    both = hist.join(recent, "sku", "full").fillna(0, ["hist", "recent"])
    return both.select("sku", (F.col("hist") + F.col("recent")).alias("total_orders")).withColumn(
        "global_score", X.log_score("total_orders", p.global_weight))


def lookup_tiers(rows: DataFrame, segments, makes, globals_, p: RecParams, segment=SEGMENT) -> DataFrame:
    """Scores of all three tiers for rows of (make, sku): those of the make's segments as one array, so rows need no segment yet.

    ``p.normalize_both`` looks products up by normalised sku. ``choose_tier`` reads the result.
    """
    make, *rest = segment
    key = X.normalize_variant("sku") if p.normalize_both else F.col("sku")
    seg = segments.groupBy(make, F.col("sku").alias("_key")).agg(
        F.collect_list(F.struct(*rest, "segment_score", "rank_in_segment", "segment_total")).alias("_segs"))
    mk = makes.select(make, F.col("sku").alias("_key"), "make_score", "rank_in_make", "make_total")
    gl = globals_.select(F.col("sku").alias("_key"), "global_score")
    known = seg.join(mk, [make, "_key"], "full")
    return rows.withColumn("_key", key).join(known, [make, "_key"], "left").join(gl, "_key", "left").drop("_key")


def choose_tier(rows: DataFrame, p: RecParams, segment=SEGMENT) -> DataFrame:
    """The tier of rows from ``lookup_tiers`` that carry all segment columns; no join."""
    def same(e):
        out = F.lit(True)
        for c in segment[1:]:
            out = out & (e[c] == F.col(c))
        return out

    rows = rows.withColumn("_seg", F.get(F.filter("_segs", same), F.lit(0)))
    rows = rows.withColumns({c: F.col(f"_seg.{c}") for c in ("segment_score", "rank_in_segment", "segment_total")})
    # a tier only counts for products it knows, so its total can ride on the product's row
    use_seg = F.coalesce("segment_total", F.lit(0)) >= p.min_segment_for_use
    use_make = F.coalesce("make_total", F.lit(0)) >= p.min_make_for_use
    rows = rows.withColumns({
        "popularity": F.when(use_seg, F.col("segment_score")).when(use_make, F.col("make_score"))
        .otherwise(F.coalesce("global_score", F.lit(0.0))),
        "popularity_source": F.when(use_seg, "segment").when(use_make, "make")
        .when(F.col("global_score").isNotNull(), "global").otherwise("none"),
        "has_signal": (F.coalesce("segment_score", F.lit(0.0)) > 0) | (F.coalesce("make_score", F.lit(0.0)) > 0)
        | (F.coalesce("global_score", F.lit(0.0)) > 0),
    })
    return rows.drop("_seg", "_segs", "segment_total", "make_total", "make_score", "segment_score", "global_score")


def with_popularity(rows: DataFrame, segments, makes, globals_, p: RecParams, segment=SEGMENT) -> DataFrame:
    """Three-tier popularity per product row that carries segment columns and ``sku``.

    Segment score if the segment has enough orders and knows the product, else make,
    else global, else 0. ``p.normalize_both`` looks products up by normalised sku.
    """
    return choose_tier(lookup_tiers(rows, segments, makes, globals_, p, segment), p, segment)


def with_popularity_by_segment(rows, segments, makes, globals_, p: RecParams, segment=SEGMENT) -> DataFrame:
    """D15, per-segment variant: the tier is chosen for the segment; products unknown there score 0, and none knows those without a global score."""
    make = segment[0]
    seg_tot = segments.groupBy(*segment).agg(F.sum("total_segment_orders").alias("_st"))
    make_tot = makes.groupBy(make).agg(F.sum("total_make_orders").alias("_mt"))
    key = X.normalize_variant("sku") if p.normalize_both else F.col("sku")
    rows = rows.withColumn("_key", key)
    rows = (rows.join(segments.select(*segment, F.col("sku").alias("_key"), "segment_score"), [*segment, "_key"], "left")
            .join(makes.select(make, F.col("sku").alias("_key"), "make_score"), [make, "_key"], "left")
            .join(globals_.select(F.col("sku").alias("_key"), "global_score"), "_key", "left")
            .join(seg_tot, list(segment), "left").join(make_tot, make, "left"))
    tier = (F.when(F.coalesce("_st", F.lit(0)) >= p.min_segment_for_use, "segment")
            .when(F.coalesce("_mt", F.lit(0)) >= p.min_make_for_use, "make")
            .when(F.col("global_score").isNotNull(), "global").otherwise("none"))
    score = (F.when(tier == "segment", F.col("segment_score")).when(tier == "make", F.col("make_score"))
             .otherwise(F.col("global_score")))
    return rows.withColumns({"popularity_source": tier, "popularity": F.coalesce(score, F.lit(0.0))}).drop(
        "_key", "_st", "_mt", "make_score", "segment_score", "global_score")


def with_popularity_two_tier(rows, segments, globals_, p: RecParams, segment=SEGMENT) -> DataFrame:
    """D15, two-tier variant: segment score, else global score, else 0."""
    key = X.normalize_variant("sku") if p.normalize_both else F.col("sku")
    rows = rows.withColumn("_key", key)
    rows = rows.join(segments.select(*segment, F.col("sku").alias("_key"), "segment_score"), [*segment, "_key"], "left")
    rows = rows.join(globals_.select(F.col("sku").alias("_key"), "global_score"), "_key", "left")
    return rows.withColumn("popularity", F.coalesce("segment_score", "global_score", F.lit(0.0))).drop(
        "_key", "segment_score", "global_score")


def recency_weighted_popularity(imported: DataFrame, split: str, w_hist: float = 2.0, w_recent: float = 6.0) -> DataFrame:
    """ln(1+older)*w + ln(1+newer)*w', one conditional pass over the orders."""
    recent = F.col("order_date") >= F.lit(split).cast("date")
    c = imported.groupBy(X.normalize_variant("sku").alias("sku")).agg(
        F.count_if(~recent).alias("hist_orders"), F.count_if(recent).alias("recent_orders"))
    return c.withColumn("popularity", X.log_score("hist_orders", w_hist) + X.log_score("recent_orders", w_recent))


def segment_popularity_year(orders: DataFrame, users: DataFrame, p: RecParams) -> DataFrame:
    """Order counts per (make, model, year, sku); orders carry user_id and sku."""
    c = _counts(orders.select("user_id", X.normalize_variant("sku").alias("sku")), "user_id", "sku")
    keys = ["seg_make", "seg_model", "seg_year", "sku"]
    return c.join(users.select("user_id", *keys[:3]), "user_id").groupBy(*keys).agg(F.sum("n").alias("orders"))


def generation_popularity(year_counts: DataFrame, generations: DataFrame, p: RecParams, share: float = 0.5) -> DataFrame:
    """D17 with J09: each year also sees half of the count of its vehicle generation.

    The year range is joined by ``interval_join``, so generations that overlap under one make cost their matches only.
    """
    g = generations.select(F.col("make").alias("seg_make"), "year_start", "year_end", "generation")
    in_gen = interval_join(year_counts, g, ["seg_make"], "seg_year", "year_start", "year_end")
    gen = in_gen.groupBy("seg_make", "seg_model", "generation", "year_start", "year_end", "sku").agg(
        F.sum("orders").alias("gen_orders"))
    by_year = gen.withColumn("seg_year", F.explode(F.sequence("year_start", "year_end"))).select(
        "seg_make", "seg_model", "seg_year", "sku", "gen_orders")
    both = year_counts.join(by_year, ["seg_make", "seg_model", "seg_year", "sku"], "full").fillna(0, ["orders", "gen_orders"])
    n = F.greatest(F.col("orders").cast("double"), F.col("gen_orders") * F.lit(share))
    return both.withColumn("score", X.log_score(n, p.segment_weight))


# ---- fixed values: (most vehicles, bonus) steps of the narrow-fit bonus ----
NARROW_STEPS = ((50, 10.0), (100, 7.0), (500, 3.0), (1000, 1.0))


def fitment_breadth(fitment: DataFrame, vehicle) -> DataFrame:
    """Number of vehicles a sku fits and the bonus for fitting few."""
    n = F.count_distinct(*[F.col(v) for v in vehicle])
    rows = fitment.groupBy("sku").agg(n.alias("breadth"))
    bonus = None
    for most, points in NARROW_STEPS:
        c = F.col("breadth") <= most
        bonus = F.when(c, points) if bonus is None else bonus.when(c, points)
    return rows.withColumn("narrow_bonus", bonus.otherwise(0.0))


def popularity_coverage(segments: DataFrame, makes: DataFrame) -> DataFrame:
    """Q29: sizes of the popularity tables."""
    seg = segments.agg(
        F.lit("segment").alias("level"), F.count_distinct(F.concat_ws("/", "seg_make", "seg_model")).alias("groups"),
        F.count_distinct("sku").alias("skus"), F.sum("total_segment_orders").alias("orders"),
        F.round(F.avg("segment_score"), 2).alias("avg_score"))
    mk = makes.agg(
        F.lit("make").alias("level"), F.count_distinct("seg_make").alias("groups"),
        F.count_distinct("sku").alias("skus"), F.sum("total_make_orders").alias("orders"),
        F.round(F.avg("make_score"), 2).alias("avg_score"))
    return seg.unionByName(mk)
