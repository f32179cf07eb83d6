"""Greedy slot filling with one running category cap.

The greedy choice depends on order, so it runs as an array fold per user inside the JVM.
Before the rows of a user are put into an array they are cut to the rows the greedy can
ever reach; the cut is exact and made by windows Spark can prune before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.indexing import rank_in_order
from ..functions.keyed import top_n_per_key


def post_rank_filter(ranked: DataFrame, keep: Column) -> DataFrame:
    """User-supplied predicate over (user, product, category) after ranking."""
    return ranked.where(keep)


def _fold(acc, items, take, phase: int, most: Column | int, total: int, cap: int):
    """Walk items in order; take those that pass, up to ``most`` of this phase and ``total`` overall."""
    def step(a, e):
        room = (F.size(a) < total) & (F.size(F.filter(a, lambda x: x["phase"] == phase)) < most)
        new = ~F.exists(a, lambda x: x["product_id"] == e["product_id"])
        under = F.size(F.filter(a, lambda x: x["category"] == e["category"])) < cap
        made = F.struct(e["product_id"].alias("product_id"), e["category"].alias("category"),
                        e["score"].alias("score"), F.lit(phase).alias("phase"))
        return F.when(room & new & under & take(e), F.concat(a, F.array(made))).otherwise(a)

    return F.aggregate(items, acc, step)


def slot_select(ranked: DataFrame, fitment_slots: int = 4, special_slots: int = 0, total: int = 4, cap: int = 2,
                pid: str = "bigint") -> DataFrame:
    """Fitment slots, then special-pool slots, then backfill, one category cap over all.

    ``ranked``: user_id, product_id, category, score, is_fitment, is_special; already
    without excluded products. Per (pool, category) only the first ``cap`` rows can be
    picked, and at most ``total`` of the rows before a pick can be blocked by the cap, so
    2 x total rows per pool are enough.
    """
    rows = ranked.withColumns({
        "category": F.coalesce("category", F.lit("")),
        "_pool": F.when(F.col("is_fitment"), 0).when(F.col("is_special"), 1).otherwise(2)})
    rows = top_n_per_key(rows, ["user_id", "product_id"], [F.desc("score")], 1).drop("rn")
    order = [F.desc("score"), F.asc("product_id")]
    rows = top_n_per_key(rows, ["user_id", "_pool", "category"], order, cap).drop("rn")
    rows = top_n_per_key(rows, ["user_id", "_pool"], order, 2 * total).drop("rn")
    per_user = rows.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("score")).alias("neg"), "product_id", "category", "score", "_pool"))).alias("items"))
    empty = F.array().cast(f"array<struct<product_id:{pid},category:string,score:double,phase:int>>")
    items = F.col("items")
    acc = _fold(empty, items, lambda e: e["_pool"] == 0, 1, fitment_slots, total, cap)
    acc = _fold(acc, items, lambda e: e["_pool"] == 1, 2, special_slots, total, cap)
    acc = _fold(acc, items, lambda e: F.lit(True), 3, total, total, cap)
    return per_user.select("user_id", F.posexplode(acc).alias("pos", "e")).select(
        "user_id", (F.col("pos") + 1).alias("slot"), "e.product_id", "e.category", "e.score", "e.phase")


def popularity_pools(products: DataFrame, fitment: DataFrame, entities: DataFrame) -> DataFrame:
    """Products of each entity, entity group and overall, by popularity; excluded ones removed.

    ``depth`` is the position inside (pool, category), the key of the fallback join.
    """
    ok = products.where(~F.col("is_excluded")).select(
        "product_id", F.coalesce("category", F.lit("")).alias("category"), F.coalesce("popularity", F.lit(0.0)).alias("popularity"))
    fit = fitment.select("entity_id", "product_id").distinct().join(ok, "product_id")
    per_entity = fit.select(F.lit("entity").alias("level"), F.col("entity_id").cast("string").alias("pool"), *ok.columns)
    per_group = fit.join(entities.select("entity_id", F.coalesce("group_id", F.lit("")).alias("pool")), "entity_id").select(
        F.lit("group").alias("level"), "pool", *ok.columns).distinct()
    overall = fit.select(F.lit("global").alias("level"), F.lit("*").alias("pool"), *ok.columns).distinct()
    pools = per_entity.unionByName(per_group).unionByName(overall)
    order = [F.desc("popularity"), F.asc("product_id")]
    return rank_in_order(pools, ["level", "pool", "category"], order, "depth")


def _cleared_pools(keys: DataFrame, pools: DataFrame, bags: DataFrame, reach: int) -> DataFrame:
    """Rows that a user can reach in the pools of ``keys`` (_bags, level, pool) after what is in their bags is left out.

    Of a category a user needs ``reach`` rows at most: ``cap`` and one for each own rec. Less than ``reach`` rows of earlier pools can come
    again in a pool, or the category is full by then, so its first 2 x reach rows are enough.
    """
    asked = keys.select("_bags", "level", "pool").distinct()
    gone = asked.select("_bags").distinct().withColumn("bag", F.explode("_bags")).join(bags, "bag").select("_bags", "product_id").distinct()
    left = asked.join(pools, ["level", "pool"]).join(gone, ["_bags", "product_id"], "left_anti")
    return top_n_per_key(left, ["_bags", "level", "pool", "category"], [F.asc("depth")], 2 * reach).drop("rn")


def popularity_fallback(recs: DataFrame, users: DataFrame, ownership: DataFrame, entities: DataFrame, pools: DataFrame,
                        excluded: DataFrame, min_recs: int = 4, cap: int = 2, pid: str = "bigint",
                        sentinel: float = 0.0, position: str = "entity_id", bags: DataFrame | None = None) -> DataFrame:
    """Fill short users from their entity pools, then group pools, then the global pool.

    A user's entities come in the order of ``position``, a column of ``ownership`` (the entity id
    itself by default, in its own type: 2 before 10); a group comes where its first entity does.

    Only users below ``min_recs`` enter. With t skipped products (own recs and purchases)
    a user reaches at most ``cap + t`` rows deep into a pool category, so pool rows come by
    equi-join on (pool, depth). What remains per user is cut to ``cap`` rows per category
    and 3 x min_recs rows in tier order, then folded.

    With ``bags`` (bag, product_id) purchases are told by class: ``excluded`` has (user_id, bag), and a user has bought what is in their
    bags. Pools are then cleared once per distinct set of bags, and users only skip their own recs (see ``_cleared_pools``).
    """
    have = recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    short = users.select("user_id").distinct().join(have, "user_id", "left").where(F.coalesce("_n", F.lit(0)) < min_recs).select("user_id")
    own = ownership.join(short, "user_id", "left_semi").groupBy("user_id", "entity_id").agg(F.min(position).alias("_at"))
    own = own.withColumn("turn", F.row_number().over(Window.partitionBy("user_id").orderBy("_at", "entity_id"))).drop("_at")
    grp = own.join(entities.select("entity_id", "group_id"), "entity_id").where("group_id is not null and group_id <> ''").groupBy(
        "user_id", F.col("group_id").alias("pool")).agg(F.min("turn").alias("turn"))
    keys = (own.select("user_id", F.lit(0).alias("tier"), "turn", F.lit("entity").alias("level"), F.col("entity_id").cast("string").alias("pool"))
            .unionByName(grp.select("user_id", F.lit(1).alias("tier"), "turn", F.lit("group").alias("level"), "pool"))
            .unionByName(short.select("user_id", F.lit(2).alias("tier"), F.lit(0).alias("turn"), F.lit("global").alias("level"), F.lit("*").alias("pool"))))
    skip = recs.select("user_id", "product_id")
    if bags is None:
        skip = skip.unionByName(excluded.select("user_id", "product_id")).join(short, "user_id", "left_semi").distinct()
        reach = short.join(skip.groupBy("user_id").agg(F.count(F.lit(1)).alias("_t")), "user_id", "left").select(
            "user_id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(cap) + F.coalesce("_t", F.lit(0)))).alias("depth"))
        cand = keys.join(reach, "user_id").join(pools, ["level", "pool", "depth"])
    else:
        has = short.join(excluded.groupBy("user_id").agg(F.sort_array(F.collect_set("bag")).alias("_bags")), "user_id", "left")
        keys = keys.join(has.withColumn("_bags", F.coalesce("_bags", F.array().cast(has.schema["_bags"].dataType))), "user_id")
        cand = keys.join(_cleared_pools(keys, pools, bags, cap + min_recs - 1), ["_bags", "level", "pool"]).drop("_bags")
    cand = cand.join(skip, ["user_id", "product_id"], "left_anti")
    order = [F.asc("tier"), F.asc("turn"), F.desc("popularity"), F.asc("product_id")]
    cand = top_n_per_key(cand, ["user_id", "product_id"], order, 1).drop("rn")
    cand = top_n_per_key(cand, ["user_id", "category"], order, cap).drop("rn")
    cand = top_n_per_key(cand, ["user_id"], order, 3 * min_recs).drop("rn")
    lists = cand.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(
        "tier", "turn", (-F.col("popularity")).alias("neg"), "product_id", "category",
        F.lit(sentinel).alias("score")))).alias("items"))
    typ = f"array<struct<product_id:{pid},category:string,score:double,phase:int>>"
    start = recs.join(short, "user_id", "left_semi").groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct(
        "slot", "product_id", F.coalesce("category", F.lit("")).alias("category"), "score"))), lambda e: F.struct(
            e["product_id"].alias("product_id"), e["category"].alias("category"), e["score"].alias("score"),
            F.lit(0).alias("phase"))).alias("start"))
    per_user = lists.join(start, "user_id", "left").withColumn("start", F.coalesce(F.col("start").cast(typ), F.array().cast(typ)))
    full = _fold(F.col("start"), F.col("items"), lambda e: F.lit(True), 9, min_recs, min_recs, cap)
    filled = per_user.select("user_id", F.posexplode(full).alias("pos", "e")).where("e.phase = 9").select(
        "user_id", (F.col("pos") + 1).alias("slot"), "e.product_id", "e.category", "e.score", F.lit(True).alias("is_fallback"))
    return recs.select("user_id", "slot", "product_id", "category", "score", F.lit(False).alias("is_fallback")).unionByName(filled)


def provenance(recs: DataFrame, products: DataFrame, total: int, version: str) -> DataFrame:
    """Wide row per user with rec count and where the fallback starts (0-based).

    ``products`` gives name, url, image_url and price; a product that it lacks has empty
    texts and the price 0, a slot that is not filled has nulls.
    """
    empty = {"name": "", "url": "", "image_url": "", "price": 0.0}
    meta = products.groupBy("product_id").agg(*[F.max(c).alias(c) for c in empty])
    recs = recs.join(meta, "product_id", "left").fillna(empty)
    slots = [F.max(F.when(F.col("slot") == i, F.col(c))).alias(f"rec{i}_{c}")
             for i in range(1, total + 1) for c in ("product_id", *empty, "score")]
    n = F.count(F.lit(1))
    return recs.groupBy("user_id").agg(
        *slots, n.alias("rec_count"), F.max("is_fallback").alias("is_fallback"),
        F.coalesce(F.min(F.when(F.col("is_fallback"), F.col("slot") - 1)), n).alias("fallback_start_idx"),
    ).withColumn("model_version", F.lit(version))


def canonical_exclusion(purchases: DataFrame, products: DataFrame, user_map=None) -> DataFrame:
    """Bought products as catalogue ids; every variant of a bought base counts as bought.

    ``user_map`` is the Column function that makes user ids canonical (e.g. a salted hash).
    """
    uid = F.col("user_id") if user_map is None else user_map(F.col("user_id"))
    bought = purchases.select(uid.alias("user_id"), X.normalize_variant(X.norm_upper("sku")).alias("_b")).distinct()
    known = products.select("product_id", X.normalize_variant(X.norm_upper("sku")).alias("_b"))
    return bought.join(known, "_b").select("user_id", "product_id").distinct()
