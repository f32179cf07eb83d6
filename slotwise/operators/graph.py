"""Node, edge and training tables of the recommendation graph."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.indexing import dense_ids, pick, rank_by_hash
from ..functions.keyed import shared
from ..sources.bags import CONSENT_YES, explode_props

EPS = 1e-8


def user_nodes(attrs: DataFrame, bag: str = "props") -> DataFrame:
    """One node per email with a complete vehicle, consent flag and a cold start tier."""
    flat = explode_props(attrs, bag).select("user_id", F.lower("p.property_name").alias("name"), X.prop_text("p").alias("text"))

    def largest(key, value):
        return F.max(F.when(F.col("name") == key, value))

    per_user = flat.groupBy("user_id").agg(
        F.nullif(largest("email", X.norm_lower("text")), F.lit("")).alias("email"), largest("v1_make", X.norm_upper("text")).alias("make"),
        largest("v1_model", X.norm_upper("text")).alias("model"), largest("v1_year", F.trim("text")).alias("year"),
        largest("email_marketing_consent", X.norm_lower("text")).alias("consent"))
    rows = per_user.where("email is not null").groupBy("email").agg(*[F.max(c).alias(c) for c in ("make", "model", "year", "consent")])
    return rows.where("year is not null and make <> '' and model <> ''").select(
        "email", "make", "model", "year", F.coalesce(F.col("consent").isin(*CONSENT_YES), F.lit(False)).alias("has_consent"),
        F.lit("cold").alias("tier"))


def product_nodes(catalog: DataFrame, orders: DataFrame, fitment: DataFrame, vehicle, min_price: float,
                  excluded_categories=("Service", "Commodity")) -> DataFrame:
    """One node per base sku: canonical sku, price, log order count, breadth, universal flag."""
    base = X.normalize_variant("sku")
    priced = catalog.where(F.col("price") >= min_price).groupBy(base.alias("base_sku")).agg(
        F.min("sku").alias("sku"), F.max("price").alias("price"))
    sold = orders.groupBy(base.alias("base_sku")).agg(F.count(F.lit(1)).alias("n"))
    fits = fitment.groupBy(base.alias("base_sku")).agg(F.count_distinct(*vehicle).alias("breadth"))
    attrs = catalog.groupBy("sku").agg(F.max("category").alias("category"), F.max("is_universal").alias("is_universal"),
                                       F.max(X.is_refurbished("tags")).alias("_r"))
    rows = priced.join(attrs, "sku", "left").where(~F.coalesce("_r", F.lit(False)) & ~F.coalesce("category", F.lit("")).isin(*excluded_categories))
    return rows.join(sold, "base_sku", "left").join(fits, "base_sku", "left").select(
        "sku", "base_sku", "category", "price", F.log1p(F.coalesce("n", F.lit(0)).cast("double")).alias("log_popularity"),
        F.coalesce("breadth", F.lit(0)).alias("breadth"), F.coalesce("is_universal", F.lit(False)).alias("is_universal"))


def vehicle_nodes(users: DataFrame, fitment: DataFrame, vehicle) -> DataFrame:
    """Vehicles of the users with user count and number of fitting products."""
    vehicle = list(vehicle)
    u = users.groupBy(*vehicle).agg(F.count(F.lit(1)).alias("user_count"))
    f = fitment.groupBy(*vehicle).agg(F.count_distinct(X.normalize_variant("sku")).alias("product_count"))
    return u.join(f, vehicle, "left").fillna(0, ["product_count"])


def interaction_edges(events: DataFrame, users: DataFrame, products: DataFrame, cutoff: str, halflife: float = 30.0) -> DataFrame:
    """One edge per distinct event up to the cutoff, base weight times exponential decay."""
    rows = events.where(F.to_date("event_ts") <= F.lit(cutoff).cast("date")).select("user_id", "sku", "type", "event_ts").distinct()
    days = F.datediff(F.lit(cutoff).cast("date"), F.to_date("event_ts"))
    rows = rows.select("user_id", X.normalize_variant("sku").alias("base_sku"), "type", "event_ts",
                       (X.score_interaction("type") * F.exp(-F.log(F.lit(2.0)) * days / F.lit(halflife))).alias("weight"))
    return rows.join(users.select("user_id").distinct(), "user_id", "left_semi").join(
        products.select("base_sku").distinct(), "base_sku", "left_semi")


def fitment_edges(fitment: DataFrame, products: DataFrame, vehicles: DataFrame, vehicle) -> DataFrame:
    """Distinct (product, vehicle) among known nodes."""
    vehicle = list(vehicle)
    rows = fitment.select(X.normalize_variant("sku").alias("base_sku"), *vehicle).distinct()
    return rows.join(products.select("base_sku").distinct(), "base_sku", "left_semi").join(vehicles.select(*vehicle), vehicle, "left_semi")


def ownership_edges(users: DataFrame, vehicles: DataFrame, vehicle) -> DataFrame:
    """Distinct (user, vehicle) among known nodes."""
    vehicle = list(vehicle)
    return users.select("user_id", *vehicle).distinct().join(vehicles.select(*vehicle), vehicle, "left_semi")


def temporal_split(orders: DataFrame, end: str, holdout_days: int = 30):
    """Training rows up to end-30, test interactions from the day after, (user, base sku) once."""
    cut = F.date_sub(F.lit(end).cast("date"), holdout_days)
    train = orders.where(F.col("order_date") <= cut)
    test = orders.where((F.col("order_date") > cut) & (F.col("order_date") <= F.lit(end).cast("date"))).select(
        "user_id", X.normalize_variant("sku").alias("base_sku")).distinct()
    return train, test


def recent_purchases(orders: DataFrame, end: str, days: int = 365) -> DataFrame:
    """Distinct (user, base sku) bought in the last year."""
    d = F.col("order_date")
    return orders.where((d > F.date_sub(F.lit(end).cast("date"), days)) & (d <= F.lit(end).cast("date"))).select(
        "user_id", X.normalize_variant("sku").alias("base_sku")).distinct()


def zscore(df: DataFrame, columns):
    """Z-scores with population deviation + 1e-8; returns the frame and its one-row statistics."""
    stats = df.agg(*[x for c in columns for x in (F.avg(c).alias(f"{c}_mean"), (F.stddev_pop(c) + EPS).alias(f"{c}_std"))])
    row = stats.select(F.struct(*stats.columns)).scalar()
    out = df.withColumn("_s", row)
    out = out.withColumns({f"{c}_z": (F.col(c) - F.col(f"_s.{c}_mean")) / F.col(f"_s.{c}_std") for c in columns})
    return out.drop("_s"), stats


def encode_labels(df: DataFrame, column: str, out: str = "label_id") -> DataFrame:
    """Integer label per value in sorted order; NULL counts as UNKNOWN."""
    rows = df.withColumn(column, F.coalesce(column, F.lit("UNKNOWN")))
    return rows.join(dense_ids(rows, column, out), column)


def stratified_split(users: DataFrame, tier: str = "tier", ratios=(0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """train/val/test per tier with cuts at int(n * ratio); NULL tier is its own stratum."""
    rows = users.withColumn("_tier", F.lower(F.coalesce(F.col(tier), F.lit("unknown"))))
    rows = rank_by_hash(rows, ["_tier"], ["user_id"], seed)
    a = F.floor(F.col("pos_n") * F.lit(ratios[0]))
    b = a + F.floor(F.col("pos_n") * F.lit(ratios[1]))
    return rows.withColumn("split", F.when(F.col("pos") < a, "train").when(F.col("pos") < b, "val").otherwise("test")).drop("_tier", "pos", "pos_n")


def build_edges(interactions, fitment, ownership, copurchase, users, products, splits, weight=None) -> DataFrame:
    """Typed edges among known ids with reverse direction; co-purchase symmetric; train flag on interactions."""
    known_u, known_p = users.select("user_id"), products.select("product_id")
    w = F.coalesce(F.col("weight"), F.lit(1.0)) if weight is None else weight
    train = splits.select("user_id", (F.col("split") == "train").alias("is_train"))
    i = interactions.join(known_u, "user_id", "left_semi").join(known_p, "product_id", "left_semi").join(train, "user_id", "left").select(
        F.col("user_id").alias("src"), F.col("product_id").alias("dst"), F.lit("interacts").alias("edge_type"),
        w.cast("double").alias("weight"), F.coalesce("is_train", F.lit(False)).alias("is_train"))
    f = fitment.join(known_p, "product_id", "left_semi").select(
        F.col("product_id").alias("src"), F.col("entity_id").alias("dst"), F.lit("fits").alias("edge_type"), F.lit(1.0).alias("weight"), F.lit(False).alias("is_train"))
    o = ownership.join(known_u, "user_id", "left_semi").select(
        F.col("user_id").alias("src"), F.col("entity_id").alias("dst"), F.lit("owns").alias("edge_type"), F.lit(1.0).alias("weight"), F.lit(False).alias("is_train"))
    one_way = i.unionByName(f).unionByName(o)
    ends = F.explode(F.array(
        F.struct("src", "dst", "edge_type", "is_train"),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), F.concat(F.lit("rev_"), "edge_type").alias("edge_type"), F.lit(False).alias("is_train"))))
    both = one_way.select(ends.alias("e"), "weight").select("e.src", "e.dst", "e.edge_type", "weight", "e.is_train")
    c = copurchase.join(known_p.withColumnRenamed("product_id", "product_a"), "product_a", "left_semi").join(
        known_p.withColumnRenamed("product_id", "product_b"), "product_b", "left_semi")
    pair = F.explode(F.array(F.struct(F.col("product_a").alias("src"), F.col("product_b").alias("dst")),
                             F.struct(F.col("product_b").alias("src"), F.col("product_a").alias("dst"))))
    c = c.select(pair.alias("e"), F.coalesce("weight", F.lit(0.0)).cast("double").alias("weight")).select(
        "e.src", "e.dst", F.lit("co_purchased").alias("edge_type"), "weight", F.lit(False).alias("is_train"))
    return both.unionByName(c)


def edge_findings(edges: DataFrame, required=("interacts",)) -> DataFrame:
    """Per edge type the rows, bad weights (NaN, infinite, negative) and, for required types, emptiness."""
    v = F.col("weight").cast("double")
    bad = F.count_if(F.isnan(v) | (F.abs(v) == float("inf")) | (v < 0))
    found = edges.groupBy("edge_type").agg(F.count(F.lit(1)).alias("edges"), bad.alias("bad_weights"))
    need = edges.sparkSession.createDataFrame([(r,) for r in required], "edge_type string")
    return found.join(need.withColumn("required", F.lit(True)), "edge_type", "full").select(
        "edge_type", F.coalesce("edges", F.lit(0)).alias("edges"), F.coalesce("bad_weights", F.lit(0)).alias("bad_weights"),
        F.coalesce("required", F.lit(False)).alias("required")).withColumn("missing", F.col("required") & (F.col("edges") == 0))


def require_edges(edges: DataFrame, required=("interacts",)) -> None:
    """Raise if an edge weight is invalid or a required edge type is empty."""
    bad = edge_findings(edges, required).where("bad_weights > 0 or missing").collect()
    if bad:
        raise ValueError("; ".join(f"{r.edge_type}: {r.edges} edges, {r.bad_weights} bad weights" for r in bad))


def negative_samples(positives: DataFrame, products: DataFrame, fitment: DataFrame, ownership: DataFrame,
                     mix=(0.5, 0.3, 0.2), seed: int = 42) -> DataFrame:
    """One negative per positive: in-batch, fitment-hard (not the positive) or uniform.

    The positives are put in a seeded order; the first int(n * share) take a product of
    another positive, the next ones a product of an owned entity, the rest any product.
    Every draw is an index computed from a hash, resolved by an equi-join on that index.
    """
    if abs(sum(mix) - 1.0) > 1e-9:
        raise ValueError("negative mix must sum to 1")
    pos = shared(rank_by_hash(positives.select("user_id", "product_id").distinct(), [], ["user_id", "product_id"], seed))
    n_batch = F.floor(F.col("pos_n") * F.lit(mix[0]))
    n_fit = F.floor(F.col("pos_n") * F.lit(mix[1]))
    rows = pos.withColumn("mode", F.when(F.col("pos") < n_batch, "in_batch").when(F.col("pos") < n_batch + n_fit, "fitment_hard").otherwise("random"))
    items = rank_by_hash(products.select("product_id").distinct(), [], ["product_id"], seed + 1, "ix")
    total = items.agg(F.max("ix_n")).scalar()
    rows = rows.withColumns({"_rand": pick(total, F.col("user_id"), F.col("product_id"), F.lit(seed + 2)),
                             "_perm": pick(F.col("pos_n"), F.col("user_id"), F.col("product_id"), F.lit(seed + 3))})
    batch = rows.where("mode = 'in_batch'").join(pos.select(F.col("pos").alias("_perm"), F.col("product_id").alias("neg")), "_perm").select(
        "user_id", "product_id", "mode", "neg", "_rand")
    # fitment: one entity of the user, then an index among its products that skips the positive
    own = ownership.groupBy("user_id").agg(F.min_by("entity_id", F.xxhash64("entity_id", F.lit(seed))).alias("entity_id"))
    parts = rank_by_hash(fitment.select("entity_id", "product_id").distinct(), ["entity_id"], ["product_id"], seed + 4, "ix")
    sizes = parts.groupBy("entity_id").agg(F.max("ix_n").alias("_m"))
    fit = rows.where("mode = 'fitment_hard'").join(own, "user_id", "left").join(sizes, "entity_id", "left")
    fit = fit.join(parts.select("entity_id", "product_id", F.col("ix").alias("_own")), ["entity_id", "product_id"], "left")
    room = F.col("_m") - F.when(F.col("_own").isNotNull(), 1).otherwise(0)
    i = F.when(room > 0, pick(F.greatest(room, F.lit(1)), F.col("user_id"), F.col("product_id"), F.lit(seed + 5)))
    fit = fit.withColumn("ix", i + F.when(F.col("_own").isNotNull() & (i >= F.col("_own")), 1).otherwise(0))
    fit = fit.join(parts.select("entity_id", "ix", F.col("product_id").alias("neg")), ["entity_id", "ix"], "left").select(
        "user_id", "product_id", "mode", "neg", "_rand")
    rest = rows.where("mode = 'random'").select("user_id", "product_id", "mode", F.lit(None).cast(products.schema["product_id"].dataType).alias("neg"), "_rand")
    out = batch.unionByName(fit).unionByName(rest)
    lookup = items.select(F.col("ix").alias("_rand"), F.col("product_id").alias("_any"))
    return out.join(lookup, "_rand", "left").select("user_id", "product_id", "mode", F.coalesce("neg", "_any").alias("negative_id"))


def bpr_loss(pairs: DataFrame) -> DataFrame:
    """Weighted -log sigmoid(pos - neg), normalised by the weight sum."""
    gap = F.col("pos_score") - F.col("neg_score")
    # log1p(exp(-x)) without overflow
    loss = F.greatest(-gap, F.lit(0.0)) + F.log1p(F.exp(-F.abs(gap)))
    return pairs.agg((F.sum(F.col("weight") * loss) / F.greatest(F.sum("weight"), F.lit(EPS))).alias("loss"))


def degrees(edges: DataFrame) -> DataFrame:
    """Distribution of out-degrees per edge type."""
    return edges.groupBy("edge_type", "src").agg(F.count(F.lit(1)).alias("degree")).groupBy("edge_type", "degree").agg(
        F.count(F.lit(1)).alias("nodes"))


def cold_coverage(users: DataFrame, interactions: DataFrame, ownership: DataFrame) -> DataFrame:
    """Per tier the users, those without interactions, and those of them that own an entity."""
    i = interactions.select("user_id").distinct().withColumn("_i", F.lit(True))
    o = ownership.select("user_id").distinct().withColumn("_o", F.lit(True))
    rows = users.join(i, "user_id", "left").join(o, "user_id", "left")
    return rows.groupBy("tier").agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col("_i").isNull()).alias("cold"),
                                    F.count_if(F.col("_i").isNull() & F.col("_o").isNotNull()).alias("cold_with_entity"))


def vector_sum(vec: Column) -> Column:
    """Aggregate: the element-wise sum of arrays of one length, combined map-side as one vector."""
    return vector_to_array(Summarizer.metrics("sum").summary(array_to_vector(vec))["sum"])


def propagate(embeddings: DataFrame, edges: DataFrame, hops: int = 2, skip: float = 0.5) -> DataFrame:
    """Weighted neighbour means per edge type plus a skip term, L2-normalised, repeated.

    ``embeddings``: node_id, vec. A neighbourhood is summed as one vector per (node, edge type), combined
    map-side, so at most a row an edge is shuffled and a node with very many neighbours is no hot task.
    """
    cur = embeddings.select("node_id", F.col("vec").cast("array<double>").alias("vec"))
    for _ in range(hops):
        msg = edges.join(cur.withColumnRenamed("node_id", "src"), "src").select(
            "dst", "edge_type", F.col("weight").cast("double").alias("weight"), F.transform("vec", lambda x: x * F.col("weight")).alias("vec"))
        mean = msg.groupBy("dst", "edge_type").agg(vector_sum(F.col("vec")).alias("vec"), F.greatest(F.sum("weight"), F.lit(EPS)).alias("w"))
        mean = mean.select("dst", F.transform("vec", lambda x: x / F.col("w")).alias("vec"))
        total = mean.groupBy(F.col("dst").alias("node_id")).agg(vector_sum(F.col("vec")).alias("nb"))
        joined = cur.join(total, "node_id", "left")
        mixed = F.when(F.col("nb").isNull(), F.col("vec")).otherwise(F.zip_with("vec", "nb", lambda a, b: a * F.lit(skip) + b))
        rows = joined.select("node_id", mixed.alias("vec"))
        norm = F.sqrt(X.dot("vec", "vec"))
        cur = rows.select("node_id", F.transform("vec", lambda a: a / F.greatest(norm, F.lit(EPS))).alias("vec"))
    return cur


def factorize(interactions: DataFrame, rank: int = 16, iterations: int = 5, seed: int = 42):
    """Implicit-feedback matrix factorisation on weighted interactions; returns the fitted model.

    ALS wants integer ids: dense ids are assigned here and come back as two mapping frames.
    """
    from pyspark.ml.recommendation import ALS

    u = dense_ids(interactions, "user_id", "_u")
    i = dense_ids(interactions, "product_id", "_i")
    rows = interactions.groupBy("user_id", "product_id").agg(F.sum("weight").cast("float").alias("weight"))
    rows = rows.join(u, "user_id").join(i, "product_id").select(F.col("_u").cast("int").alias("u"), F.col("_i").cast("int").alias("i"), "weight")
    als = ALS(rank=rank, maxIter=iterations, implicitPrefs=True, userCol="u", itemCol="i", ratingCol="weight", seed=seed,
              coldStartStrategy="drop", checkpointInterval=5)
    return als.fit(rows), u, i


def interaction_weight(kind, column=None, hook: Column | None = None) -> Column:
    """Weight by hook, else by the weight column, else 1."""
    parts = [hook] if hook is not None else []
    parts += [X.col(column)] if column is not None else []
    return F.coalesce(*parts, F.lit(1.0))
