"""Graph, slot and embedding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.indexing import dense_ids
from ..operators import candidates as C
from ..operators import copurchase as CP
from ..operators import graph as G
from ..operators import slots as S
from ..sources.bags import pivot_attributes
from .registry import once, query
from .sql_views import VIEWS, norm

HALF = "exp(-ln(2) * date_diff('day', CAST(event_ts AS DATE), DATE '2024-01-20') / 30.0)"
VIEWS.update({
    "g_products": f"""
SELECT p.sku, p.base_sku, c.category, p.price, ln(1 + coalesce(o.n, 0)) AS log_popularity, coalesce(f.n, 0) AS breadth, c.size <= 5 AS is_universal
FROM (SELECT {norm('sku')} AS base_sku, min(sku) AS sku, max(price) AS price FROM v_catalog WHERE price >= 905 GROUP BY 1) p
JOIN v_catalog c ON c.sku = p.sku AND lower(c.tags) NOT LIKE '%refurbished%'
LEFT JOIN (SELECT {norm('sku')} AS b, count(*) AS n FROM v_orders GROUP BY 1) o ON o.b = p.base_sku
LEFT JOIN (SELECT {norm('sku')} AS b, count(DISTINCT make) AS n FROM v_fitment GROUP BY 1) f ON f.b = p.base_sku""",
    "g_inter": f"""
SELECT user_id, {norm('sku')} AS base_sku, type, event_ts, CASE type WHEN 'view' THEN 1 WHEN 'cart' THEN 3 ELSE 5 END * {HALF} AS weight
FROM (SELECT DISTINCT user_id, sku, event_ts, CASE event_name WHEN 'VIEWED PRODUCT' THEN 'view' WHEN 'CART UPDATE' THEN 'cart' ELSE 'order' END AS type FROM v_staged) e
WHERE CAST(event_ts AS DATE) <= DATE '2024-01-20' AND user_id IN (SELECT user_id FROM v_users) AND {norm('sku')} IN (SELECT base_sku FROM g_products)""",
    "g_vehicles": f"""
SELECT u.make, u.n AS user_count, coalesce(f.n, 0) AS product_count FROM (SELECT seg_make AS make, count(*) AS n FROM v_users GROUP BY 1) u
LEFT JOIN (SELECT make, count(DISTINCT {norm('sku')}) AS n FROM v_fitment GROUP BY 1) f ON f.make = u.make""",
    "g_edges": """
SELECT 'u' || user_id AS src, 'p' || base_sku AS dst, 'interacts' AS edge_type, weight FROM g_inter
UNION ALL SELECT 'p' || base_sku, 'u' || user_id, 'rev_interacts', weight FROM g_inter
UNION ALL SELECT 'p' || base_sku, 'm' || make, 'fits', 1.0 FROM g_fit UNION ALL SELECT 'm' || make, 'p' || base_sku, 'rev_fits', 1.0 FROM g_fit
UNION ALL SELECT 'u' || user_id, 'm' || seg_make, 'owns', 1.0 FROM v_users UNION ALL SELECT 'm' || seg_make, 'u' || user_id, 'rev_owns', 1.0 FROM v_users
UNION ALL SELECT 'p' || item_a, 'p' || item_b, 'co_purchased', weight FROM g_pmi UNION ALL SELECT 'p' || item_b, 'p' || item_a, 'co_purchased', weight FROM g_pmi""",
    "g_fit": f"""
SELECT DISTINCT {norm('sku')} AS base_sku, make FROM v_fitment WHERE {norm('sku')} IN (SELECT base_sku FROM g_products)""",
    "g_pmi": f"""
SELECT item_a, item_b, co_count, pmi, weight FROM (SELECT *, row_number() OVER (PARTITION BY item_a ORDER BY co_count DESC, item_b) AS ra,
  row_number() OVER (PARTITION BY item_b ORDER BY co_count DESC, item_a) AS rb FROM (
  SELECT a.b AS item_a, b.b AS item_b, count(*) AS co_count, ln(count(*) * any_value(t.n) / (any_value(fa.n) * any_value(fb.n))) AS pmi, ln(1 + count(*)) AS weight
  FROM g_items a JOIN g_items b ON a.order_id = b.order_id AND a.b < b.b
  JOIN (SELECT b AS k, count(*) AS n FROM g_items GROUP BY 1) fa ON fa.k = a.b JOIN (SELECT b AS k, count(*) AS n FROM g_items GROUP BY 1) fb ON fb.k = b.b,
  (SELECT count(DISTINCT order_id) AS n FROM g_items) t GROUP BY ALL HAVING count(*) >= 3) x WHERE pmi > 0) y WHERE ra <= 5 OR rb <= 5""",
    "g_items": f"""
SELECT DISTINCT order_id, {norm('sku')} AS b FROM v_orders WHERE {norm('sku')} IN (SELECT base_sku FROM g_products)""",
    "e_users": "SELECT vec_id AS user_id, embedding AS vec FROM embeddings WHERE label = 0",
    "e_products": "SELECT vec_id AS product_id, embedding AS vec, label FROM embeddings WHERE label > 0",
    "e_scores": """
SELECT u.user_id, p.product_id, p.label, list_sum(list_transform(range(1, 65), lambda i: CAST(u.vec[i] AS DOUBLE) * CAST(p.vec[i] AS DOUBLE))) AS score
FROM e_users u CROSS JOIN e_products p""",
})


@once
def products(t):
    return G.product_nodes(t.catalog.withColumn("is_universal", F.col("size") <= 5), t.orders, t.fitment, ["make"], 905.0)


@once
def vehicles(t):
    return G.vehicle_nodes(t.users.select("user_id", F.col("seg_make").alias("make")), t.fitment, ["make"])


@once
def interactions(t):
    kind = F.when(F.col("event_name") == "VIEWED PRODUCT", "view").when(F.col("event_name") == "CART UPDATE", "cart").otherwise("order")
    return G.interaction_edges(t.staged.withColumn("type", kind), t.users, products(t), "2024-01-20")


@once
def pmi(t):
    items = t.orders.select("order_id", X.normalize_variant("sku").alias("base_sku"))
    return CP.copurchase_pmi(items, products(t), 3, 5)


def tag(prefix, c):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


@once
def tiers(t):
    return t.users.select("user_id", F.when(F.col("balance") < 0, None).when(F.col("balance") < 3000, "Cold").when(F.col("balance") < 7000, "warm").otherwise("hot").alias("tier"))


@once
def edges(t):
    u = t.users.select(tag("u", "user_id").alias("user_id"))
    pr = products(t).select(tag("p", "base_sku").alias("product_id"))
    inter = interactions(t).select(tag("u", "user_id").alias("user_id"), tag("p", "base_sku").alias("product_id"), "weight")
    fit = G.fitment_edges(t.fitment, products(t), vehicles(t), ["make"]).select(tag("p", "base_sku").alias("product_id"), tag("m", "make").alias("entity_id"))
    own = t.users.select(tag("u", "user_id").alias("user_id"), tag("m", "seg_make").alias("entity_id"))
    cop = pmi(t).select(tag("p", "item_a").alias("product_a"), tag("p", "item_b").alias("product_b"), "weight")
    split = G.stratified_split(tiers(t)).select(tag("u", "user_id").alias("user_id"), "split")
    return G.build_edges(inter, fit, own, cop, u, pr, split)


@query("G01 S06", "email make model year has_consent:b tier", """
SELECT email, upper(seg_make) AS make, CASE WHEN balance < 0 THEN '' WHEN upper(seg_model) > 'OLD' THEN upper(seg_model) ELSE 'OLD' END AS model,
  greatest('19x9', CAST(seg_year AS VARCHAR)) AS year, balance > 7500 AS has_consent, 'cold' AS tier FROM v_users WHERE balance >= 0""")
def user_nodes(t):
    return G.user_nodes(t.attributes)


@query("S06", "user_id:l v1_year v1_make v1_model", """
SELECT user_id, CAST(seg_year AS VARCHAR) AS v1_year, upper(seg_make) AS v1_make, CASE WHEN balance < 0 THEN '' WHEN upper(seg_model) > 'OLD' THEN upper(seg_model) ELSE 'OLD' END AS v1_model FROM v_users""")
def pivot_attributes_max(t):
    return pivot_attributes(t.attributes, ["v1_year", "v1_make", "v1_model"])


@query("G02", "sku base_sku category price:d2 log_popularity:d6 breadth:l is_universal:b", "SELECT * FROM g_products")
def product_nodes(t):
    return products(t)


@query("G03", "make user_count:l product_count:l", "SELECT * FROM g_vehicles")
def vehicle_nodes(t):
    return vehicles(t)


@query("G04", "user_id:l base_sku type event_ts weight:d6", "SELECT user_id, base_sku, type, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, weight FROM g_inter")
def interaction_edges(t):
    return interactions(t).withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("G05", "kind a b", "SELECT 'fits' AS kind, base_sku AS a, make AS b FROM g_fit UNION ALL SELECT 'owns', CAST(user_id AS VARCHAR), seg_make FROM v_users")
def fitment_and_ownership_edges(t):
    f = G.fitment_edges(t.fitment, products(t), vehicles(t), ["make"]).select(F.lit("fits").alias("kind"), F.col("base_sku").alias("a"), F.col("make").alias("b"))
    o = G.ownership_edges(t.users.withColumnRenamed("seg_make", "make"), vehicles(t), ["make"])
    return f.unionByName(o.select(F.lit("owns").alias("kind"), F.col("user_id").cast("string").alias("a"), F.col("make").alias("b")))


@query("G06 J08 T03", "item_a item_b co_count:l pmi:d6 weight:d6", "SELECT * FROM g_pmi")
def copurchase_pmi(t):
    return pmi(t)


@query("G07", "part n:l users:l skus:l", f"""
SELECT 'train' AS part, count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT sku) AS skus FROM v_orders WHERE order_date <= DATE '2001-07-02'
UNION ALL SELECT 'test', count(*), count(DISTINCT user_id), count(DISTINCT b) FROM (SELECT DISTINCT user_id, {norm('sku')} AS b FROM v_orders
  WHERE order_date > DATE '2001-07-02' AND order_date <= DATE '2001-08-01') a""")
def temporal_split(t):
    train, test = G.temporal_split(t.orders, "2001-08-01")

    def stats(df, name, sku):
        return df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.count_distinct(sku).alias("skus"))

    return stats(train, "train", "sku").unionByName(stats(test, "test", "base_sku"))


@query("G07", "user_id:l base_sku", f"SELECT DISTINCT user_id, {norm('sku')} AS base_sku FROM v_orders WHERE order_date > DATE '2001-07-02' AND order_date <= DATE '2001-08-01'")
def test_interactions(t):
    return G.temporal_split(t.orders, "2001-08-01")[1]


@query("G08", "user_id:l base_sku", f"SELECT DISTINCT user_id, {norm('sku')} AS base_sku FROM v_orders WHERE order_date > DATE '2000-08-01' AND order_date <= DATE '2001-08-01'")
def recent_purchases(t):
    return G.recent_purchases(t.orders, "2001-08-01")


@query("G09", "base_sku price_z:d6 log_popularity_z:d6 breadth_z:d6", """
SELECT base_sku, (price - avg(price) OVER ()) / (stddev_pop(price) OVER () + 1e-8) AS price_z,
  (log_popularity - avg(log_popularity) OVER ()) / (stddev_pop(log_popularity) OVER () + 1e-8) AS log_popularity_z,
  (breadth - avg(breadth) OVER ()) / (stddev_pop(breadth) OVER () + 1e-8) AS breadth_z FROM g_products""")
def zscore_features(t):
    return G.zscore(products(t), ["price", "log_popularity", "breadth"])[0]


@query("G10", "sku category label_id:l", """
SELECT sku, c AS category, dense_rank() OVER (ORDER BY c) - 1 AS label_id FROM (SELECT sku, CASE WHEN size = 7 THEN 'UNKNOWN' ELSE category END AS c FROM v_catalog) a""")
def encode_labels(t):
    return G.encode_labels(t.catalog.select("sku", F.when(F.col("size") != 7, F.col("category")).alias("category")), "category")


@query("G11", "tier_name split n:l", """
WITH s AS (SELECT t, count(*) AS n, CAST(floor(count(*) * 0.8) AS BIGINT) AS a, CAST(floor(count(*) * 0.1) AS BIGINT) AS b FROM (
  SELECT CASE WHEN balance < 0 THEN 'unknown' WHEN balance < 3000 THEN 'cold' WHEN balance < 7000 THEN 'warm' ELSE 'hot' END AS t FROM v_users) x GROUP BY 1)
SELECT t AS tier_name, 'train' AS split, a AS n FROM s UNION ALL SELECT t, 'val', b FROM s UNION ALL SELECT t, 'test', n - a - b FROM s""")
def stratified_split(t):
    rows = G.stratified_split(tiers(t)).withColumn("tier_name", F.lower(F.coalesce("tier", F.lit("unknown"))))
    return rows.groupBy("tier_name", "split").agg(F.count(F.lit(1)).alias("n"))


@query("G12", "sku id:l", "SELECT sku, row_number() OVER (ORDER BY sku) - 1 AS id FROM v_catalog")
def dense_sku_ids(t):
    return dense_ids(t.catalog, "sku")


@query("G13", "edge_type n:l src_nodes:l dst_nodes:l weight:d4", """
SELECT edge_type, count(*) AS n, count(DISTINCT src) AS src_nodes, count(DISTINCT dst) AS dst_nodes, sum(weight) AS weight FROM g_edges GROUP BY 1""")
def graph_edges(t):
    return edges(t).groupBy("edge_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("src").alias("src_nodes"),
                                             F.count_distinct("dst").alias("dst_nodes"), F.sum("weight").alias("weight"))


@query("G14", "edge_type edges:l bad_weights:l required:b missing:b", """
SELECT edge_type, count(*) AS edges, 0 AS bad_weights, edge_type IN ('interacts', 'fits') AS required, FALSE AS missing FROM g_edges GROUP BY 1
UNION ALL SELECT 'similar', 0, 0, TRUE, TRUE""")
def edge_findings(t):
    return G.edge_findings(edges(t), ("interacts", "fits", "similar"))


@query("G15", "mode n:l hard_is_positive:l no_negative:l", """
SELECT mode, n, 0 AS hard_is_positive, 0 AS no_negative FROM (
  SELECT 'in_batch' AS mode, floor(m * 0.5) AS n FROM pos UNION ALL SELECT 'fitment_hard', floor(m * 0.3) FROM pos
  UNION ALL SELECT 'random', m - floor(m * 0.5) - floor(m * 0.3) FROM pos) a WHERE n > 0""",
       "pos AS (SELECT count(*) AS m FROM (SELECT DISTINCT user_id, base_sku FROM g_inter) d)")
def negative_samples(t):
    pos = interactions(t).select("user_id", F.col("base_sku").alias("product_id"))
    fit = G.fitment_edges(t.fitment, products(t), vehicles(t), ["make"]).select(F.col("base_sku").alias("product_id"), F.col("make").alias("entity_id"))
    own = t.users.select("user_id", F.col("seg_make").alias("entity_id"))
    rows = G.negative_samples(pos, products(t).select(F.col("base_sku").alias("product_id")), fit, own)
    return rows.groupBy("mode").agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("mode") == "fitment_hard") & (F.col("negative_id") == F.col("product_id"))).alias("hard_is_positive"),
                                    F.count_if(F.col("negative_id").isNull()).alias("no_negative"))


@query("G16", "loss:d6", """
SELECT sum(weight * ln(1 + exp(-(p - n)))) / greatest(sum(weight), 1e-8) AS loss FROM (
  SELECT i.weight, g.total AS p, s.rank_in_segment / 10.0 AS n FROM g_inter i JOIN (SELECT sku, ln(1 + total_orders) AS total FROM v_glob) g ON g.sku = i.base_sku
  JOIN v_users u ON u.user_id = i.user_id JOIN v_seg s ON s.seg_make = u.seg_make AND s.seg_model = u.seg_model AND s.sku = i.base_sku) a""")
def bpr_loss(t):
    from . import recs
    seg, _, glob = recs.tiers(t)
    rows = interactions(t).join(glob.select(F.col("sku").alias("base_sku"), F.log1p("total_orders").alias("pos_score")), "base_sku")
    rows = rows.join(t.users, "user_id").join(seg.withColumnRenamed("sku", "base_sku"), ["seg_make", "seg_model", "base_sku"])
    return G.bpr_loss(rows.withColumn("neg_score", F.col("rank_in_segment") / 10.0))


@query("G17", "edge_type degree:l nodes:l", """
SELECT edge_type, degree, count(*) AS nodes FROM (SELECT edge_type, src, count(*) AS degree FROM g_edges GROUP BY ALL) a GROUP BY ALL""")
def degree_distribution(t):
    return G.degrees(edges(t))


@query("G17 O03", "tier users:l cold:l cold_with_entity:l", """
SELECT CASE WHEN balance < 0 THEN NULL WHEN balance < 3000 THEN 'Cold' WHEN balance < 7000 THEN 'warm' ELSE 'hot' END AS tier, count(*) AS users,
  count(*) FILTER (user_id NOT IN (SELECT user_id FROM g_inter)) AS cold, count(*) FILTER (user_id NOT IN (SELECT user_id FROM g_inter) AND seg_year < 2005) AS cold_with_entity
FROM v_users GROUP BY 1""")
def cold_coverage(t):
    return G.cold_coverage(tiers(t), interactions(t), t.users.where("seg_year < 2005"))


def _hop(name: str, source: str) -> str:
    """One propagation step over rows (node_id, i, x)."""
    return f"""{name} AS (SELECT node_id, i, x / greatest(sqrt(sum(x * x) OVER (PARTITION BY node_id)), 1e-12) AS x FROM (
  SELECT c.node_id, c.i, CASE WHEN n.x IS NULL THEN c.x ELSE c.x * 0.5 + n.x END AS x FROM {source} c LEFT JOIN (
    SELECT dst, i, sum(x) AS x FROM (SELECT r.dst, r.kind, s.i, sum(r.weight * s.x) / sum(r.weight) AS x FROM ring r JOIN {source} s ON s.node_id = r.src GROUP BY ALL) m
    GROUP BY ALL) n ON n.dst = c.node_id AND n.i = c.i) z)"""


HOPS = """hop0 AS (SELECT vec_id AS node_id, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
one AS (SELECT vec_id AS src, vec_id + label + 1 AS dst, label + 1.0 AS weight FROM embeddings),
ring AS (SELECT src, dst, 'next' AS kind, weight FROM one UNION ALL SELECT dst, src, 'rev_next', weight FROM one), """ + _hop("hop1", "hop0") + ", " + _hop("hop2", "hop1")


@query("G18", "node_id:l dims:l first:d6 last:d6 norm:d4", """
SELECT node_id, count(*) AS dims, arg_min(x, i) AS first, arg_max(x, i) AS last, sqrt(sum(x * x)) AS norm FROM hop2 GROUP BY 1""", HOPS)
def propagate_embeddings(t):
    nodes = t.raw("embeddings").select(F.col("vec_id").alias("node_id"), F.col("embedding").alias("vec"), "label")
    ring = nodes.select(F.col("node_id").alias("src"), (F.col("node_id") + F.col("label") + 1).alias("dst"), F.lit("next").alias("edge_type"),
                        (F.col("label") + 1.0).alias("weight"))
    out = G.propagate(nodes, ring.unionByName(ring.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit("rev_next").alias("edge_type"), "weight")))
    return out.select("node_id", F.size("vec").alias("dims"), F.element_at("vec", 1).alias("first"), F.element_at("vec", -1).alias("last"), F.sqrt(X.dot("vec", "vec")).alias("norm"))


@query("G19", "user_id:l factors:l", "SELECT DISTINCT user_id, 8 AS factors FROM g_inter")
def factorize(t):
    rows = interactions(t).select("user_id", F.col("base_sku").alias("product_id"), "weight")
    model, u, _ = G.factorize(rows, 8, 3)
    return model.userFactors.join(u.withColumnRenamed("_u", "id"), "id").select("user_id", F.size("features").alias("factors"))


@query("G20", "type n:l weight:d2 hooked:d2", """
SELECT type, count(*) AS n, sum(coalesce(CASE WHEN price > 50 THEN price END, 1)) AS weight,
  sum(coalesce(CASE type WHEN 'order' THEN 5 WHEN 'cart' THEN 3 END, CASE WHEN price > 50 THEN price END, 1)) AS hooked
FROM (SELECT user_id, CAST(price AS DECIMAL(12,2)) AS price, CASE event_name WHEN 'VIEWED PRODUCT' THEN 'view' WHEN 'CART UPDATE' THEN 'cart' ELSE 'order' END AS type FROM v_staged) a GROUP BY type""")
def interaction_weight(t):
    kind = F.when(F.col("event_name") == "VIEWED PRODUCT", "view").when(F.col("event_name") == "CART UPDATE", "cart").otherwise("order")
    rows = t.staged.withColumns({"type": kind, "w": F.when(F.col("price") > 50, F.col("price"))})
    hook = F.when(F.col("type") == "order", 5.0).when(F.col("type") == "cart", 3.0)
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum(G.interaction_weight("type", "w")).alias("weight"),
                                    F.sum(G.interaction_weight("type", "w", hook)).alias("hooked"))


@query("G21", "user_id:l hashed", "SELECT user_id, substr(sha256(concat('pepper:', lower(trim(email)))), 1, 16) AS hashed FROM v_users")
def normalize_ids(t):
    return t.users.select("user_id", X.salted_id(F.concat(F.lit(" "), F.upper("email")), "pepper").alias("hashed"))


# ---- engine rules on embeddings ------------------------------------------------------
def _category(label):
    return F.concat(F.lit("c"), (F.col(label) % 3).cast("string"))


@once
def engine_products(t):
    """Products are the labelled vectors: category label % 3, popularity label + id / 1000, every label-9 product excluded."""
    return t.product_vectors.select("product_id", _category("label").alias("category"),
                                    (F.col("label") + F.col("product_id") / 100000.0).alias("popularity"), (F.col("label") == 9).alias("is_excluded"), "label", "vec")


@once
def engine_fitment(t):
    return engine_products(t).select("product_id", (F.col("label") % 5).alias("entity_id"))


@once
def engine_ownership(t):
    """Users own the entity of their id; users with a positive first component own a second one; a large second component means none."""
    u = F.col("user_id")
    two = F.array(u % 5, (u + 1) % 5)
    return t.user_vectors.where(F.col("vec")[1] <= 0.1).select("user_id", F.explode(F.when(F.col("vec")[0] > 0, two).otherwise(F.array(u % 5))).alias("entity_id")).select(
        "user_id", F.col("entity_id").cast("int").alias("entity_id"))


VIEWS.update({
    "n_products": "SELECT product_id, 'c' || (label % 3) AS category, label + product_id / 100000.0 AS popularity, label = 9 AS is_excluded, label, vec[1] AS v1 FROM e_products",
    "n_fit": "SELECT product_id, label % 5 AS entity_id FROM e_products",
    "n_own": "SELECT user_id, user_id % 5 AS entity_id FROM e_users WHERE vec[2] <= 0.1 UNION ALL SELECT user_id, (user_id + 1) % 5 FROM e_users WHERE vec[2] <= 0.1 AND vec[1] > 0",
    "n_cand": "SELECT DISTINCT o.user_id, f.product_id FROM n_own o JOIN n_fit f ON f.entity_id = o.entity_id JOIN n_products p ON p.product_id = f.product_id AND NOT p.is_excluded",
})


@query("J16", "user_id:l product_id:l", "SELECT DISTINCT o.user_id, f.product_id FROM n_own o JOIN n_fit f ON f.entity_id = o.entity_id")
def two_hop(t):
    return C.two_hop(engine_ownership(t), engine_fitment(t))


@query("D51", "user_id:l candidates:l", """
SELECT user_id, count(*) AS candidates FROM n_cand GROUP BY 1
UNION ALL SELECT user_id, (SELECT count(*) FROM n_products WHERE NOT is_excluded) FROM e_users WHERE user_id NOT IN (SELECT user_id FROM n_cand)""")
def candidate_counts(t):
    own = C.candidate_totals(engine_ownership(t), engine_fitment(t), engine_products(t))
    rest = C.unfitted_users(t.user_vectors.select("user_id"), own)
    n = engine_products(t).where(~F.col("is_excluded")).agg(F.count(F.lit(1))).scalar()
    return own.unionByName(rest.withColumn("candidates", n))


@once
def scores(t):
    return C.pair_scores(engine_ownership(t), engine_fitment(t), engine_products(t), t.user_vectors, t.product_vectors)


@query("D50", "user_id:l product_id:l score:d6", "SELECT s.user_id, s.product_id, s.score FROM e_scores s JOIN n_cand c ON c.user_id = s.user_id AND c.product_id = s.product_id")
def embedding_score(t):
    return scores(t)


@query("D49", "user_id:l product_id:l score:d6", """
SELECT user_id, label AS product_id, max(score) AS score FROM (SELECT s.*, s.user_id AS u FROM e_scores s JOIN n_cand c ON c.user_id = s.user_id AND c.product_id = s.product_id) a GROUP BY ALL""")
def merge_entity_scores(t):
    rows = C.best_of_groups(engine_ownership(t), engine_fitment(t), engine_products(t), t.user_vectors, t.product_vectors, "label", 1)
    return C.merge_entity_scores(rows.select("user_id", F.col("label").alias("product_id"), "score"))


@query("T04 D50", "user_id:l rank:l product_id:l score:d6", """
SELECT * FROM (SELECT user_id, product_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS rank FROM e_scores) a WHERE rank <= 10""")
def top_k_by_vector(t):
    return C.top_k_by_vector(t.user_vectors, t.product_vectors, 10)


@once
def bags(t):
    """Every user has bought the products of the label that equals the last digit of the user id (1 if 0), those with a positive first component."""
    users = t.user_vectors.withColumn("bag", F.greatest(F.col("user_id") % 10, F.lit(1)).cast("int"))
    return users, engine_products(t).withColumn("bag", F.when(F.col("vec")[0] > 0, F.col("label")))


CAP = 2


@once
def ranked(t):
    """The first rows of each user in every label; a label has one category and one pool, so no other row can be selected."""
    users, products = bags(t)
    rows = C.best_of_groups(engine_ownership(t), engine_fitment(t), products, users, t.product_vectors, "label", CAP, "bag")
    return rows.select("user_id", "product_id", _category("label").alias("category"), "score", (F.col("label") <= 5).alias("is_fitment"), (F.col("label") > 6).alias("is_special"))


@once
def selected(t):
    return S.slot_select(ranked(t), fitment_slots=2, special_slots=1, total=4, cap=CAP)


def _walk(name: str, start: str, items: str, limit: str) -> str:
    """SQL of a greedy walk: a recursive CTE with one step per candidate, which takes the candidate or passes on.

    ``start`` gives (user_id, taken), ``items`` (user_id, k, product_id, category, score, phase) with k = 1, 2, ...
    """
    return f"""{name}_items AS ({items}), {name}_walk AS (
  SELECT user_id, CAST(0 AS BIGINT) AS k, taken FROM ({start}) s
  UNION ALL
  SELECT w.user_id, w.k + 1, CASE WHEN {limit} AND len(list_filter(w.taken, lambda x: x.product_id = i.product_id)) = 0
      AND len(list_filter(w.taken, lambda x: x.category = i.category)) < 2
    THEN list_append(w.taken, {{'product_id': i.product_id, 'category': i.category, 'score': i.score, 'phase': i.phase}}) ELSE w.taken END
  FROM {name}_walk w JOIN {name}_items i ON i.user_id = w.user_id AND i.k = w.k + 1),
{name} AS (SELECT user_id, slot, e.product_id AS product_id, e.category AS category, e.score AS score, e.phase AS phase FROM (
  SELECT user_id, unnest(taken) AS e, generate_subscripts(taken, 1) AS slot FROM (
    SELECT user_id, taken, row_number() OVER (PARTITION BY user_id ORDER BY k DESC) AS rn FROM {name}_walk) z WHERE rn = 1) y)"""


TAKEN = "STRUCT(product_id BIGINT, category VARCHAR, score DOUBLE, phase INTEGER)[]"
SELECTED = """r AS (SELECT s.user_id, s.product_id, p.category, s.score, p.label <= 5 AS fit, p.label > 6 AS special
  FROM e_scores s JOIN n_cand c ON c.user_id = s.user_id AND c.product_id = s.product_id JOIN n_products p ON p.product_id = s.product_id
  WHERE NOT (p.v1 > 0 AND p.label = greatest(s.user_id % 10, 1))), """ + _walk(
    "sel", f"SELECT DISTINCT user_id, CAST([] AS {TAKEN}) AS taken FROM r", """
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY phase, score DESC, product_id) AS k, product_id, category, score, phase FROM (
    SELECT *, 1 AS phase FROM r WHERE fit UNION ALL SELECT *, 2 FROM r WHERE special AND NOT fit UNION ALL SELECT *, 3 FROM r) a""",
    "len(w.taken) < 4 AND len(list_filter(w.taken, lambda x: x.phase = i.phase)) < CASE i.phase WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 4 END")
# Fallback candidates in walking order: tier, turn of the user's entity or group, popularity.
FILLED = SELECTED + """, ok AS (SELECT DISTINCT f.entity_id, p.product_id, p.category, p.popularity FROM n_fit f JOIN n_products p ON p.product_id = f.product_id AND NOT p.is_excluded),
ent AS (SELECT DISTINCT entity_id, CASE WHEN entity_id < 2 THEN 'A' WHEN entity_id < 4 THEN 'B' ELSE '' END AS g FROM n_fit),
cand AS (
  SELECT o.user_id, 0 AS tier, o.entity_id AS turn, k.* EXCLUDE (entity_id) FROM n_own o JOIN ok k ON k.entity_id = o.entity_id
  UNION ALL SELECT DISTINCT u.user_id, 1, u.turn, k.* EXCLUDE (entity_id) FROM (
    SELECT o.user_id, e.g, min(o.entity_id) AS turn FROM n_own o JOIN ent e ON e.entity_id = o.entity_id WHERE e.g <> '' GROUP BY ALL) u JOIN ent e ON e.g = u.g JOIN ok k ON k.entity_id = e.entity_id
  UNION ALL SELECT DISTINCT u.user_id, 2, 0, k.* EXCLUDE (entity_id) FROM e_users u CROSS JOIN ok k), """ + _walk(
    "fil", f"""SELECT u.user_id, coalesce(s.taken, CAST([] AS {TAKEN})) AS taken FROM e_users u LEFT JOIN (
    SELECT user_id, list({{'product_id': product_id, 'category': category, 'score': score, 'phase': 0}} ORDER BY slot) AS taken
    FROM sel WHERE slot <= user_id % 5 GROUP BY user_id) s ON s.user_id = u.user_id""", """
  SELECT c.user_id, row_number() OVER (PARTITION BY c.user_id ORDER BY tier, turn, c.popularity DESC, c.product_id) AS k, c.product_id, c.category, 0.0 AS score, 9 AS phase
  FROM cand c JOIN n_products p ON p.product_id = c.product_id WHERE NOT (p.v1 > 0 AND p.label = greatest(c.user_id % 10, 1))""", "len(w.taken) < 4")


@query("D46", "user_id:l slot:l product_id:l category score:d6 phase:l", "SELECT * FROM sel", SELECTED)
def slot_select(t):
    return selected(t)


@query("D46", "user_id:l slot:l product_id:l score:d6", """
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS slot, product_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS rn FROM (
    SELECT s.user_id, s.product_id, s.score, row_number() OVER (PARTITION BY s.user_id, p.category ORDER BY s.score DESC, s.product_id) AS rc
    FROM e_scores s JOIN n_cand c ON c.user_id = s.user_id AND c.product_id = s.product_id JOIN n_products p ON p.product_id = s.product_id
    WHERE NOT (p.v1 > 0 AND p.label = greatest(s.user_id % 10, 1))) a WHERE rc <= 2) b WHERE rn <= 4""")
def slot_select_single_pool(t):
    """With one pool the greedy equals cap-then-top-n, which SQL can state."""
    return S.slot_select(ranked(t).withColumns({"is_fitment": F.lit(True), "is_special": F.lit(False)}), 4, 0, 4, CAP)


@once
def entities(t):
    return engine_fitment(t).select("entity_id").distinct().withColumn("group_id", F.when(F.col("entity_id") < 2, "A").when(F.col("entity_id") < 4, "B"))


@once
def pools(t):
    return S.popularity_pools(engine_products(t), engine_fitment(t), entities(t))


@query("D48", "level pool product_id:l category popularity:d6 depth:l", """
SELECT level, pool, product_id, category, popularity, row_number() OVER (PARTITION BY level, pool, category ORDER BY popularity DESC, product_id) AS depth FROM (
  SELECT 'entity' AS level, CAST(f.entity_id AS VARCHAR) AS pool, p.product_id, p.category, p.popularity FROM n_fit f JOIN n_products p ON p.product_id = f.product_id AND NOT p.is_excluded
  UNION ALL SELECT DISTINCT 'group', CASE WHEN f.entity_id < 2 THEN 'A' WHEN f.entity_id < 4 THEN 'B' ELSE '' END, p.product_id, p.category, p.popularity FROM n_fit f JOIN n_products p ON p.product_id = f.product_id AND NOT p.is_excluded
  UNION ALL SELECT DISTINCT 'global', '*', p.product_id, p.category, p.popularity FROM n_fit f JOIN n_products p ON p.product_id = f.product_id AND NOT p.is_excluded) a""")
def popularity_pools(t):
    return pools(t)


@once
def filled(t):
    short = selected(t).where("slot <= user_id % 5")
    users, products = bags(t)
    return S.popularity_fallback(short, t.user_vectors.select("user_id"), engine_ownership(t), entities(t), pools(t), users.select("user_id", "bag"), 4, CAP,
                                 bags=products.where("bag is not null").select("bag", "product_id"))


@query("D47", "user_id:l slot:l product_id:l category is_fallback:b", "SELECT user_id, slot, product_id, category, phase = 9 AS is_fallback FROM fil", FILLED)
def popularity_fallback(t):
    return filled(t)


@once
def engine_meta(t):
    """Names, links and prices of the products, one in seven left out."""
    pid = F.col("product_id")
    return t.product_vectors.where(pid % 7 != 0).select(
        pid, F.concat(F.lit("part "), pid.cast("string")).alias("name"), F.concat(F.lit("https://shop.example/"), pid.cast("string")).alias("url"),
        F.concat(F.lit("https://img.example/"), pid.cast("string")).alias("image_url"), (pid % 90 + 10).cast("double").alias("price"))


SLOT = ("rec{i}_product_id:l rec{i}_name rec{i}_url rec{i}_image_url rec{i}_price:d2 rec{i}_score:d6")
ROW = """max(CASE WHEN slot = {i} THEN product_id END) AS rec{i}_product_id, max(CASE WHEN slot = {i} THEN CASE WHEN product_id % 7 = 0 THEN '' ELSE 'part ' || product_id END END) AS rec{i}_name,
  max(CASE WHEN slot = {i} THEN CASE WHEN product_id % 7 = 0 THEN '' ELSE 'https://shop.example/' || product_id END END) AS rec{i}_url,
  max(CASE WHEN slot = {i} THEN CASE WHEN product_id % 7 = 0 THEN '' ELSE 'https://img.example/' || product_id END END) AS rec{i}_image_url,
  max(CASE WHEN slot = {i} THEN CASE WHEN product_id % 7 = 0 THEN 0 ELSE product_id % 90 + 10 END END) AS rec{i}_price, max(CASE WHEN slot = {i} THEN score END) AS rec{i}_score"""


@query("D53", "user_id:l " + " ".join(SLOT.format(i=i) for i in range(1, 5)) + " rec_count:l is_fallback:b fallback_start_idx:l model_version", f"""
SELECT user_id, {", ".join(ROW.format(i=i) for i in range(1, 5))}, count(*) AS rec_count, bool_or(phase = 9) AS is_fallback,
  coalesce(min(CASE WHEN phase = 9 THEN slot - 1 END), count(*)) AS fallback_start_idx, 'v1' AS model_version FROM fil GROUP BY user_id""", FILLED)
def fallback_provenance(t):
    return S.provenance(filled(t), engine_meta(t), 4, "v1")


@query("D52", "user_id:l product_id:l", f"""
SELECT DISTINCT o.user_id, c.part_id AS product_id FROM v_orders o JOIN v_catalog c ON {norm('c.sku')} = {norm('o.sku')} WHERE o.order_date >= DATE '2001-01-01'""")
def canonical_exclusion(t):
    return S.canonical_exclusion(t.orders.where("order_date >= date'2001-01-01'").withColumn("sku", F.lower("sku")),
                                 t.catalog.select(F.col("part_id").alias("product_id"), "sku"))


@query("D54 J07", "user_id:l", "SELECT user_id FROM v_users WHERE user_id IN (SELECT user_id FROM v_events) AND balance > 7500")
def target_users(t):
    return C.target_users(t.users.withColumn("has_consent", F.col("balance") > 7500), t.events.select("user_id"), consent=True)


@query("P12", "user_id:l n:l", """
SELECT s.user_id, count(*) AS n FROM e_scores s JOIN n_cand c ON c.user_id = s.user_id AND c.product_id = s.product_id JOIN n_products p ON p.product_id = s.product_id
WHERE NOT (p.v1 > 0 AND p.label = greatest(s.user_id % 10, 1)) AND p.category <> 'c1' GROUP BY 1""")
def post_rank_filter(t):
    """Users of one set of entities and one bag have the same rows, so the filter runs on these rows once and users get its count."""
    users, products = bags(t)
    owned = C.owned_sets(engine_ownership(t)).join(users.select("user_id", "bag"), "user_id")
    kinds = owned.select("_set", "bag").distinct()
    rows = C.set_products(owned, engine_fitment(t)).join(products.where(~F.col("is_excluded")).select("product_id", "category", F.col("bag").alias("_bag")), "product_id")
    rows = kinds.join(rows, "_set").where(~F.col("bag").eqNullSafe(F.col("_bag")))
    n = S.post_rank_filter(rows, F.col("category") != "c1").groupBy("_set", "bag").agg(F.count(F.lit(1)).alias("n"))
    return owned.join(n, ["_set", "bag"]).select("user_id", "n")
