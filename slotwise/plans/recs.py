"""Recommendation queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.indexing import durable
from ..functions.keyed import shared
from ..operators import candidates as C
from ..operators import copurchase as CP
from ..operators import eligibility as E
from ..operators import intent as I
from ..operators import popularity as P
from ..operators import ranking as R
from ..params import TEST_PARAMS as p
from ..sources import bags
from .registry import once, query
from .sql_views import VIEWS, norm

PROFILE = ("seg_make", "seg_model")

# ---- SQL side -----------------------------------------------------------------
IMG = ("CASE WHEN image_raw LIKE '//%' THEN concat('https:', image_raw) WHEN image_raw LIKE 'http://%' "
       "THEN regexp_replace(image_raw, '^http://', 'https://') ELSE image_raw END")
VIEWS.update({
    "v_products": f"""
SELECT sku, category, price, image_url FROM (SELECT *, {IMG} AS image_url FROM v_catalog) c
WHERE lower(tags) NOT LIKE '%refurbished%' AND image_url LIKE 'https://%' AND price >= 905""",
    "v_eligible": """
SELECT f.make, p.sku, p.category, p.price, p.image_url FROM v_fitment f JOIN v_products p ON f.sku = p.sku
WHERE f.make IN (SELECT f2.make FROM v_fitment f2 JOIN v_products p2 ON f2.sku = p2.sku GROUP BY f2.make HAVING count(*) >= 4)""",
    "v_hist": f"""
SELECT email, {norm('sku')} AS sku FROM v_imported WHERE order_date BETWEEN DATE '1995-01-01' AND DATE '2000-12-31'""",
    "v_recent": f"""
SELECT user_id, {norm('sku')} AS sku FROM v_staged WHERE event_name = 'PLACED ORDER'""",
    "v_seg": """
SELECT seg_make, seg_model, sku, total_segment_orders, round(ln(1 + total_segment_orders) * 10, 2) AS segment_score,
       row_number() OVER (PARTITION BY seg_make, seg_model ORDER BY total_segment_orders DESC, sku) AS rank_in_segment
FROM (SELECT seg_make, seg_model, sku, count(*) AS total_segment_orders FROM (
        SELECT u.seg_make, u.seg_model, h.sku FROM v_hist h JOIN v_users u ON h.email = u.email
        UNION ALL SELECT u.seg_make, u.seg_model, r.sku FROM v_recent r JOIN v_users u ON r.user_id = u.user_id) a
      GROUP BY ALL HAVING count(*) >= 2) b""",
    "v_make": """
SELECT seg_make, sku, total_make_orders, round(ln(1 + total_make_orders) * 8, 2) AS make_score,
       row_number() OVER (PARTITION BY seg_make ORDER BY total_make_orders DESC, sku) AS rank_in_make
FROM (SELECT seg_make, sku, CAST(sum(total_segment_orders) AS BIGINT) AS total_make_orders FROM v_seg
      GROUP BY seg_make, sku HAVING sum(total_segment_orders) >= 2) a""",
    "v_glob": """
SELECT sku, count(*) AS total_orders, ln(1 + count(*)) * 2 AS global_score FROM (
  SELECT sku FROM v_hist WHERE email IN (SELECT email FROM v_users)
  UNION ALL SELECT sku FROM v_recent WHERE user_id IN (SELECT user_id FROM v_users)) a GROUP BY sku""",
    "v_excl": f"""
SELECT DISTINCT user_id, {norm('sku')} AS sku FROM v_staged
WHERE event_name = 'PLACED ORDER' AND user_id IS NOT NULL AND CAST(event_ts AS DATE) BETWEEN DATE '2000-08-01' AND DATE '2024-01-20'
UNION SELECT u.user_id, {norm('i.sku')} FROM v_imported i JOIN v_users u ON i.email = u.email
WHERE i.order_date BETWEEN DATE '2000-08-01' AND DATE '2024-01-20'""",
    "v_tiers": f"""
SELECT pr.*, {norm('pr.sku')} AS norm_sku, {norm('pr.sku')} AS base_sku, s.rank_in_segment, m.rank_in_make,
  CASE WHEN coalesce(st.n, 0) >= 5 AND s.sku IS NOT NULL THEN s.segment_score
       WHEN coalesce(mt.n, 0) >= 20 AND m.sku IS NOT NULL THEN m.make_score ELSE coalesce(g.global_score, 0) END AS popularity,
  CASE WHEN coalesce(st.n, 0) >= 5 AND s.sku IS NOT NULL THEN 'segment'
       WHEN coalesce(mt.n, 0) >= 20 AND m.sku IS NOT NULL THEN 'make'
       WHEN g.sku IS NOT NULL THEN 'global' ELSE 'none' END AS popularity_source,
  s.sku IS NOT NULL OR m.sku IS NOT NULL OR g.sku IS NOT NULL AS has_signal
FROM (SELECT DISTINCT u.seg_make, u.seg_model, e.sku, e.category, e.price, e.image_url
      FROM v_users u JOIN v_eligible e ON u.seg_make = e.make) pr
LEFT JOIN v_seg s ON s.seg_make = pr.seg_make AND s.seg_model = pr.seg_model AND s.sku = {norm('pr.sku')}
LEFT JOIN v_make m ON m.seg_make = pr.seg_make AND m.sku = {norm('pr.sku')}
LEFT JOIN v_glob g ON g.sku = {norm('pr.sku')}
LEFT JOIN (SELECT seg_make, seg_model, sum(total_segment_orders) AS n FROM v_seg GROUP BY ALL) st
  ON st.seg_make = pr.seg_make AND st.seg_model = pr.seg_model
LEFT JOIN (SELECT seg_make, sum(total_make_orders) AS n FROM v_make GROUP BY ALL) mt ON mt.seg_make = pr.seg_make""",
    # every user x product row, the plain reading of the operator
    "v_cand": """
SELECT u.user_id, u.email, t.*, round(t.popularity, 2) AS final_score FROM v_users u
JOIN v_tiers t ON u.seg_make = t.seg_make AND u.seg_model = t.seg_model
LEFT JOIN v_excl x ON x.user_id = u.user_id AND x.sku = t.norm_sku WHERE x.sku IS NULL""",
    "v_dedup": """
SELECT * EXCLUDE (rv) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, base_sku ORDER BY final_score DESC, sku) AS rv
  FROM v_cand) a WHERE rv = 1""",
    "v_div": """
SELECT * EXCLUDE (rc) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY final_score DESC, sku) AS rc
  FROM v_dedup) a WHERE rc <= 2""",
    "v_top": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY final_score DESC, sku) AS rn,
  count(*) OVER (PARTITION BY user_id) AS n_all FROM v_div) a WHERE n_all >= 3 AND rn <= 4""",
    "v_wide": """
SELECT user_id, email, seg_make, seg_model, """ + ", ".join(
        f"max(CASE WHEN rn = {i} THEN {c} END) AS rec{i}_{'score' if c == 'final_score' else c}"
        for i in range(1, 5) for c in ("sku", "price", "final_score", "image_url", "popularity_source")) + """,
  count(*) AS rec_count FROM v_top GROUP BY ALL HAVING count(*) >= 3""",
    "v_long": " UNION ALL ".join(
        f"SELECT user_id, {i} AS slot, rec{i}_sku AS sku, rec{i}_price AS price, rec{i}_score AS score, "
        f"rec{i}_image_url AS image_url, rec{i}_popularity_source AS popularity_source FROM v_wide WHERE rec{i}_sku IS NOT NULL"
        for i in range(1, 5)),
    "v_pairs3": """
SELECT a.sku AS item_a, b.sku AS item_b, count(*) AS pair_count, ln(1 + count(*)) * 3 AS boost
FROM v_bask a JOIN v_bask b ON a.user_id = b.user_id AND a.order_date = b.order_date AND a.sku < b.sku
GROUP BY ALL HAVING count(*) >= 2""",
    "v_bask": """
SELECT DISTINCT o.user_id, o.order_date, o.sku FROM v_orders o
JOIN (SELECT user_id, order_date FROM v_orders GROUP BY ALL HAVING count(DISTINCT sku) BETWEEN 2 AND 10) k
  ON o.user_id = k.user_id AND o.order_date = k.order_date""",
    "v_intent": """
SELECT user_id, sku, CASE WHEN o > 0 THEN ln(1 + o) * 20 WHEN c > 0 THEN ln(1 + c) * 10 WHEN v > 0 THEN ln(1 + v) * 2 ELSE 0 END AS intent,
  CASE WHEN o > 0 THEN 'order' WHEN c > 0 THEN 'cart' WHEN v > 0 THEN 'view' ELSE 'none' END AS intent_type
FROM (SELECT user_id, sku, count(*) FILTER (event_name = 'PLACED ORDER') AS o, count(*) FILTER (event_name = 'CART UPDATE') AS c,
        count(*) FILTER (event_name = 'VIEWED PRODUCT') AS v FROM v_staged GROUP BY ALL) a""",
    "v_decay": """
SELECT user_id, sku, sum(CASE event_name WHEN 'PLACED ORDER' THEN 20 WHEN 'CART UPDATE' THEN 10 ELSE 2 END
  * pow(0.5, date_diff('day', CAST(event_ts AS DATE), DATE '2024-01-31') / 30.0)) AS intent FROM v_staged GROUP BY ALL""",
    "v_breadth": """
SELECT sku, n AS breadth, CASE WHEN n <= 50 THEN 10 WHEN n <= 100 THEN 7 WHEN n <= 500 THEN 3 WHEN n <= 1000 THEN 1 ELSE 0 END AS narrow_bonus
FROM (SELECT sku, count(DISTINCT make) AS n FROM v_fitment GROUP BY sku) a""",
    "v_primary": """
SELECT user_id, primary_category, TRUE AS active FROM (
  SELECT s.user_id, coalesce(c.category, 'UNIVERSAL') AS primary_category,
    row_number() OVER (PARTITION BY s.user_id ORDER BY event_ts DESC, s.sku DESC) AS rn
  FROM v_staged s LEFT JOIN v_catalog c ON s.sku = c.sku) a WHERE rn = 1
UNION ALL SELECT user_id, 'COLD_START', FALSE FROM v_users WHERE user_id NOT IN (SELECT user_id FROM v_staged)""",
    "v_catpairs": """
SELECT a.category AS item_a, b.category AS item_b, count(*) AS pair_count
FROM (SELECT unnest(cats) AS category, * EXCLUDE (cats) FROM v_bcat) a JOIN (SELECT unnest(cats) AS category, * EXCLUDE (cats) FROM v_bcat) b
  ON a.user_id = b.user_id AND a.order_date = b.order_date AND a.category < b.category
WHERE a.n BETWEEN 2 AND 5 GROUP BY ALL HAVING count(*) >= 50""",
    "v_bcat": """
SELECT user_id, order_date, list(DISTINCT c) AS cats, count(DISTINCT c) AS n FROM (
  SELECT o.user_id, o.order_date, CASE WHEN c.category IS NULL OR trim(c.category) = '' THEN 'UNIVERSAL' ELSE trim(c.category) END AS c
  FROM v_orders o LEFT JOIN v_catalog c ON o.sku = c.sku) x GROUP BY ALL""",
    "v_pool": """
SELECT *, row_number() OVER (ORDER BY total_orders DESC, sku) AS pool_rank FROM (
  SELECT p.*, coalesce(a.total_orders, 0) AS total_orders FROM v_products p LEFT JOIN v_glob a ON a.sku = p.sku
  WHERE p.sku NOT IN (SELECT sku FROM v_fitment)) b ORDER BY total_orders DESC, sku LIMIT 500""",
})


# ---- Spark side -----------------------------------------------------------------
@once
def prices(t):
    return t.catalog.select("sku", "price")


@once
def images(t):
    return t.catalog.select("sku", X.https_image("image_raw").alias("image_url")).where(X.image_ok("image_url"))


@once
def products(t):
    return E.sellable_products(t.catalog, prices(t), images(t), p)


@once
def eligible(t):
    return E.eligible_parts(t.fitment, products(t), ["make"], p)


@once
def tiers(t):
    hist = shared(P.history_counts(t.imported, p))
    seg = shared(P.segment_popularity(hist, t.staged, t.users, p))
    return seg, P.make_popularity(seg, p), P.global_popularity(hist, t.staged, t.users, p)


@once
def profiles(t):
    return t.users.select(*PROFILE).distinct()


@once
def profile_parts(t):
    return C.fitment_candidates(profiles(t), eligible(t), {"seg_make": "make"})


def with_models(t, rows):
    """Rows of a make with the models that its users drive as one array (``R.Spread``), so profile rows need not be stored."""
    models = durable(profiles(t).groupBy("seg_make").agg(F.collect_set(F.struct("seg_model")).alias("_models")))
    return R.with_small(rows, models, "seg_make")


@once
def parts(t):
    """Fitment parts of each make with their popularity in all tiers, stored once for all profiles of the make."""
    rows = P.lookup_tiers(eligible(t).withColumnRenamed("make", "seg_make"), *tiers(t), p)
    return durable(with_models(t, R.base_columns(rows)))


SPREAD = R.Spread("_models", ("seg_model",), lambda rows: P.choose_tier(rows, p).withColumn("final_score", R.score_popularity()))


@once
def scored(t):
    """Fitment parts of each profile with their popularity: products scored once per profile."""
    return SPREAD.profiles(parts(t))


@once
def exclusion(t):
    return C.purchase_exclusion(t.staged, t.imported, t.users, p)


@once
def diversified(t):
    return R.diversified_for_users(t.users, parts(t), PROFILE, p.max_per_category, exclusion(t), spread=SPREAD)


@once
def top(t):
    rows = R.diversified_for_users(t.users, parts(t), PROFILE, p.max_per_category, exclusion(t), top=p.slots, spread=SPREAD)
    return durable(R.top_n_min(rows, p.slots, p.min_recs))


@once
def wide(t):
    rows = top(t).join(t.users.select("user_id", "email"), "user_id")
    return R.wide_output(rows, ["user_id", "email", *PROFILE], p)


WIDE_COLS = "user_id:l email seg_make seg_model " + " ".join(
    f"rec{i}_sku rec{i}_price:d2 rec{i}_score:d2 rec{i}_image_url rec{i}_popularity_source" for i in range(1, 5)) + " rec_count:l"


@query("D43 D15 D27 D29 D36 D37 D38 A09", WIDE_COLS, "SELECT * FROM v_wide")
def wide_output(t):
    return wide(t)


@query("D01", "sku price:d4 observations:l",
       "SELECT sku, max(price) AS price, count(*) AS observations FROM v_staged GROUP BY sku")
def sku_prices(t):
    return E.sku_prices(bags.stage_events(t.event_bags).where("price is not null").unionByName(
        bags.stage_events(t.event_bags).where("price is null").join(
            t.staged.where("event_name = 'PLACED ORDER'").select("user_id", "sku", "event_ts", F.col("price").alias("pp")),
            ["user_id", "sku", "event_ts"]).drop("price").withColumnRenamed("pp", "price").select(
                "user_id", "sku", "event_ts", "event_name", "price", "image_raw")))


@query("D02", "sku image_url", """
SELECT sku, concat('https://img.example/', sku) AS image_url FROM v_staged
WHERE event_name IN ('VIEWED PRODUCT', 'CART UPDATE') GROUP BY sku""")
def sku_images(t):
    return E.sku_images(bags.stage_events(t.event_bags))


@query("D03 D04", "sku variant base base_single", """
SELECT text AS sku, regexp_replace(text, '([0-9])[BRGP]$', '\\1') AS variant,
  regexp_replace(regexp_replace(text, '(-KIT|-BLK|-POL|-CHR|-RAW|-[A-Z0-9]{1,2})$', ''), '([0-9])[BRGP]$', '\\1') AS base,
  regexp_replace(regexp_replace(text, '(-KIT|-BLK|-POL|-CHR|-RAW)$', ''), '([0-9])[BRGP]$', '\\1') AS base_single
FROM (SELECT concat(sku, CASE WHEN size < 10 THEN '-KIT' WHEN size < 20 THEN '-X1' WHEN size < 25 THEN 'R' ELSE '' END) AS text
      FROM v_catalog) a""")
def normalize_variant(t):
    s = F.col("size")
    text = F.concat("sku", F.when(s < 10, "-KIT").when(s < 20, "-X1").when(s < 25, "R").otherwise(""))
    return t.catalog.select(text.alias("sku")).select(
        "sku", X.normalize_variant("sku").alias("variant"), X.base_sku("sku").alias("base"),
        X.base_sku_single("sku").alias("base_single"))


@query("P04", "item service:b", """
SELECT concat(pre, sku) AS item, regexp_matches(concat(pre, sku), '^(EXT|GIFT|WARRANTY|SERVICE|PREAUTH)-') AS service
FROM (SELECT sku, CASE size WHEN 1 THEN 'EXT-' WHEN 2 THEN 'GIFT-' WHEN 3 THEN 'WARRANTY-' WHEN 4 THEN 'XGIFT-' ELSE '' END AS pre
      FROM v_catalog) a""")
def service_sku(t):
    s = F.col("size")
    pre = F.when(s == 1, "EXT-").when(s == 2, "GIFT-").when(s == 3, "WARRANTY-").when(s == 4, "XGIFT-").otherwise("")
    return t.catalog.select(F.concat(pre, "sku").alias("item")).withColumn("service", X.is_service_sku("item"))


#: Part types with the answer expected of the exclusion: kept or not. All other categories of the test tables are kept.
PART_TYPES = {"Head Gasket": False, "Engine Bolt Kit": True, "Wheel Bolt": False, "Distributor Cap": True, "Wheel Hub Cap": True, "Fuel Cap": False, "Hose Clamp": False}
ANSWERS = ", ".join(f"({i}, '{name}', {kept})" for i, (name, kept) in enumerate(PART_TYPES.items(), 1))


@query("P05", "part_type n:l", f"""
SELECT coalesce(a.name, c.category) AS part_type, count(*) AS n FROM v_catalog c LEFT JOIN (VALUES {ANSWERS}) a(i, name, kept) ON a.i = c.size
WHERE coalesce(a.kept, TRUE) GROUP BY 1""")
def commodity_exclusion(t):
    kind = F.coalesce(F.get(F.array(*[F.lit(x) for x in PART_TYPES]), F.col("size") - 1), "category")
    return t.catalog.withColumn("part_type", kind).where(~X.is_commodity("part_type")).groupBy("part_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("P06", "category kept:l kept_strict:l kept_unknown:l", """
SELECT category, count(*) FILTER (coalesce(price2, 950) >= 950) AS kept,
  count(*) FILTER (coalesce(price2, 950) >= 950 AND price2 IS NOT NULL) AS kept_strict,
  count(*) FILTER (coalesce(price2, 950) >= 950 AND NOT (kind = 'UNKNOWN' AND coalesce(price2, 950) < 990)) AS kept_unknown
FROM (SELECT category, CASE WHEN size = 10 THEN NULL ELSE price END AS price2,
        CASE WHEN size > 40 THEN 'UNKNOWN' ELSE category END AS kind FROM v_catalog) a GROUP BY category""")
def price_floor(t):
    rows = t.catalog.select("category", F.when(F.col("size") != 10, F.col("price")).alias("price"),
                            F.when(F.col("size") > 40, "UNKNOWN").otherwise(F.col("category")).alias("kind"))
    ok = X.price_ok("price", 950)
    return rows.groupBy("category").agg(
        F.count_if(ok).alias("kept"), F.count_if(X.price_ok("price", 950, False)).alias("kept_strict"),
        F.count_if(ok & X.unknown_category_ok("kind", "price", 950, 990)).alias("kept_unknown"))


@query("P07 J05", "sku", """
SELECT sku FROM v_catalog WHERE sku NOT IN (SELECT sku FROM v_catalog WHERE lower(tags) LIKE '%refurbished%')""")
def refurbished_exclusion(t):
    bad = t.catalog.where(X.is_refurbished("tags")).select("sku").distinct()
    return t.catalog.select("sku").join(bad, "sku", "left_anti")


@query("P08 D55", "sku image_url product_url", f"""
SELECT sku, image_url, concat('https://shop.example/products/', sku) AS product_url
FROM (SELECT sku, {IMG} AS image_url FROM v_catalog) a WHERE image_url LIKE 'https://%'""")
def image_gate(t):
    return images(t).withColumn("product_url", X.product_url("sku"))


@query("D05", "make sku category price:d2 image_url", "SELECT * FROM v_eligible")
def eligible_parts(t):
    return eligible(t)


@query("D06 W03", "sku category total_orders:l pool_rank:l", "SELECT * FROM v_pool")
def universal_parts(t):
    return E.universal_parts(t.fitment, products(t), tiers(t)[2], p.pool_size)


@query("D07 A07", "make total_count:l first_part last_part n_parts:l", """
SELECT make, count(*) AS total_count, min(sku) AS first_part, max(sku) AS last_part, len(list(sku ORDER BY sku)) AS n_parts
FROM v_eligible GROUP BY make""")
def vehicle_parts_list(t):
    return E.vehicle_parts_list(eligible(t), ["make"]).select(
        "make", "total_count", F.element_at("parts", 1).alias("first_part"), F.element_at("parts", -1).alias("last_part"),
        F.size("parts").alias("n_parts"))


@query("D08", "user_id:l sku intent:d4 intent_type", """
SELECT * FROM v_intent WHERE sku IN (SELECT sku FROM v_fitment)""")
def intent_strongest(t):
    return I.intent_strongest(t.staged, p, t.fitment)


@query("D08", "user_id:l level", """
SELECT u.user_id, CASE WHEN max(intent_type = 'order') THEN 'hot' WHEN max(intent_type = 'cart') THEN 'warm'
  WHEN max(intent_type = 'view') THEN 'cool' ELSE 'cold' END AS level
FROM v_users u LEFT JOIN v_intent i ON u.user_id = i.user_id GROUP BY u.user_id""")
def intent_level(t):
    return I.intent_level(t.users, I.intent_strongest(t.staged, p))


@query("D09", "user_id:l sku intent:d4", """
SELECT user_id, sku, sum(ln(2) * CASE event_name WHEN 'PLACED ORDER' THEN 20 WHEN 'CART UPDATE' THEN 10 ELSE 2 END) AS intent
FROM v_staged GROUP BY ALL""")
def intent_sum(t):
    return I.intent_sum(t.staged, p)


@query("D10", "user_id:l sku intent:d4", "SELECT * FROM v_decay")
def intent_decayed(t):
    return I.intent_decayed(t.staged, p, "2024-01-31")


@query("D10", "user_id:l sku intent:d4", """
SELECT user_id, sku, greatest(sum(CASE event_name WHEN 'PLACED ORDER' THEN -10 WHEN 'CART UPDATE' THEN 5 ELSE 1 END
  * pow(0.5, date_diff('day', CAST(event_ts AS DATE), DATE '2024-01-31') / 30.0)), 0) AS intent FROM v_staged GROUP BY ALL""")
def intent_decayed_backtest(t):
    return I.intent_decayed(t.staged, p, "2024-01-31", order=-10.0, cart=5.0, view=1.0, floor=True)


@query("D11", "user_id:l sku strength:d2", """
SELECT user_id, sku, sum(CASE event_name WHEN 'PLACED ORDER' THEN 20 WHEN 'CART UPDATE' THEN 10 ELSE 2 END) AS strength
FROM v_staged GROUP BY ALL""")
def intent_strength(t):
    return I.intent_strength(t.staged, p)


@query("D12", "seg_make seg_model sku total_segment_orders:l segment_score:d2 rank_in_segment:l", "SELECT * FROM v_seg")
def segment_popularity(t):
    return tiers(t)[0]


@query("D12 T03", "seg_make seg_model sku total_segment_orders:l rank_in_segment:l",
       "SELECT * FROM v_seg WHERE rank_in_segment <= 50")
def segment_top50(t):
    return P.segment_top(tiers(t)[0], 50)


@query("D13", "seg_make sku total_make_orders:l make_score:d2 rank_in_make:l", "SELECT * FROM v_make")
def make_popularity(t):
    return tiers(t)[1]


@query("D14", "sku total_orders:l global_score:d4", "SELECT * FROM v_glob")
def global_popularity(t):
    return tiers(t)[2]


@query("D14 J03", "sku total_orders:l global_score:d4", """
SELECT coalesce(a.sku, b.sku) AS sku, coalesce(a.n, 0) + coalesce(b.n, 0) AS total_orders,
  ln(1 + coalesce(a.n, 0) + coalesce(b.n, 0)) * 2 AS global_score
FROM (SELECT sku, count(*) AS n FROM v_hist GROUP BY sku) a
FULL JOIN (SELECT sku, count(*) AS n FROM v_recent GROUP BY sku) b ON a.sku = b.sku""")
def global_popularity_all(t):
    return P.global_popularity_all(t.imported, t.staged, p)


@query("D15 J13", "seg_make seg_model sku popularity:d2 popularity_source rank_in_segment:l rank_in_make:l",
       "SELECT * FROM v_tiers")
def popularity_3tier(t):
    return scored(t)


@query("D15", "seg_make seg_model sku popularity:d2 popularity_source", f"""
SELECT pr.seg_make, pr.seg_model, pr.sku, coalesce(CASE tier WHEN 'segment' THEN s.segment_score WHEN 'make' THEN m.make_score ELSE g.global_score END, 0) AS popularity,
  CASE WHEN tier = 'global' AND g.sku IS NULL THEN 'none' ELSE tier END AS popularity_source
FROM (SELECT t.seg_make, t.seg_model, t.sku, t.norm_sku, CASE WHEN coalesce(st.n, 0) >= 5 THEN 'segment' WHEN coalesce(mt.n, 0) >= 20 THEN 'make' ELSE 'global' END AS tier
  FROM v_tiers t LEFT JOIN (SELECT seg_make, seg_model, sum(total_segment_orders) AS n FROM v_seg GROUP BY ALL) st
    ON st.seg_make = t.seg_make AND st.seg_model = t.seg_model
  LEFT JOIN (SELECT seg_make, sum(total_make_orders) AS n FROM v_make GROUP BY ALL) mt ON mt.seg_make = t.seg_make) pr
LEFT JOIN v_seg s ON s.seg_make = pr.seg_make AND s.seg_model = pr.seg_model AND s.sku = pr.norm_sku
LEFT JOIN v_make m ON m.seg_make = pr.seg_make AND m.sku = pr.norm_sku
LEFT JOIN v_glob g ON g.sku = pr.norm_sku""")
def popularity_by_segment_tier(t):
    cand = profile_parts(t)
    return P.with_popularity_by_segment(cand, *tiers(t), p)


@query("D15", "seg_make seg_model sku popularity:d2", """
SELECT t.seg_make, t.seg_model, t.sku, coalesce(s.segment_score, g.global_score, 0) AS popularity FROM v_tiers t
LEFT JOIN v_seg s ON s.seg_make = t.seg_make AND s.seg_model = t.seg_model AND s.sku = t.norm_sku
LEFT JOIN v_glob g ON g.sku = t.norm_sku""")
def popularity_2tier(t):
    cand = profile_parts(t)
    seg, _, glob = tiers(t)
    return P.with_popularity_two_tier(cand, seg, glob, p)


@query("D15", "seg_make seg_model sku popularity:d2 popularity_source", """
SELECT pr.seg_make, pr.seg_model, pr.sku,
  CASE WHEN coalesce(st.n, 0) >= 5 AND s.sku IS NOT NULL THEN s.segment_score
       WHEN coalesce(mt.n, 0) >= 20 AND m.sku IS NOT NULL THEN m.make_score ELSE coalesce(g.score, 0) END AS popularity,
  CASE WHEN coalesce(st.n, 0) >= 5 AND s.sku IS NOT NULL THEN 'segment'
       WHEN coalesce(mt.n, 0) >= 20 AND m.sku IS NOT NULL THEN 'make' WHEN g.sku IS NOT NULL THEN 'global' ELSE 'none' END AS popularity_source
FROM v_tiers pr LEFT JOIN v_seg s ON s.seg_make = pr.seg_make AND s.seg_model = pr.seg_model AND s.sku = pr.sku
LEFT JOIN v_make m ON m.seg_make = pr.seg_make AND m.sku = pr.sku
LEFT JOIN (SELECT sku, ln(1 + count(*)) * 2 AS score FROM (SELECT sku FROM v_hist UNION ALL
    SELECT sku FROM v_staged WHERE event_name = 'PLACED ORDER' AND user_id IN (SELECT user_id FROM v_users)) a GROUP BY sku) g ON g.sku = pr.sku
LEFT JOIN (SELECT seg_make, seg_model, sum(total_segment_orders) AS n FROM v_seg GROUP BY ALL) st ON st.seg_make = pr.seg_make AND st.seg_model = pr.seg_model
LEFT JOIN (SELECT seg_make, sum(total_make_orders) AS n FROM v_make GROUP BY ALL) mt ON mt.seg_make = pr.seg_make""")
def popularity_raw_lookup(t):
    """Parity mode: tables keyed by normalised sku, looked up by raw sku."""
    q = p.but(normalize_both=False)
    seg, mk, _ = tiers(t)
    cand = profile_parts(t)
    return P.with_popularity(cand, seg, mk, P.global_popularity(P.history_counts(t.imported, q), t.staged, t.users, q), q)


@query("D16", "sku hist_orders:l recent_orders:l popularity:d4", f"""
SELECT sku, h AS hist_orders, r AS recent_orders, ln(1 + h) * 2 + ln(1 + r) * 6 AS popularity FROM (
  SELECT {norm('sku')} AS sku, count(*) FILTER (order_date < DATE '2001-01-01') AS h, count(*) FILTER (order_date >= DATE '2001-01-01') AS r
  FROM v_imported GROUP BY 1) a""")
def recency_weighted_popularity(t):
    return P.recency_weighted_popularity(t.imported, "2001-01-01")


YEAR_COUNTS = f"""year_counts AS (SELECT u.seg_make, u.seg_model, u.seg_year, {norm('o.sku')} AS sku, count(*) AS orders
FROM v_orders o JOIN v_users u ON o.user_id = u.user_id GROUP BY ALL)"""


@query("D17", "seg_make seg_model seg_year:l sku orders:l", "SELECT * FROM year_counts", YEAR_COUNTS)
def segment_popularity_year(t):
    return P.segment_popularity_year(t.orders, t.users, p)


@query("D17 J09", "seg_make seg_model seg_year:l sku orders:l gen_orders:l score:d4", """
SELECT coalesce(y.seg_make, g.seg_make) AS seg_make, coalesce(y.seg_model, g.seg_model) AS seg_model,
  coalesce(y.seg_year, g.seg_year) AS seg_year, coalesce(y.sku, g.sku) AS sku, coalesce(orders, 0) AS orders, coalesce(gen_orders, 0) AS gen_orders,
  ln(1 + greatest(coalesce(orders, 0), 0.5 * coalesce(gen_orders, 0))) * 10 AS score
FROM year_counts y FULL JOIN (
  SELECT seg_make, seg_model, yr AS seg_year, sku, gen_orders FROM (
    SELECT c.seg_make, c.seg_model, g.year_start, g.year_end, c.sku, sum(c.orders) AS gen_orders FROM year_counts c
    JOIN v_generations g ON g.make = c.seg_make AND c.seg_year BETWEEN g.year_start AND g.year_end GROUP BY ALL) x,
  unnest(generate_series(year_start, year_end)) AS s(yr)) g
ON y.seg_make = g.seg_make AND y.seg_model = g.seg_model AND y.seg_year = g.seg_year AND y.sku = g.sku""", YEAR_COUNTS)
def generation_popularity(t):
    return P.generation_popularity(P.segment_popularity_year(t.orders, t.users, p), t.generations, p)


@query("D18", "sku breadth:l narrow_bonus:d2", "SELECT * FROM v_breadth")
def fitment_breadth(t):
    return P.fitment_breadth(t.fitment, ["make"])


@query("D19", "item_a item_b pair_count:l boost:d4", "SELECT * FROM v_pairs3")
def copurchase_basket(t):
    return CP.copurchase_basket(t.orders, 2, 10)


DIRECTED = """bk AS (SELECT DISTINCT o.order_id, o.sku FROM v_orders o JOIN (SELECT order_id FROM v_orders GROUP BY order_id
  HAVING count(DISTINCT sku) BETWEEN 2 AND 20) k ON o.order_id = k.order_id),
pr AS (SELECT a.sku AS a, b.sku AS b, count(*) AS n FROM bk a JOIN bk b ON a.order_id = b.order_id AND a.sku < b.sku
  GROUP BY ALL HAVING count(*) >= 2),
directed AS (SELECT a AS source, b AS target, n AS pair_count, ln(1 + n) * 5 AS boost FROM pr
  UNION ALL SELECT b, a, n, ln(1 + n) * 5 FROM pr)"""


@query("D20", "source target pair_count:l boost:d4", "SELECT * FROM directed", DIRECTED)
def copurchase_orders(t):
    return CP.copurchase_orders(t.orders, 2, 20, 2)


def user_purchases(t):
    """Distinct purchases of known users with their segment; the segment here is the make."""
    return t.orders.join(t.users.select("user_id", "seg_make"), "user_id").select("user_id", "seg_make", "sku").distinct()


COND = """up AS (SELECT DISTINCT o.user_id, u.seg_make, o.sku FROM v_orders o JOIN v_users u ON o.user_id = u.user_id),
cnt AS (SELECT seg_make, sku, count(*) AS n FROM up GROUP BY ALL),
cond AS (SELECT p.*, a.n AS buyers_a, b.n AS buyers_b, round(co_count / a.n, 3) AS p_b_given_a, round(co_count / b.n, 3) AS p_a_given_b,
  round(ln(1 + co_count) * 5, 2) AS score
 FROM (SELECT a.seg_make, a.sku AS item_a, b.sku AS item_b, count(*) AS co_count FROM up a JOIN up b
  ON a.user_id = b.user_id AND a.sku < b.sku GROUP BY ALL HAVING count(*) >= 3) p
 JOIN cnt a ON a.seg_make = p.seg_make AND a.sku = p.item_a JOIN cnt b ON b.seg_make = p.seg_make AND b.sku = p.item_b)"""


@query("D21 J08", "seg_make item_a item_b co_count:l buyers_a:l buyers_b:l p_b_given_a:d3 p_a_given_b:d3 score:d2",
       "SELECT * FROM cond", COND)
def copurchase_conditional(t):
    return CP.copurchase_conditional(user_purchases(t), 3, ["seg_make"])


RECOMMEND = COND + """, crec AS (SELECT DISTINCT u.user_id, u.seg_make, u.sku AS owned_sku, c.item_b AS sku, c.score, c.p_b_given_a
FROM up u JOIN cond c ON u.seg_make = c.seg_make AND u.sku = c.item_a
WHERE NOT EXISTS (SELECT 1 FROM up x WHERE x.user_id = u.user_id AND x.sku = c.item_b))"""


@query("D22 J06", "user_id:l seg_make owned_sku sku score:d2 p_b_given_a:d3", "SELECT * FROM crec", RECOMMEND)
def copurchase_recommend(t):
    up = user_purchases(t)
    return CP.copurchase_recommend(up, CP.copurchase_conditional(up, 3, ["seg_make"]), ["seg_make"])


@query("D22", "users:l skus:l recs:l avg_score:d2", """
SELECT count(DISTINCT user_id) AS users, count(DISTINCT sku) AS skus, count(*) AS recs, round(avg(score), 2) AS avg_score FROM crec""", RECOMMEND)
def copurchase_coverage(t):
    return CP.copurchase_coverage(copurchase_recommend(t))


@query("D23", "item_a item_b pair_count:l", "SELECT * FROM v_catpairs")
def category_copurchase(t):
    return CP.category_copurchase(t.orders, t.catalog, 2, 5, min_count=50)


@query("D23", "category_a category_b pair_count:l", """
SELECT ca.category AS category_a, cb.category AS category_b, count(*) AS pair_count
FROM v_bask a JOIN v_bask b ON a.user_id = b.user_id AND a.order_date = b.order_date AND a.sku < b.sku
JOIN v_catalog ca ON ca.sku = a.sku JOIN v_catalog cb ON cb.sku = b.sku
WHERE ca.category <> cb.category GROUP BY ALL HAVING count(*) >= 5""")
def category_copurchase_skus(t):
    return CP.category_copurchase_skus(t.orders, t.catalog, 2, 10, min_count=5)


BOOST = """ub AS (SELECT o.user_id, d.target AS sku, max(d.boost) AS boost FROM (SELECT DISTINCT user_id, sku FROM v_orders) o
JOIN (SELECT item_a AS source, item_b AS target, boost FROM v_pairs3 UNION ALL SELECT item_b, item_a, boost FROM v_pairs3) d
ON o.sku = d.source GROUP BY ALL)"""


@query("D24", "user_id:l sku boost:d4", "SELECT * FROM ub", BOOST)
def user_copurchase_boost(t):
    return CP.user_copurchase_boost(t.orders, CP.copurchase_basket(t.orders, 2, 10))


STRENGTH = """st AS (SELECT user_id, sku, sum(CASE event_name WHEN 'PLACED ORDER' THEN 20 WHEN 'CART UPDATE' THEN 10 ELSE 2 END) AS strength
FROM v_staged GROUP BY ALL), us AS (SELECT s.user_id, d.target AS sku, sum(d.boost * ln(1 + s.strength)) AS boost
FROM st s JOIN directed d ON s.sku = d.source GROUP BY ALL)"""


@query("D24", "user_id:l sku boost:d4", "SELECT * FROM us", DIRECTED + ", " + STRENGTH)
def user_copurchase_sum(t):
    return CP.user_copurchase_sum(I.intent_strength(t.staged, p), CP.copurchase_orders(t.orders, 2, 20, 2))


@once
def primary(t):
    return C.primary_category(t.users, t.staged, t.catalog)


@query("D25 O02", "user_id:l primary_category active:b", "SELECT * FROM v_primary")
def primary_category(t):
    return primary(t)


@query("D26", "make category points:d2 n:l", """
SELECT e.make, e.category, CASE WHEN e.category = r.category THEN 50 WHEN e.category = 'UNIVERSAL' THEN 25 ELSE 0 END AS points, count(*) AS n
FROM v_eligible e JOIN (SELECT make, max(category) AS category FROM v_eligible GROUP BY make) r ON e.make = r.make GROUP BY ALL""")
def category_score(t):
    e = eligible(t)
    best = e.groupBy("make").agg(F.max("category").alias("best"))
    return e.join(best, "make").groupBy("make", "category", C.category_score("category", "best").alias("points")).agg(
        F.count(F.lit(1)).alias("n"))


@query("D27", "user_id:l sku", "SELECT * FROM v_excl")
def purchase_exclusion(t):
    return exclusion(t)


@query("D28 J02 P11", "user_id:l seg_make seg_model second_make second_model has_second:b", """
SELECT u.user_id, u.seg_make, u.seg_model, s.seg_make AS second_make, s.seg_model AS second_model, s.user_id IS NOT NULL AS has_second
FROM v_users u LEFT JOIN (SELECT DISTINCT o.user_id, v.seg_make, v.seg_model FROM (
    SELECT user_id, max(part_id) AS k FROM (SELECT o.user_id, c.part_id FROM v_orders o JOIN v_catalog c ON o.sku = c.sku
      WHERE o.order_date >= DATE '2001-06-01') x GROUP BY user_id) o JOIN v_users v ON v.user_id = o.k) s ON u.user_id = s.user_id""")
def multi_vehicle_users(t):
    """The vehicle of the customer whose number equals the newest part number stands in as second vehicle."""
    key = t.orders.where("order_date >= date'2001-06-01'").join(t.catalog.select("sku", "part_id"), "sku").groupBy("user_id").agg(
        F.max("part_id").alias("k"))
    other = t.users.select(F.col("user_id").alias("k"), F.col("seg_make").alias("second_make"), F.col("seg_model").alias("second_model"))
    return C.with_second_vehicle(t.users, key.join(other, "k").drop("k"))


@query("D29 J01", "user_id:l n:l first_sku last_sku total_price:d2", """
SELECT u.user_id, count(*) AS n, min(e.sku) AS first_sku, max(e.sku) AS last_sku, sum(CAST(e.price AS DECIMAL(12,2))) AS total_price
FROM v_users u JOIN v_eligible e ON u.seg_make = e.make GROUP BY u.user_id""")
def fitment_candidates(t):
    """Candidates depend on the vehicle alone, so they are summed up per vehicle before users join."""
    rows = C.fitment_candidates(t.users.select("seg_make").distinct(), eligible(t), {"seg_make": "make"})
    per = rows.groupBy("seg_make").agg(F.count(F.lit(1)).alias("n"), F.min("sku").alias("first_sku"), F.max("sku").alias("last_sku"),
                                       F.sum(F.col("price").cast("decimal(12,2)")).alias("total_price"))
    return t.users.select("user_id", "seg_make").join(per, "seg_make")


@once
def universal_pool(t):
    return E.universal_parts(t.fitment, products(t), tiers(t)[2], p.pool_size)


@query("D30 J04", "user_id:l n:l best_sku rank_sum:l", """
SELECT u.user_id, count(*) AS n, min(CASE WHEN pool_rank = 1 THEN sku END) AS best_sku, sum(pool_rank) AS rank_sum
FROM v_users u CROSS JOIN v_pool GROUP BY u.user_id""")
def universal_candidates(t):
    """All users have the same pool, so it is paired with one row for all of them and summed up first."""
    rows = C.explode_pool(t.users.select(F.lit(1).alias("_all")).distinct(), universal_pool(t).select("pool_rank", "sku"), p.pool_size)
    per = rows.groupBy("_all").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("pool_rank") == 1, F.col("sku"))).alias("best_sku"),
                                   F.sum("pool_rank").alias("rank_sum"))
    return t.users.select("user_id", F.lit(1).alias("_all")).join(per, "_all")


TIERED = f"""fit AS (SELECT t.*, 0 AS tier_priority, round(coalesce(s.segment_score, 0) + coalesce(b.narrow_bonus, 0), 2) AS final_score
  FROM v_tiers t LEFT JOIN v_seg s ON s.seg_make = t.seg_make AND s.seg_model = t.seg_model AND s.sku = t.sku LEFT JOIN v_breadth b ON b.sku = t.sku),
pop AS (SELECT s.seg_make, s.seg_model, s.sku, p.category, p.price, {norm('s.sku')} AS base_sku, 1 AS tier_priority, s.segment_score AS final_score
  FROM v_seg s JOIN v_products p ON p.sku = s.sku WHERE NOT EXISTS (SELECT 1 FROM fit f WHERE f.seg_make = s.seg_make AND f.seg_model = s.seg_model AND f.sku = s.sku)),
bought AS (SELECT DISTINCT user_id, sku FROM v_orders)"""


@once
def fitment_parts(t):
    """Fitment parts of each make with their segment scores as one array and the bonus for narrow fit, stored once."""
    segs = tiers(t)[0].groupBy("seg_make", "sku").agg(F.collect_list(F.struct("seg_model", "segment_score")).alias("_segs"))
    rows = eligible(t).withColumnRenamed("make", "seg_make").join(segs, ["seg_make", "sku"], "left").join(
        P.fitment_breadth(t.fitment, ["make"]), "sku", "left")
    return durable(with_models(t, R.base_columns(rows)))


def score_narrow_fit(rows):
    rows = rows.withColumn("segment_score", F.get(F.filter("_segs", lambda e: e["seg_model"] == F.col("seg_model")), F.lit(0))["segment_score"])
    return rows.withColumn("final_score", R.score_sum("segment_score", "narrow_bonus")).select(
        *[c for c in rows.columns if c == "user_id"], *PROFILE, "sku", "norm_sku", "base_sku", "category", "price", "final_score", F.lit(0).alias("tier_priority"))


TIER_SPREAD = R.Spread("_models", ("seg_model",), score_narrow_fit)


@once
def fitment_tier(t):
    """Fitment rows per profile scored by segment popularity and narrow fit."""
    return TIER_SPREAD.profiles(fitment_parts(t))


@once
def segment_tier(t):
    rows = C.segment_popular_profiles(profiles(t), tiers(t)[0].select(*PROFILE, "sku", "segment_score"), products(t), fitment_tier(t),
                                      PROFILE, PROFILE)
    return R.base_columns(rows).select(*PROFILE, "sku", "norm_sku", "base_sku", "category", "price",
                                       F.col("segment_score").alias("final_score"), F.lit(1).alias("tier_priority"))


@query("D31", "user_id:l n:l best:d2 first_sku", """
SELECT u.user_id, count(*) AS n, max(p.final_score) AS best, min(p.sku) AS first_sku FROM v_users u
JOIN pop p ON u.seg_make = p.seg_make AND u.seg_model = p.seg_model
LEFT JOIN bought b ON b.user_id = u.user_id AND b.sku = p.sku WHERE b.sku IS NULL GROUP BY u.user_id""", TIERED)
def segment_popular_candidates(t):
    rows = segment_tier(t).select(*PROFILE, "sku", "final_score")
    out = C.best_left(t.users, rows, t.orders.select("user_id", "sku"), PROFILE, "sku", high=[F.desc("final_score"), F.asc("sku")], low=[F.asc("sku")])
    return out.select("user_id", "n", F.col("high.final_score").alias("best"), F.col("low.sku").alias("first_sku"))


TIER_ORDER = (("tier_priority", True), *R.BY_SCORE)


@query("D41", "user_id:l rn:l sku category tier_priority:l final_score:d2", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tier_priority, final_score DESC, sku) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY tier_priority, final_score DESC, sku) AS rc FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, base_sku ORDER BY tier_priority, final_score DESC, sku) AS rv FROM (
      SELECT u.user_id, c.* FROM v_users u JOIN (SELECT seg_make, seg_model, sku, category, base_sku, tier_priority, final_score FROM fit
        UNION ALL SELECT seg_make, seg_model, sku, category, base_sku, tier_priority, final_score FROM pop) c
        ON u.seg_make = c.seg_make AND u.seg_model = c.seg_model
      LEFT JOIN bought b ON b.user_id = u.user_id AND b.sku = c.sku WHERE b.sku IS NULL) q0) q1 WHERE rv = 1) q2 WHERE rc <= 2) q3 WHERE rn <= 4""", TIERED)
def tier_priority_ranking(t):
    both = fitment_tier(t).unionByName(segment_tier(t))
    rows = R.diversified_for_users(t.users, both, PROFILE, 2, t.orders.select("user_id", "sku"), order=TIER_ORDER, exclude_on="sku", top=4)
    return R.top_n_min(rows, 4, 1, TIER_ORDER)


RELATED = """rel AS (SELECT p.user_id, p.primary_category, x.b AS related_category FROM v_primary p JOIN (
  SELECT item_a AS a, item_b AS b FROM v_catpairs UNION SELECT item_b, item_a FROM v_catpairs) x ON p.primary_category = x.a
  WHERE p.active AND p.primary_category <> 'UNIVERSAL')"""


@query("D32 J12", "user_id:l primary_category related_category", "SELECT * FROM rel", RELATED)
def related_categories(t):
    return C.related_categories(primary(t), CP.category_copurchase(t.orders, t.catalog, 2, 5))


SLOTTED = TIERED + ", " + RELATED + f""",
sc AS (SELECT t.seg_make, t.seg_model, t.sku, t.category, t.base_sku, t.norm_sku, coalesce(s.segment_score, 0) + coalesce(b.narrow_bonus, 0) AS s
  FROM v_tiers t LEFT JOIN v_seg s ON s.seg_make = t.seg_make AND s.seg_model = t.seg_model AND s.sku = t.sku LEFT JOIN v_breadth b ON b.sku = t.sku),
allc AS (
  SELECT u.user_id, 'primary' AS slot_type, 0 AS slot_priority, c.*, round(50 + c.s + coalesce(i.intent, 0), 2) AS final_score
  FROM v_users u JOIN v_primary p ON p.user_id = u.user_id AND p.active JOIN sc c ON c.seg_make = u.seg_make AND c.seg_model = u.seg_model AND c.category = p.primary_category
  LEFT JOIN v_decay i ON i.user_id = u.user_id AND i.sku = c.sku
  UNION ALL
  SELECT u.user_id, 'related', 1, c.*, round(25 + c.s + coalesce(i.intent, 0), 2) FROM v_users u JOIN rel r ON r.user_id = u.user_id
  JOIN sc c ON c.seg_make = u.seg_make AND c.seg_model = u.seg_model AND c.category = r.related_category
  LEFT JOIN v_decay i ON i.user_id = u.user_id AND i.sku = c.sku
  UNION ALL
  SELECT u.user_id, 'cold_start', 0, c.*, round(c.s, 2) FROM v_users u JOIN v_primary p ON p.user_id = u.user_id AND NOT p.active
  JOIN sc c ON c.seg_make = u.seg_make AND c.seg_model = u.seg_model),
slotted AS (SELECT *, CASE WHEN slot_type = 'primary' AND rk <= 2 THEN rk WHEN slot_type = 'related' AND rk <= 2 THEN rk + 2
    WHEN slot_type = 'cold_start' AND rk <= 4 THEN rk END AS slot FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, slot_type ORDER BY final_score DESC, sku) AS rk FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY slot_priority, final_score DESC, sku) AS rc FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, base_sku ORDER BY slot_priority, final_score DESC, sku) AS rv FROM (
    SELECT a.* FROM allc a LEFT JOIN v_excl x ON x.user_id = a.user_id AND x.sku = a.norm_sku WHERE x.sku IS NULL) q0) q1 WHERE rv = 1) q2 WHERE rc <= 2) q3)"""


def slot_kinds(t, users, base):
    """(segment, primary category, category) with slot type, priority and points: matching, related and cold-start categories."""
    prof = users.select(*PROFILE, "primary_category", "active").distinct()
    pairs = CP.category_copurchase(t.orders, t.catalog, 2, 5)
    dirs = C.related_categories(prof.select("primary_category", "active").distinct().withColumn("user_id", F.lit(0)), pairs).drop("user_id")
    made = lambda df, category, kind, priority, plus: df.select(*prof.columns, F.col(category).alias("category"), F.lit(kind).alias("slot_type"), F.lit(priority).alias("slot_priority"), F.lit(plus).alias("_plus"))
    own = made(prof.where("active"), "primary_category", "primary", 0, 50)
    rel = made(prof.where("active").join(dirs, "primary_category"), "related_category", "related", 1, 25)
    cold = made(prof.where("not active").join(base.select(*PROFILE, "category").distinct(), list(PROFILE)), "category", "cold_start", 0, 0)
    return own.unionByName(rel).unionByName(cold)


def slotted_rows(t):
    users = t.users.join(durable(primary(t)), "user_id")
    base = fitment_parts(t)
    boosts = I.intent_decayed(t.staged, p, "2024-01-31").join(users.where("active").select("user_id"), "user_id", "left_semi")
    order = (("slot_priority", True), *R.BY_SCORE)
    return R.slotted_for_users(users, base, PROFILE, slot_kinds(t, users, fitment_tier(t)), 2, exclusion(t),
                               boosts.select("user_id", "sku", F.col("intent").alias("boost")), order, 4, TIER_SPREAD)


@query("D40 D32 D33", "user_id:l slot:l slot_type sku category final_score:d2", "SELECT * FROM slotted WHERE slot IS NOT NULL", SLOTTED)
def slot_allocation(t):
    return R.slot_allocation(slotted_rows(t))


@query("D33", "user_id:l n:l best:d2 top_sku", """
SELECT user_id, count(*) AS n, max(final_score) AS best, arg_max(sku, (final_score, sku)) AS top_sku FROM (
  SELECT a.* FROM allc a LEFT JOIN v_excl x ON x.user_id = a.user_id AND x.sku = a.norm_sku WHERE x.sku IS NULL AND slot_type = 'cold_start') q
GROUP BY user_id""", SLOTTED)
def cold_start_candidates(t):
    cold = t.users.join(primary(t).where("not active").select("user_id"), "user_id", "left_semi")
    rows = fitment_tier(t).select(*PROFILE, "sku", "norm_sku", "final_score")
    out = C.best_left(cold, rows, exclusion(t).withColumnRenamed("sku", "norm_sku"), PROFILE, "norm_sku", high=[F.desc("final_score"), F.desc("sku")])
    return out.select("user_id", "n", F.col("high.final_score").alias("best"), F.col("high.sku").alias("top_sku"))


@query("D32", "user_id:l n:l best:d2", """
SELECT a.user_id, count(*) AS n, max(final_score) AS best FROM allc a LEFT JOIN v_excl x ON x.user_id = a.user_id AND x.sku = a.norm_sku
WHERE x.sku IS NULL AND slot_type = 'related' GROUP BY a.user_id""", SLOTTED)
def related_category_candidates(t):
    prim = primary(t).where("active and primary_category <> 'UNIVERSAL'").select("user_id", "primary_category")
    pairs = CP.category_copurchase(t.orders, t.catalog, 2, 5)
    related = C.related_categories(prim.select("primary_category").distinct().select("primary_category", F.lit(0).alias("user_id"), F.lit(True).alias("active")), pairs)
    rows = fitment_tier(t).select(*PROFILE, "category", "sku", "norm_sku", "final_score")
    return C.related_best(t.users.join(prim, "user_id"), rows, related.drop("user_id"), I.intent_decayed(t.staged, p, "2024-01-31"),
                          exclusion(t).withColumnRenamed("sku", "norm_sku"), PROFILE)


@query("D34", "user_id:l sku popularity_only:d2 with_intent:d2 with_breadth:d2 copurchase_mix:d2", """
SELECT i.user_id, t.sku, round(t.popularity, 2) AS popularity_only, round(i.intent + t.popularity, 2) AS with_intent,
  round(i.intent + t.popularity + coalesce(b.narrow_bonus, 0) + coalesce(c.boost, 0), 2) AS with_breadth,
  round(2 * coalesce(c.boost, 0) + i.intent + 0.5 * t.popularity, 2) AS copurchase_mix
FROM v_intent i JOIN v_users u ON i.user_id = u.user_id
JOIN v_tiers t ON t.seg_make = u.seg_make AND t.seg_model = u.seg_model AND t.sku = i.sku
LEFT JOIN v_breadth b ON b.sku = t.sku LEFT JOIN ub c ON c.user_id = i.user_id AND c.sku = i.sku""", BOOST)
def final_score(t):
    intent = I.intent_strongest(t.staged, p)
    rows = intent.join(t.users, "user_id").join(scored(t), [*PROFILE, "sku"])
    rows = rows.join(P.fitment_breadth(t.fitment, ["make"]), "sku", "left").join(
        CP.user_copurchase_boost(t.orders, CP.copurchase_basket(t.orders, 2, 10)), ["user_id", "sku"], "left")
    return rows.select("user_id", "sku", R.score_popularity().alias("popularity_only"), R.score_sum("intent", "popularity").alias("with_intent"),
                       R.score_sum("intent", "popularity", "narrow_bonus", "boost").alias("with_breadth"),
                       R.score_copurchase_mix().alias("copurchase_mix"))


@query("D35", "seg_make seg_model n:l", "SELECT seg_make, seg_model, count(*) AS n FROM v_tiers WHERE has_signal GROUP BY ALL")
def purchase_signal_gate(t):
    return R.require_signal(scored(t), p.but(require_purchase_signal=True)).groupBy(*PROFILE).agg(F.count(F.lit(1)).alias("n"))


@query("D36", "user_id:l base_sku sku final_score:d2", """
SELECT user_id, base_sku, sku, final_score FROM (
 SELECT c.*, row_number() OVER (PARTITION BY user_id, base_sku ORDER BY final_score DESC, sku) AS rv FROM (
  SELECT user_id, sku, regexp_replace(sku, '([0-9])[BRGP]$', '\\1') AS base_sku, round(intent, 2) AS final_score FROM v_intent) c) a WHERE rv = 1""")
def dedup_variant(t):
    rows = I.intent_strongest(t.staged, p).withColumn("final_score", F.round("intent", 2))
    return R.dedup_variant(R.base_columns(rows))


@query("D37", "user_id:l category sku final_score:d2", "SELECT user_id, category, sku, final_score FROM v_div")
def diversity_cap(t):
    return diversified(t)


@query("D38 W02", "user_id:l rn:l sku category final_score:d2 popularity_source", "SELECT * FROM v_top")
def top_n_min(t):
    return top(t)


RESERVED = f"""rs AS (
  SELECT user_id, sku, category, base_sku, 'fitment' AS product_type, round(popularity + coalesce(intent, 0), 2) AS final_score FROM (
    SELECT c.user_id, c.sku, c.category, c.base_sku, c.popularity, i.intent FROM v_cand c LEFT JOIN v_intent i ON i.user_id = c.user_id AND i.sku = c.sku) a
  UNION ALL
  SELECT u.user_id, p.sku, p.category, {norm('p.sku')}, 'universal', round(ln(1 + p.total_orders) * 2 + coalesce(i.intent, 0), 2)
  FROM v_users u CROSS JOIN v_pool p LEFT JOIN v_intent i ON i.user_id = u.user_id AND i.sku = p.sku
  LEFT JOIN v_excl x ON x.user_id = u.user_id AND x.sku = {norm('p.sku')} WHERE x.sku IS NULL),
dv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY final_score DESC, sku) AS rc FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, base_sku ORDER BY final_score DESC, sku) AS rv FROM rs) q1 WHERE rv = 1) q2 WHERE rc <= 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY user_id, product_type ORDER BY final_score DESC, sku) AS pr,
  count(*) FILTER (product_type = 'fitment') OVER (PARTITION BY user_id) AS nf, count(*) FILTER (product_type = 'universal') OVER (PARTITION BY user_id) AS nu FROM dv),
sel AS (SELECT *, CASE WHEN pr <= 2 THEN concat(product_type, '_slot') WHEN product_type = 'fitment' THEN 'backfill_for_universal' ELSE 'backfill_for_fitment' END AS slot_source
  FROM rk WHERE pr <= 2 OR (product_type = 'universal' AND nf < 2 AND pr <= 4 - nf) OR (product_type = 'fitment' AND nu < 2 AND pr <= 4 - nu)),
fin AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE product_type WHEN 'fitment' THEN 1 ELSE 2 END, final_score DESC, sku) AS rn,
  count(*) OVER (PARTITION BY user_id) AS rec_count FROM sel)"""


@query("D39", "user_id:l rn:l sku product_type slot_source final_score:d2", "SELECT * FROM fin WHERE rec_count >= 4 AND rn <= 4", RESERVED)
def reserved_slots(t):
    fit = scored(t).select(*PROFILE, "sku", "norm_sku", "base_sku", "category", F.lit("fitment").alias("product_type"),
                           F.col("popularity").alias("raw_score"), "final_score")
    uni = C.explode_pool(profiles(t), universal_pool(t).select("pool_rank", "sku", "category", "total_orders"), p.pool_size)
    uni = R.base_columns(uni.withColumn("raw_score", X.log_score("total_orders", 2.0))).select(
        *PROFILE, "sku", "norm_sku", "base_sku", "category", F.lit("universal").alias("product_type"), "raw_score",
        F.round("raw_score", 2).alias("final_score"))
    intent = I.intent_strongest(t.staged, p).select("user_id", "sku", F.col("intent").alias("boost"))
    rows = R.diversified_for_users(t.users, fit.unionByName(uni), PROFILE, 2, exclusion(t), intent, top=4, pool="product_type")
    return R.reserved_slots(rows)


@query("D42", "seg_make seg_model user_id:l rn:l sku final_score:d2", """
SELECT t.seg_make, t.seg_model, t.user_id, t.rn, t.sku, t.final_score FROM v_top t JOIN (
  SELECT seg_make, seg_model, user_id, row_number() OVER (PARTITION BY seg_make, seg_model ORDER BY n DESC, total DESC, top DESC, user_id) AS pick
  FROM (SELECT seg_make, seg_model, user_id, count(*) AS n, round(sum(final_score), 6) AS total, max(final_score) AS top FROM v_top GROUP BY ALL) a) b
  ON t.user_id = b.user_id AND b.pick = 1""")
def pick_user_per_key(t):
    return R.pick_user_per_key(top(t), PROFILE)


@query("D43", "user_id:l rec1_sku rec4_sku rec4_score:d2", """
SELECT user_id, rec1_sku, rec4_sku, rec4_score FROM v_wide WHERE rec_count = 4""")
def wide_output_exact(t):
    return R.wide_output(top(t), ["user_id"], p, ("sku", "final_score"), exact=True)


@query("D44", "user_id:l tier", """
SELECT user_id, CASE WHEN user_id IN (SELECT user_id FROM v_staged WHERE event_name = 'PLACED ORDER') THEN 'hot' ELSE 'cold' END AS tier FROM v_users""")
def engagement_binary(t):
    return R.engagement_binary(t.users, P.event_orders(t.staged))


@query("D44 K06", "user_id:l tier", """
SELECT u.user_id, CASE WHEN max(event_name IN ('PLACED ORDER', 'CART UPDATE')) THEN 'hot' WHEN max(event_name = 'VIEWED PRODUCT') THEN 'warm' ELSE 'cold' END AS tier
FROM v_users u LEFT JOIN v_staged s ON u.user_id = s.user_id GROUP BY u.user_id""")
def engagement_three(t):
    kind = F.when(F.col("event_name") == "VIEWED PRODUCT", "view").when(F.col("event_name") == "CART UPDATE", "cart").otherwise("order")
    return R.engagement_three(t.users, t.staged.withColumn("type", kind))


@query("D45", "user_id:l slot:l sku price:d2 score:d2", "SELECT * FROM v_long WHERE price >= 960")
def wide_to_long(t):
    return R.wide_to_long(wide(t), ["user_id"], 4, 960.0)
