"""Q01-Q29: quality queries over the flagship output and the engine tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.indexing import durable
from ..operators import contracts as T
from ..operators import popularity as P
from ..operators import quality as Q
from . import recs
from .registry import once, query

KEY = ["user_id"]


@once
def wide(t):
    """The published table, as a stage: written once, so the checks do not carry the pipeline's lineage."""
    return durable(recs.wide(t))


@once
def long(t):
    return Q.long_form(wide(t), ["user_id", *recs.PROFILE])


@once
def engine(t):
    """Engine tables derived from the orders: ids as text, one bad weight per returned line."""
    li = t.raw("lineitem")
    sold = t.raw("orders").join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    return {
        "users": t.users.select(F.col("user_id").cast("string")),
        "products": t.catalog.where("price >= 905").select(F.col("part_id").cast("string").alias("product_id"), "price"),
        "interactions": sold.select(
            F.col("o_custkey").cast("string").alias("user_id"), F.col("l_partkey").cast("string").alias("product_id"),
            F.when(F.col("l_linestatus") == "F", "order").alias("interaction_type"),
            F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("weight")),
    }


@query("Q01 Q02 Q04 Q05 Q06", "table_name check_name column_name n:l", """
SELECT 'interactions' AS table_name, 'null' AS check_name, 'interaction_type' AS column_name, count(*) AS n FROM lineitem WHERE l_linestatus <> 'F'
UNION ALL SELECT 'interactions', 'bad_number', 'weight', count(*) FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 0
UNION ALL SELECT 'interactions', 'orphan', 'product_id', count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_retailprice >= 905)""")
def contract_findings(t):
    f = T.value_findings(engine(t))
    return f.withColumnsRenamed({"table": "table_name", "check": "check_name", "column": "column_name"})


@query("Q02", "column_name n:l", """
SELECT 'interaction_type' AS column_name, count(*) FILTER (l_linestatus <> 'F') AS n FROM lineitem UNION ALL SELECT 'user_id', 0""")
def null_counts(t):
    return T.null_counts(engine(t)["interactions"], ["interaction_type", "user_id"]).withColumnRenamed("column", "column_name")


@query("Q04", "n:l", "SELECT count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1) a")
def duplicate_ids(t):
    return T.duplicate_keys(t.raw("orders"), "o_custkey")


@query("Q05 G14", "column_name n:l", """
SELECT 'weight' AS column_name, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 0""")
def bad_numbers(t):
    return T.bad_numbers(engine(t)["interactions"], ["weight"]).withColumnRenamed("column", "column_name")


@query("Q06 O03", "id", "SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_retailprice >= 905)")
def orphan_ids(t):
    e = engine(t)
    return T.orphans(e["interactions"], "product_id", e["products"], "product_id")


@query("Q08", "check_name n:l status", """
SELECT 'users' AS check_name, count(*) AS n, CASE WHEN count(*) >= 1000 THEN 'OK' ELSE 'WARNING' END AS status FROM v_users
UNION ALL SELECT 'staged_events', count(*), CASE WHEN count(*) >= 100000 THEN 'OK' ELSE 'WARNING' END FROM v_staged""")
def row_thresholds(t):
    a = Q.row_threshold(t.users, 1000, "users").unionByName(Q.row_threshold(t.staged, 100000, "staged_events"))
    return a.withColumnRenamed("check", "check_name")


SAME = " OR ".join(f"coalesce(rec{a}_sku = rec{b}_sku, FALSE)" for a in range(1, 5) for b in range(a + 1, 5))


@query("Q09", "violations:l users:l", f"SELECT count(*) FILTER ({SAME}) AS violations, count(*) AS users FROM v_wide")
def duplicate_slots(t):
    return Q.duplicate_slots(wide(t))


@query("Q10", "refurbished:l service:l", """
SELECT count(*) FILTER (sku IN (SELECT sku FROM v_catalog WHERE lower(tags) LIKE '%refurbished%')) AS refurbished,
  count(*) FILTER (regexp_matches(sku, '^(EXT|GIFT|WARRANTY|SERVICE|PREAUTH)-')) AS service FROM v_long""")
def forbidden_skus(t):
    return Q.forbidden_skus(long(t), t.catalog)


@query("Q11", "below:l min_price:d2 max_price:d2 avg_price:d2",
       "SELECT count(*) FILTER (price < 950) AS below, min(price) AS min_price, max(price) AS max_price, round(avg(price), 2) AS avg_price FROM v_long")
def price_floor_check(t):
    return Q.price_floor(long(t), 950.0)


@query("Q12", "slot:l recs:l below:l bad_images:l",
       "SELECT slot, count(*) AS recs, count(*) FILTER (price < 950) AS below, count(*) FILTER (image_url NOT LIKE 'https://%') AS bad_images FROM v_long GROUP BY slot")
def price_per_slot(t):
    return Q.price_per_slot(long(t), 950.0)


@query("Q12", "images:l https:l pct:d2", """
SELECT count(*) AS images, count(*) FILTER (image_url LIKE 'https://%') AS https, round(count(*) FILTER (image_url LIKE 'https://%') / count(*) * 100, 2) AS pct FROM v_long""")
def https_ratio(t):
    return Q.https_ratio(long(t))


ORDERED = "rec1_score >= rec2_score AND rec2_score >= rec3_score AND (rec4_score IS NULL OR rec3_score >= rec4_score)"


@query("Q13", "users:l ordered:l pct:d2", f"SELECT count(*) AS users, count(*) FILTER ({ORDERED}) AS ordered, round(count(*) FILTER ({ORDERED}) / count(*) * 100, 2) AS pct FROM v_wide")
def score_order(t):
    return Q.score_order(wide(t))


@query("Q14", "max_same:l violations:l", """
SELECT max(n) AS max_same, count(*) FILTER (n > 1) AS violations FROM (SELECT l.user_id, c.category, count(*) AS n FROM v_long l JOIN v_catalog c ON c.sku = l.sku GROUP BY ALL) a""")
def diversity_violations(t):
    return Q.diversity(long(t), t.catalog, KEY, 1)


@query("Q15", "with_min:l with_all:l unexpected:l avg_count:d2", """
SELECT count(*) FILTER (rec_count = 3) AS with_min, count(*) FILTER (rec_count = 4) AS with_all, count(*) FILTER (rec_count NOT IN (3, 4)) AS unexpected,
  round(avg(rec_count), 2) AS avg_count FROM v_wide""")
def count_distribution(t):
    return Q.count_distribution(wide(t))


@query("Q15", "value n:l pct:d2", "SELECT popularity_source AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM v_long) * 100, 2) AS pct FROM v_long GROUP BY 1")
def source_distribution(t):
    return Q.value_distribution(long(t), "popularity_source")


@query("Q16", "categories:l status", """
SELECT count(DISTINCT c.category) AS categories, CASE WHEN count(DISTINCT c.category) >= 5 THEN 'OK' ELSE 'WARNING' END AS status
FROM (SELECT DISTINCT sku FROM v_long) l LEFT JOIN v_catalog c ON c.sku = l.sku""")
def category_coverage(t):
    return Q.category_coverage(long(t), t.catalog, 5)


@query("Q17", "recs:l mismatch_rows:l mismatch_users:l status", """
SELECT count(*) AS recs, count(*) FILTER (f.sku IS NULL) AS mismatch_rows, count(DISTINCT CASE WHEN f.sku IS NULL THEN l.user_id END) AS mismatch_users,
  CASE WHEN count(*) FILTER (f.sku IS NULL) = 0 THEN 'OK' ELSE 'ERROR' END AS status
FROM v_long l JOIN v_users u ON u.user_id = l.user_id LEFT JOIN v_fitment f ON f.make = u.seg_make AND f.sku = l.sku""")
def fitment_match(t):
    return Q.fitment_match(long(t), t.fitment, KEY, {"seg_make": "make", "sku": "sku"})


@query("Q18", "users:l included:l excluded:l included_pct:d2 excluded_pct:d2", """
SELECT *, round(included / users * 100, 2) AS included_pct, round(excluded / users * 100, 2) AS excluded_pct FROM (
  SELECT count(*) AS users, count(e.make) AS included, count(*) - count(e.make) AS excluded FROM v_users u LEFT JOIN (
    SELECT make FROM v_eligible GROUP BY make HAVING count(DISTINCT category) >= 6 AND min(price) < 905.5) e ON e.make = u.seg_make) a""")
def generation_coverage(t):
    e = recs.eligible(t).groupBy("make").agg(F.count_distinct("category").alias("c"), F.min("price").alias("p")).where("c >= 6 and p < 905.5")
    return Q.generation_coverage(t.users, e, {"seg_make": "make"})


@query("Q19", "violations:l users:l", "SELECT count(*) AS violations, count(DISTINCT l.user_id) AS users FROM v_long l JOIN v_excl x ON x.user_id = l.user_id AND x.sku = regexp_replace(l.sku, '([0-9])[BRGP]$', '\\1')")
def exclusion_audit(t):
    return Q.exclusion_audit(long(t), recs.exclusion(t))


@query("Q20", "recs:l no_source:l mismatches:l", """
SELECT count(*) AS recs, count(*) FILTER (popularity_source IN ('none', '')) AS no_source,
  count(*) FILTER ((popularity_source = 'segment' AND s.sku IS NULL) OR (popularity_source = 'make' AND m.sku IS NULL) OR (popularity_source = 'global' AND g.sku IS NULL)) AS mismatches
FROM (SELECT l.*, u.seg_make, u.seg_model, regexp_replace(l.sku, '([0-9])[BRGP]$', '\\1') AS k FROM v_long l JOIN v_users u ON u.user_id = l.user_id) l
LEFT JOIN v_seg s ON s.seg_make = l.seg_make AND s.seg_model = l.seg_model AND s.sku = l.k
LEFT JOIN v_make m ON m.seg_make = l.seg_make AND m.sku = l.k LEFT JOIN v_glob g ON g.sku = l.k""")
def source_consistency(t):
    return Q.source_consistency(long(t), *recs.tiers(t))


@query("Q21", "base:l covered:l pct:d2", """
SELECT count(*) AS base, count(w.user_id) AS covered, round(count(w.user_id) / count(*) * 100, 2) AS pct FROM v_users u LEFT JOIN v_wide w ON w.user_id = u.user_id""")
def base_coverage(t):
    return Q.coverage(wide(t), t.users, KEY)


@once
def board(t):
    facts = Q.board_facts(long(t), recs.exclusion(t), t.catalog, KEY, 950.0, 2, 3)
    return Q.check_board([Q.check_rows(facts, [
        ("duplicates", "duplicate_slots", "CRITICAL", 0, False), ("bought", "purchased", "CRITICAL", 0, False), ("below", "below_950", "HIGH", 0, False),
        ("over", "diversity", "HIGH", 0, False), ("https_pct", "https_pct", "MEDIUM", 100, False), ("with_min", "three_recs", "LOW", 0, True)])])


@query("Q22 K05 T01", "check_name severity value:d2 expected:d2 status severity_rank:l", f"""
SELECT 'duplicate_slots' AS check_name, 'CRITICAL' AS severity, count(*) FILTER ({SAME}) AS value, 0 AS expected,
  CASE WHEN count(*) FILTER ({SAME}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, 0 AS severity_rank FROM v_wide
UNION ALL SELECT 'purchased', 'CRITICAL', count(*), 0, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, 0 FROM v_long l JOIN v_excl x ON x.user_id = l.user_id AND x.sku = regexp_replace(l.sku, '([0-9])[BRGP]$', '\\1')
UNION ALL SELECT 'below_950', 'HIGH', count(*) FILTER (price < 950), 0, CASE WHEN count(*) FILTER (price < 950) = 0 THEN 'PASS' ELSE 'FAIL' END, 1 FROM v_long
UNION ALL SELECT 'diversity', 'HIGH', count(*) FILTER (n > 2), 0, CASE WHEN count(*) FILTER (n > 2) = 0 THEN 'PASS' ELSE 'FAIL' END, 1 FROM (SELECT l.user_id, c.category, count(*) AS n FROM v_long l JOIN v_catalog c ON c.sku = l.sku GROUP BY ALL) a
UNION ALL SELECT 'https_pct', 'MEDIUM', p, 100, CASE WHEN p = 100 THEN 'PASS' ELSE 'FAIL' END, 2 FROM (SELECT round(count(*) FILTER (image_url LIKE 'https://%') / count(*) * 100, 2) AS p FROM v_long) a
UNION ALL SELECT 'three_recs', 'LOW', count(*) FILTER (rec_count = 3), 0, 'INFO', 3 FROM v_wide""")
def check_board(t):
    return board(t).withColumnRenamed("check", "check_name")


@query("Q22", "user_id:l slot:l sku price:d2", """
SELECT user_id, slot, sku, price FROM v_long WHERE price < 950 ORDER BY price, user_id, slot LIMIT 20""")
def failing_samples(t):
    low = long(t).where("price < 950").orderBy("price", "user_id", "slot")
    return Q.failing_samples(low, board(t), "below_950", 20)


@query("Q23 A13", "metric value:d1 expected", f"""
SELECT 'users' AS metric, count(*) AS value, '>0' AS expected FROM v_wide
UNION ALL SELECT 'duplicate_skus', count(*) FILTER ({SAME}), '0' FROM v_wide
UNION ALL SELECT 'below_floor', count(*) FILTER (rec1_price < 950 OR rec2_price < 950 OR rec3_price < 950 OR rec4_price < 950), '0' FROM v_wide
UNION ALL SELECT 'order_violations', count(*) FILTER (NOT ({ORDERED})), '0' FROM v_wide
UNION ALL SELECT 'missing_slot1', count(*) FILTER (rec1_sku IS NULL), '0' FROM v_wide""")
def health_board(t):
    return Q.health_board(wide(t), 950.0)


@query("Q24", "users:l duplicate_users:l missing_slot1:l below_floor:l order_violations:l too_few_users:b low_coverage:b", f"""
SELECT count(*) AS users, count(*) - count(DISTINCT user_id) AS duplicate_users, count(*) FILTER (rec1_sku IS NULL) AS missing_slot1,
  count(*) FILTER (rec1_price < 950) + count(*) FILTER (rec2_price < 950) + count(*) FILTER (rec3_price < 950) + count(*) FILTER (rec4_price < 950) AS below_floor,
  count(*) FILTER (NOT ({ORDERED})) AS order_violations, count(*) < 100 AS too_few_users, count(*) < 0.9 * 1000 AS low_coverage FROM v_wide""")
def output_findings(t):
    w = wide(t)
    for i in range(1, 5):
        w = w.withColumnRenamed(f"rec{i}_sku", f"rec{i}_product_id")
    return Q.output_findings(w, 1000, 100, 0.9, 950.0)


@query("Q25", "empty:l unexpected:l inconsistent:l", """
SELECT count(*) FILTER (rec4_sku IS NULL) AS empty, count(*) FILTER (rec4_sku IS NULL AND rec_count <> 3) AS unexpected,
  count(*) FILTER (rec4_sku IS NOT NULL AND rec_count <> 4) AS inconsistent FROM v_wide""")
def null_fourth_slot(t):
    return Q.null_fourth_slot(wide(t))


@query("Q26 A06", "median:d2 p95:d2 zero:l negative:l above_low:l above_high:l", """
SELECT quantile_disc(score, 0.5) AS median, quantile_disc(score, 0.95) AS p95, count(*) FILTER (score = 0) AS zero, count(*) FILTER (score < 0) AS negative,
  count(*) FILTER (score > 20) AS above_low, count(*) FILTER (score > 40) AS above_high FROM v_long""")
def score_summary(t):
    return Q.score_summary(long(t))


@query("Q27", "users:l shown:l pct:d2", """
SELECT count(*) AS users, count(*) FILTER (hit) AS shown, round(count(*) FILTER (hit) / count(*) * 100, 2) AS pct FROM (
  SELECT coalesce(rec1_sku = 'P40B', FALSE) OR coalesce(rec2_sku = 'P40B', FALSE) OR coalesce(rec3_sku = 'P40B', FALSE) OR coalesce(rec4_sku = 'P40B', FALSE) AS hit
  FROM v_wide WHERE seg_model = 'MACHINERY') a""")
def product_dominance(t):
    return Q.dominance(wide(t), F.col("seg_model") == "MACHINERY", "P40B")


@query("Q28", "name values:l", "SELECT name, count(DISTINCT category) AS values FROM v_catalog GROUP BY name HAVING count(DISTINCT category) > 1")
def conflicting_attribute(t):
    return Q.conflicting_attribute(t.catalog, "name", "category")


@query("Q29", "level groups:l skus:l orders:l avg_score:d2", """
SELECT 'segment' AS level, count(DISTINCT concat(seg_make, '/', seg_model)) AS groups, count(DISTINCT sku) AS skus, sum(total_segment_orders) AS orders, round(avg(segment_score), 2) AS avg_score FROM v_seg
UNION ALL SELECT 'make', count(DISTINCT seg_make), count(DISTINCT sku), sum(total_make_orders), round(avg(make_score), 2) FROM v_make""")
def popularity_coverage(t):
    seg, mk, _ = recs.tiers(t)
    return P.popularity_coverage(seg, mk)
