"""A, J, O, P, T, W: the relational operators on the raw tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions import keyed as K
from ..functions import sketches as Q
from ..functions.asof import asof_join
from ..functions.indexing import durable
from ..functions.pairs import array_pairs, sized_baskets
from ..functions.ranges import interval_join
from .registry import query

MONEY = "decimal(15,2)"


@query("A01", "l_returnflag l_linestatus n:l qty:d2 avg_qty:d4 min_price:d2 max_price:d2", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(15,2))) AS qty, avg(CAST(l_quantity AS DECIMAL(15,2))) AS avg_qty,
  min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price FROM lineitem GROUP BY ALL""")
def grouped_aggregates(t):
    q = F.col("l_quantity").cast(MONEY)
    return t.raw("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(q).alias("qty"), F.avg(q).alias("avg_qty"), F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"))


@query("A02 A03", "o_orderstatus customers:l big_customers:l big_orders:l urgent_value:d2", """
SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT CASE WHEN o_totalprice > 200000 THEN o_custkey END) AS big_customers,
  count(*) FILTER (o_totalprice > 200000) AS big_orders, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(15,2)) END) AS urgent_value FROM orders GROUP BY 1""")
def distinct_and_conditional(t):
    big = F.col("o_totalprice") > 200000
    return t.raw("orders").groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"), F.count_distinct(F.when(big, F.col("o_custkey"))).alias("big_customers"), F.count_if(big).alias("big_orders"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice").cast(MONEY))).alias("urgent_value"))


@query("A04", "o_custkey:l n:l", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")
def having(t):
    return t.raw("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n >= 12")


@query("A05", "l_suppkey:l std_qty:d6", "SELECT l_suppkey, stddev_samp(l_quantity) AS std_qty FROM lineitem GROUP BY 1")
def sample_stddev(t):
    return t.raw("lineitem").groupBy("l_suppkey").agg(F.stddev_samp("l_quantity").alias("std_qty"))


@query("A06", "o_orderstatus q1:d2 median:d2 p95:d2", """
SELECT o_orderstatus, quantile_disc(o_totalprice, 0.25) AS q1, quantile_disc(o_totalprice, 0.5) AS median, quantile_disc(o_totalprice, 0.95) AS p95 FROM orders GROUP BY 1""")
def quantiles(t):
    q = F.percentile_approx("o_totalprice", [0.25, 0.5, 0.95], 1_000_000)
    return t.raw("orders").groupBy("o_orderstatus").agg(q.alias("q")).select("o_orderstatus", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("p95"))


@query("A06", "event_type day n:l median_ok:b p95_ok:b", """
SELECT e.event_type, d.day, count(*) AS n, TRUE AS median_ok, TRUE AS p95_ok FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM events WHERE value IS NOT NULL) d
JOIN events e ON e.event_type = d.event_type AND CAST(e.ts AS DATE) BETWEEN d.day - 6 AND d.day AND e.value IS NOT NULL GROUP BY ALL""")
def quantiles_of_stored_sketches(t):
    """Weekly quantiles from stored daily sketches, each with whether its rank in the window's values is right to within three times the stated error."""
    day, share = F.col("ts").cast("date"), {"median": 0.5, "p95": 0.95}
    stored = durable(Q.daily_sketches(t.raw("events"), ["event_type"], day, "value"))
    week = Q.window_sketches(stored, ["event_type"], 7)
    week = week.select("event_type", "day", Q.count("sketch").alias("n"), *[Q.quantile("sketch", s).alias(k) for k, s in share.items()])
    values = t.raw("events").where("value is not null").groupBy("event_type", day.alias("day"), "value").agg(F.count(F.lit(1)).alias("c"))
    values = values.withColumn("day", F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.date_add("day", i))))
    ranks = [F.sum(F.when(F.col("value") < F.col(k), F.col("c")).otherwise(0)).alias(f"{k}_below") for k in share] + [
        F.sum(F.when(F.col("value") <= F.col(k), F.col("c")).otherwise(0)).alias(f"{k}_upto") for k in share]
    seen = values.join(week, ["event_type", "day"]).groupBy("event_type", "day", "n").agg(*ranks)
    slack = 3 * Q.RANK_ERROR
    right = [((F.col(f"{k}_below") <= (s + slack) * F.col("n")) & (F.col(f"{k}_upto") >= (s - slack) * F.col("n"))).alias(f"{k}_ok") for k, s in share.items()]
    return seen.select("event_type", "day", "n", *right)


@query("A07", "order_id:l items:l first_sku last_sku", """
SELECT order_id, count(*) AS items, min(sku) AS first_sku, max(sku) AS last_sku FROM (SELECT DISTINCT order_id, sku FROM v_orders) a GROUP BY 1 HAVING count(*) BETWEEN 2 AND 20""")
def bounded_arrays(t):
    arr = sized_baskets(t.orders, ["order_id"], "sku", 2, 20).withColumnRenamed("_items", "a")
    return arr.select("order_id", F.size("a").alias("items"), F.element_at("a", 1).alias("first_sku"), F.element_at("a", -1).alias("last_sku"))


@query("A08 O02", "key:l", "SELECT DISTINCT o_custkey AS key FROM orders UNION SELECT user_id FROM events")
def distinct_union(t):
    return t.raw("orders").select(F.col("o_custkey").alias("key")).union(t.raw("events").select("user_id")).distinct()


@query("A09", "o_orderkey:l line1:d2 line2:d2 line3:d2", """
SELECT l_orderkey AS o_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) AS line1, max(CASE WHEN l_linenumber = 2 THEN l_extendedprice END) AS line2,
  max(CASE WHEN l_linenumber = 3 THEN l_extendedprice END) AS line3 FROM lineitem GROUP BY 1""")
def pivot_slots(t):
    return t.raw("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[F.max(F.when(F.col("l_linenumber") == i, F.col("l_extendedprice"))).alias(f"line{i}") for i in (1, 2, 3)])


@query("A10", "n_orders:l customers:l value:d2", """
SELECT n_orders, count(*) AS customers, sum(v) AS value FROM (SELECT o_custkey, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS v FROM orders GROUP BY 1) a GROUP BY 1""")
def two_level(t):
    return K.two_level(t.raw("orders"), ["o_custkey"], [F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast(MONEY)).alias("v")],
                       ["n_orders"], [F.count(F.lit(1)).alias("customers"), F.sum("v").alias("value")])


@query("A11", "o_custkey:l pct_urgent:d2 per_cancelled:d4", """
SELECT o_custkey, round(count(*) FILTER (o_orderpriority = '1-URGENT') / count(*) * 100, 2) AS pct_urgent,
  count(*) / nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS per_cancelled FROM orders GROUP BY 1""")
def guarded_ratio(t):
    n = F.count(F.lit(1))
    return t.raw("orders").groupBy("o_custkey").agg(X.pct(F.count_if(F.col("o_orderpriority") == "1-URGENT"), n).alias("pct_urgent"),
                                                    X.safe_div(n, F.count_if(F.col("o_orderstatus") == "P")).alias("per_cancelled"))


@query("A12 W06", "o_orderstatus o_orderpriority n:l share:d6", """
SELECT *, n / sum(n) OVER (PARTITION BY o_orderstatus) AS share FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) a""")
def share_of_group(t):
    return K.share_of_group(t.raw("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n")), ["o_orderstatus"], "n")


@query("A13", "metric value:d2", """
SELECT 'orders' AS metric, count(*) AS value FROM orders UNION ALL SELECT 'customers', count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'largest', max(o_totalprice) FROM orders""")
def metric_rows(t):
    row = t.raw("orders").agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers"), F.max("o_totalprice").alias("largest"))
    return K.metric_rows(row, ["orders", "customers", "largest"])


@query("J01", "n_name orders:l value:d2", """
SELECT n_name, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def inner_join(t):
    per = t.raw("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast(MONEY)).alias("v"))
    c = t.raw("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return per.join(c, "c_custkey").join(t.raw("nation"), "n_nationkey").groupBy("n_name").agg(F.sum("n").alias("orders"), F.sum("v").alias("value"))


@query("J02 P11", "c_custkey:l events:l has_events:b", """
SELECT c_custkey, coalesce(e.n, 0) AS events, e.user_id IS NOT NULL AS has_events FROM customer LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e ON e.user_id = c_custkey""")
def left_join_flag(t):
    e = t.raw("events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return t.raw("customer").join(e, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("events"), F.col("n").isNotNull().alias("has_events"))


@query("J03", "day views:l clicks:l purchases:l", """
SELECT coalesce(v.d, c.d, p.d) AS day, v.n AS views, c.n AS clicks, p.n AS purchases FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE event_type = 'view' AND value > 100 GROUP BY 1) v
FULL JOIN (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE event_type = 'click' AND value > 150 GROUP BY 1) c ON v.d = c.d
FULL JOIN (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE event_type = 'purchase' AND value > 200 GROUP BY 1) p ON coalesce(v.d, c.d) = p.d""")
def full_join_three(t):
    def per_day(kind, least, name):
        return t.raw("events").where((F.col("event_type") == kind) & (F.col("value") > least)).groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias(name))

    return per_day("view", 100, "views").join(per_day("click", 150, "clicks"), "day", "full").join(per_day("purchase", 200, "purchases"), "day", "full")


@query("J05 J06", "c_custkey:l c_name", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def anti_joins(t):
    rest = K.not_in(t.raw("customer"), t.raw("events"), ["c_custkey"], ["user_id"])
    return rest.join(t.raw("orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_anti")


@query("J07", "p_partkey:l p_name", "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)")
def semi_join(t):
    return t.raw("part").join(t.raw("lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi")


@query("J08", "a:l b:l n:l", """
SELECT a.s AS a, b.s AS b, count(*) AS n FROM (SELECT DISTINCT l_orderkey AS o, l_suppkey AS s FROM lineitem) a JOIN (SELECT DISTINCT l_orderkey AS o, l_suppkey AS s FROM lineitem) b
ON a.o = b.o AND a.s < b.s WHERE a.o IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) BETWEEN 2 AND 20) GROUP BY ALL""")
def pairs_in_group(t):
    arr = sized_baskets(t.raw("lineitem"), ["l_orderkey"], "l_suppkey", 2, 20)
    return array_pairs(arr, ["l_orderkey"]).groupBy(F.col("item_a").alias("a"), F.col("item_b").alias("b")).agg(F.count(F.lit(1)).alias("n"))


@query("J09", "user_id:l seg_make seg_year:l generation", """
SELECT u.user_id, u.seg_make, u.seg_year, g.generation FROM v_users u LEFT JOIN v_generations g ON g.make = u.seg_make AND u.seg_year BETWEEN g.year_start AND g.year_end""")
def generation_range_join(t):
    """Every user with the generations of the make that hold the year."""
    g = t.generations.withColumnRenamed("make", "seg_make")
    rows = t.users.select("user_id", "seg_make", "seg_year")
    return interval_join(rows, g, ["seg_make"], "seg_year", "year_start", "year_end", "left").select("user_id", "seg_make", "seg_year", "generation")


@query("J11", "purchase_id:l view_id:l", """
SELECT purchase_id, view_id FROM (SELECT p.event_id AS purchase_id, v.event_id AS view_id, row_number() OVER (PARTITION BY p.event_id ORDER BY v.ts DESC, v.event_id DESC) AS rn
  FROM events p JOIN events v ON v.user_id = p.user_id AND v.event_type = 'view' AND p.ts > v.ts AND p.ts <= v.ts + INTERVAL 24 HOUR WHERE p.event_type = 'purchase') a WHERE rn = 1""")
def time_window_join(t):
    e = t.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))
    p = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), "ts")
    v = e.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    return asof_join(p, v, ["user_id"], "ts", "view_ts", "view_id", 86400)


@query("J12", "c_custkey:l related:l", """
SELECT c.c_custkey, count(DISTINCT CASE WHEN r.a = c.c_nationkey THEN r.b ELSE r.a END) AS related FROM customer c JOIN (
  SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey) r ON r.a = c.c_nationkey OR r.b = c.c_nationkey GROUP BY 1""")
def either_side_join(t):
    """The OR condition as a union of both directions and one equi-join."""
    n = t.raw("nation").select("n_regionkey", F.col("n_nationkey").alias("x"))
    pairs = n.join(n.withColumnRenamed("x", "y"), "n_regionkey").where("x <> y").select(F.col("x").alias("c_nationkey"), "y")
    return t.raw("customer").join(pairs, "c_nationkey").groupBy("c_custkey").agg(F.count_distinct("y").alias("related"))


@query("J13", "base n:l qty:d2", f"""
SELECT regexp_replace(c.sku, '([0-9])[BRGP]$', '\\1') AS base, count(*) AS n, sum(o.line) AS qty FROM v_orders o JOIN v_catalog c
ON regexp_replace(o.sku, '([0-9])[BRGP]$', '\\1') = regexp_replace(c.sku, '([0-9])[BRGP]$', '\\1') GROUP BY 1""")
def computed_key_join(t):
    o = t.orders.groupBy(X.normalize_variant("sku").alias("base")).agg(F.count(F.lit(1)).alias("n"), F.sum("line").alias("q"))
    c = t.catalog.groupBy(X.normalize_variant("sku").alias("base")).agg(F.count(F.lit(1)).alias("k"))
    return o.join(c, "base").select("base", (F.col("n") * F.col("k")).alias("n"), (F.col("q") * F.col("k")).alias("qty"))


@query("J14 J15", "o_orderstatus n:l pct_of_all:d4 above_avg:l", """
SELECT o_orderstatus, count(*) AS n, count(*) / (SELECT count(*) FROM orders) * 100 AS pct_of_all, count(*) FILTER (o_totalprice > (SELECT avg(CAST(o_totalprice AS DECIMAL(15,2))) FROM orders)) AS above_avg FROM orders GROUP BY 1""")
def scalar_subqueries(t):
    o = t.raw("orders")
    row = o.withColumn("mean", o.agg(F.avg(F.col("o_totalprice").cast(MONEY)).cast("double")).scalar()).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_totalprice") > F.col("mean")).alias("above_avg"))
    return row.withColumn("pct_of_all", F.col("n") / o.agg(F.count(F.lit(1))).scalar() * 100)


@query("O01", "kind key:l value:d2", """
SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS value FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier UNION ALL SELECT 'part', p_partkey, NULL FROM part""")
def union_all(t):
    c = t.raw("customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("value"))
    s = t.raw("supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("value"))
    x = t.raw("part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("key"))
    return c.unionByName(s).unionByName(x, allowMissingColumns=True)


@query("O03", "key:l", "SELECT c_custkey AS key FROM customer EXCEPT SELECT user_id FROM events")
def set_difference(t):
    return t.raw("customer").select(F.col("c_custkey").alias("key")).join(t.raw("events").select(F.col("user_id").alias("key")).distinct(), "key", "left_anti")


@query("O04", "user_id:l", "SELECT user_id FROM events WHERE event_type = 'view' AND value > 100 INTERSECT SELECT user_id FROM events WHERE event_type = 'click' AND value > 100")
def set_overlap(t):
    e = t.raw("events").where("value > 100 and event_type in ('view', 'click')")
    return e.groupBy("user_id").agg(F.count_distinct("event_type").alias("k")).where("k = 2")


@query("P01", "o_orderkey:l status", "SELECT o_orderkey, o_orderstatus AS status FROM orders")
def projection(t):
    return t.raw("orders").withColumnRenamed("o_orderstatus", "status").drop("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("P02", "l_orderkey:l l_linenumber:l", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag IN ('A', 'R') AND l_linestatus NOT IN ('F') AND l_linenumber IN (SELECT unnest([1, 2, 3]))""")
def comparisons(t):
    return t.raw("lineitem").where(F.col("l_quantity").between(10, 20) & F.col("l_returnflag").isin("A", "R") & ~F.col("l_linestatus").isin("F")
                                   & F.array_contains(F.array(F.lit(1), F.lit(2), F.lit(3)), F.col("l_linenumber")))


@query("P03", "p_partkey:l starts:b has:b prefix:b pattern:b", """
SELECT p_partkey, p_name LIKE 's%' AS starts, p_name LIKE '%ring%' AS has, starts_with(p_brand, 'Brand#1') AS prefix, regexp_matches(p_brand, '#[0-9]$') AS pattern FROM part""")
def patterns(t):
    return t.raw("part").select("p_partkey", F.col("p_name").like("s%").alias("starts"), F.col("p_name").like("%ring%").alias("has"),
                                F.col("p_brand").startswith("Brand#1").alias("prefix"), F.col("p_brand").rlike("#[0-9]$").alias("pattern"))


@query("P09 T01", "bucket n:l rank:l", """
SELECT b AS bucket, count(*) AS n, CASE b WHEN 'small' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS rank FROM (
  SELECT CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium' ELSE 'large' END AS b FROM orders) a GROUP BY 1""")
def buckets(t):
    b = X.bucket("o_totalprice", (100000.0, 300000.0), ("small", "medium", "large"))
    rows = t.raw("orders").groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("rank", F.when(F.col("bucket") == "small", 0).when(F.col("bucket") == "medium", 1).otherwise(2)).orderBy("rank")


@query("T02 W03", "rank:l o_orderkey:l o_totalprice:d2", "SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500")
def global_top(t):
    return K.global_top(t.raw("orders"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 500)


@query("T03 W02", "o_custkey:l rn:l o_orderkey:l", """
SELECT * FROM (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn, o_orderkey FROM orders) a WHERE rn <= 3""")
def top_n_per_key(t):
    return K.top_n_per_key(t.raw("orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("W01", "user_id:l event_id:l event_type", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) a WHERE rn = 1")
def latest_per_key(t):
    return K.first_per_key(t.raw("events"), ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query("W04", "event_id:l n:l total:d2 top:d2", """
SELECT event_id, count(*) OVER w AS n, sum(CAST(value AS DECIMAL(12,2))) OVER w AS total, max(value) OVER w AS top FROM events WINDOW w AS (PARTITION BY user_id)""")
def group_totals(t):
    return K.with_group_total(t.raw("events"), ["user_id"], n=F.count(F.lit(1)), total=F.sum(F.col("value").cast("decimal(12,2)")), top=F.max("value"))


@query("W05", "event_type day n:l next_n:l next2_n:l diff:l", """
SELECT event_type, day, n, lead(n) OVER w AS next_n, lead(n, 2) OVER w AS next2_n, lead(n) OVER w - n AS diff FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL) a
WINDOW w AS (PARTITION BY event_type ORDER BY day)""")
def lead_values(t):
    d = t.raw("events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("event_type").orderBy("day")  # one row per day
    return d.withColumns({"next_n": F.lead("n").over(w), "next2_n": F.lead("n", 2).over(w), "diff": F.lead("n").over(w) - F.col("n")})


@query("W07", "user_id:l treatment_id:l tracking_id:l nth:l", """
SELECT * FROM (SELECT user_id, treatment_id, tracking_id, row_number() OVER (PARTITION BY user_id, treatment_id ORDER BY sent_ts, tracking_id) AS nth FROM v_sends) a WHERE nth <= 3""")
def nth_send(t):
    return K.top_n_per_key(t.sends, ["user_id", "treatment_id"], [F.asc("sent_ts"), F.asc("tracking_id")], 3, "nth")


@query("A01", "c_custkey:l upper_name short padded format_id year:l month_start weeks_monday sunday age_days:l plus_week hour:l", """
SELECT o_custkey AS c_custkey, upper(o_orderpriority) AS upper_name, substr(o_orderpriority, 1, 3) AS short, concat(o_orderstatus, '|', trim(' x ')) AS padded, 'id-' || o_orderkey AS format_id,
  year(o_orderdate) AS year, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS weeks_monday,
  CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) AS sunday, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS age_days,
  CAST(CAST(o_orderdate AS DATE) + 7 AS DATE) AS plus_week, hour(o_orderdate) AS hour FROM orders""")
def scalar_functions(t):
    d = F.col("o_orderdate")
    return t.raw("orders").select(
        F.col("o_custkey").alias("c_custkey"), F.upper("o_orderpriority").alias("upper_name"), F.substring("o_orderpriority", 1, 3).alias("short"),
        F.concat("o_orderstatus", F.lit("|"), F.trim(F.lit(" x "))).alias("padded"), F.format_string("id-%d", "o_orderkey").alias("format_id"), F.year(d).alias("year"),
        F.date_format(F.date_trunc("month", d), "yyyy-MM-dd").alias("month_start"), F.date_format(F.date_trunc("week", d), "yyyy-MM-dd").alias("weeks_monday"),
        X.week_sunday(F.to_date(d)).alias("sunday"), F.datediff(F.lit("2001-08-01").cast("date"), F.to_date(d)).alias("age_days"),
        F.date_add(F.to_date(d), 7).alias("plus_week"), F.hour(d).alias("hour"))
