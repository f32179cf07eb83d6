"""Source and sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.indexing import shared_folder
from ..params import TEST_PARAMS as p
from ..sources import bags, sinks, tables
from .registry import once, query

FEED = """feed AS (SELECT ' ' || lower(o.sku) AS item, upper(u.email) || ' ' AS ship_to_email,
  CASE WHEN o.line = 7 THEN 'no date' ELSE strftime(o.order_date, '%A, %B ') || CAST(day(o.order_date) AS VARCHAR) || strftime(o.order_date, ', %Y') END AS order_date, o.order_date AS d, o.sku AS s, o.line
  FROM v_orders o JOIN v_users u ON u.user_id = o.user_id)"""


@once
def feed(t):
    """The orders as the text feed delivers them: padded sku, upper-case mail, long English date."""
    rows = t.orders.join(t.users.select("user_id", "email"), "user_id")
    text = F.concat(F.date_format("order_date", "EEEE, MMMM d, yyyy"))
    return rows.select(F.concat(F.lit(" "), F.lower("sku")).alias("item"), F.concat(F.upper("email"), F.lit(" ")).alias("ship_to_email"),
                       F.when(F.col("line") == 7, "no date").otherwise(text).alias("order_date"))


@query("S01 P02", "status n:l total:d2", """
SELECT o_orderstatus AS status, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1998-02-28' GROUP BY 1""")
def scan_range(t):
    rows = tables.scan_range(t.raw("orders"), "o_orderdate", "1997-03-01", "1998-02-28")
    return rows.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("total"))


@query("S02", "property_name n:l users:l", """
SELECT property_name, count(*) AS n, count(DISTINCT user_id) AS users FROM (
  SELECT user_id, unnest(CASE event_type WHEN 'view' THEN ['ProductID', 'Price', 'ImageURL'] WHEN 'click' THEN
    ['Items_' || k % 3 || '.ProductId', 'Items_' || k % 3 || '.ItemPrice', 'Items_' || k % 3 || '.ImageUrl'] ELSE ['Items_' || k % 3 || '.ProductId', 'Subtotal', 'OrderNo'] END) AS property_name
  FROM v_events WHERE event_name IS NOT NULL) a GROUP BY 1""")
def explode_props(t):
    return bags.explode_props(t.event_bags).groupBy("p.property_name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("S03 P01", "user_id:l subtotal:d2 order_no:l either", """
SELECT user_id, CASE WHEN event_name = 'PLACED ORDER' THEN price END AS subtotal, CASE WHEN event_name = 'PLACED ORDER' THEN event_id END AS order_no,
  CASE event_name WHEN 'VIEWED PRODUCT' THEN lower(sku) END AS either FROM v_staged""")
def first_property(t):
    """No explode: the bag is searched inside the row; the second name is only used if the first is absent."""
    b = t.event_bags
    return b.select("user_id", X.prop("props", "Subtotal")["double_value"].alias("subtotal"), X.prop("props", "OrderNo", "Order_No")["long_value"].alias("order_no"),
                    X.prop("props", "ProductId", "ProductID")["string_value"].alias("either"))


@query("S04", "kind n:l n_text:l n_num:l total:d2", """
SELECT kind, count(*) AS n, count(*) AS n_text_all, count(*) FILTER (kind <> 'Price' AND kind <> 'Subtotal') AS n_text, count(*) FILTER (kind <> 'Image') AS n_num, sum(v) AS total FROM (
  SELECT 'Price' AS kind, CAST(price AS DECIMAL(12,2)) AS v FROM v_staged WHERE event_name = 'VIEWED PRODUCT'
  UNION ALL SELECT 'ItemPrice', CAST(price AS DECIMAL(12,2)) FROM v_staged WHERE event_name = 'CART UPDATE'
  UNION ALL SELECT 'Subtotal', CAST(price AS DECIMAL(12,2)) FROM v_staged WHERE event_name = 'PLACED ORDER'
  UNION ALL SELECT 'OrderNo', event_id FROM v_staged WHERE event_name = 'PLACED ORDER') a GROUP BY kind""")
def mixed_values(t):
    rows = bags.explode_props(t.event_bags).select(F.regexp_replace("p.property_name", r"^Items_\d+\.", "").alias("kind"),
                                                   X.prop_text("p").alias("text"), X.prop_num("p").alias("num"))
    return rows.where(F.col("kind").isin("Price", "ItemPrice", "Subtotal", "OrderNo")).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.count("text").alias("n_text"), F.count("num").alias("n_num"), F.sum(F.col("num").cast("decimal(14,2)")).alias("total"))


@query("S05 W01", "user_id:l email year:l make model", """
SELECT user_id, email, seg_year AS year, upper(seg_make) AS make, upper(seg_model) AS model FROM v_users WHERE balance >= 0""")
def latest_attributes(t):
    return bags.latest_attributes(t.attributes)


@query("S07", "user_id:l sku event_name event_ts price:d2 image_raw", """
SELECT user_id, sku, event_name, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, CASE WHEN event_name <> 'PLACED ORDER' THEN price END AS price,
  CASE event_name WHEN 'VIEWED PRODUCT' THEN '//img.example/' || sku WHEN 'CART UPDATE' THEN 'http://img.example/' || sku END AS image_raw FROM v_staged""")
def stage_events(t):
    return bags.stage_events(t.event_bags).withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("S08", "user_id:l sku event_name price:d2 image_raw", """
SELECT user_id, sku, event_name, CASE WHEN event_name <> 'PLACED ORDER' THEN price END AS price,
  CASE event_name WHEN 'VIEWED PRODUCT' THEN '//img.example/' || sku WHEN 'CART UPDATE' THEN 'http://img.example/' || sku END AS image_raw FROM v_staged""")
def stage_events_simple(t):
    return bags.stage_events_simple(t.event_bags)


@query("S09 P04", "sku email order_date is_popularity:l is_exclusion:l", """
SELECT regexp_replace(upper(trim(item)), '([0-9])[BRGP]$', '\\1') AS sku, lower(trim(ship_to_email)) AS email, d AS order_date,
  CASE WHEN d BETWEEN DATE '1995-01-01' AND DATE '2000-12-31' THEN 1 ELSE 0 END AS is_popularity, CASE WHEN d BETWEEN DATE '2000-08-01' AND DATE '2024-01-20' THEN 1 ELSE 0 END AS is_exclusion
FROM feed WHERE line <> 7 AND d BETWEEN DATE '1995-01-01' AND DATE '2024-01-20'""", FEED)
def import_orders(t):
    return tables.import_orders(feed(t), p)


@query("S10", "treatment_id:l name kind sends:l", """
SELECT s.treatment_id, n.name, n.kind, count(*) AS sends FROM v_sends s JOIN (VALUES (0, 'Post Purchase fitment', 'Personalized'), (1, 'Browse recovery', 'Static'), (2, 'Abandoned cart', 'Static')) n(treatment_id, name, kind)
ON n.treatment_id = s.treatment_id GROUP BY ALL""")
def literal_lookup(t):
    rows = [(0, "Post Purchase fitment", "Personalized"), (1, "Browse recovery", "Static"), (2, "Abandoned cart", "Static")]
    names = tables.literal_table(t.spark, rows, "treatment_id long, name string, kind string")
    return t.sends.join(F.broadcast(names), "treatment_id").groupBy("treatment_id", "name", "kind").agg(F.count(F.lit(1)).alias("sends"))


@query("S11", "treatment_id:l campaign sends:l", """
SELECT treatment_id, CASE WHEN treatment_id % 2 = 0 THEN 'Post Purchase' ELSE 'Other' END AS campaign, count(*) AS sends FROM v_sends GROUP BY ALL""")
def federated_names(t):
    """Treatment names of another database, which filters them and is read in ranges of the id."""
    from ..operators.campaign import campaign_of
    store = dict(t.treatment_store)
    names = tables.jdbc_table(t.spark, store.pop("url"), "treatments", by="treatment_id", parts=4, **store).where("status = 'live'")
    names = names.select(F.col("treatment_id"), F.col("name"))
    return t.sends.join(names, "treatment_id").groupBy("treatment_id", campaign_of("name").alias("campaign")).agg(F.count(F.lit(1)).alias("sends"))


@query("S12", "event_type n:l", "SELECT event_type, count(*) AS n FROM events WHERE ts <= TIMESTAMP '2024-01-10 12:00:00' GROUP BY 1")
def as_of_cutoff(t):
    return tables.as_of_cutoff(t.raw("events"), "ts", "2024-01-10 12:00:00").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("S13", "user_id:l last_event:l missing_rows:l", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS last_event, 0 AS missing_rows FROM events GROUP BY 1""")
def keyed_and_optional_read(t):
    path = f"{t.path}/events.parquet"
    rows = tables.read_keyed(t.spark, path, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    none = tables.read_optional(t.spark, f"{t.path}/no_such_table.parquet", t.raw("events").schema)
    return rows.select("user_id", F.col("event_id").alias("last_event")).withColumn("missing_rows", none.agg(F.count(F.lit(1))).scalar())


def _scratch(t, name):
    """Fresh folder under the shared checkpoint folder of the session."""
    return f"{shared_folder(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("K01", "event_date n:l users:l", "SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS n, count(DISTINCT user_id) AS users FROM v_staged GROUP BY 1")
def partitioned_table(t):
    path = _scratch(t, "k01")
    sinks.replace_partitioned(t.staged, path, "event_ts", ["user_id", "sku"])
    return t.spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("K02", "rows:l same:b", "SELECT count(*) AS rows, TRUE AS same FROM v_users UNION ALL SELECT count(*), TRUE FROM v_users")
def publish_with_copy(t):
    back = sinks.publish(t.users, _scratch(t, "k02"))
    n = t.users.agg(F.count(F.lit(1))).scalar()
    return back.select("rows", (F.col("rows") == n).alias("same"))


@query("K03", "disposition n:l", "SELECT 'truncate' AS disposition, count(*) AS n FROM v_users UNION ALL SELECT 'append', 2 * count(*) FROM v_users")
def shadow_write(t):
    a, b = _scratch(t, "k03"), _scratch(t, "k03")
    sinks.write_shadow(t.users, a, "fail")
    sinks.write_shadow(t.users, a, "truncate")
    sinks.write_shadow(t.users, b, "truncate")
    sinks.write_shadow(t.users, b, "append")

    def count(path, name):
        return t.spark.read.parquet(path).agg(F.lit(name).alias("disposition"), F.count(F.lit(1)).alias("n"))

    return count(a, "truncate").unionByName(count(b, "append"))


@query("K04", "metric value:d4", """
SELECT 'events' AS metric, count(*) AS value FROM v_events UNION ALL SELECT 'avg_price', avg(CAST(price AS DECIMAL(12,2))) FROM v_events""")
def json_report(t):
    row = t.events.agg(F.count(F.lit(1)).alias("events"), F.avg(F.col("price").cast("decimal(12,2)")).cast("double").alias("avg_price"))
    path = _scratch(t, "k04")
    sinks.write_report(sinks.metrics_report(row, {"k": "4"}, {"name": "m"}), path)
    return sinks.read_report(t.spark, path)


@query("K06", "user_id:l tier", """
SELECT u.user_id, coalesce(x.tier, 'cold') AS tier FROM v_users u LEFT JOIN (
  SELECT user_id, CASE WHEN count(*) FILTER (event_name <> 'VIEWED PRODUCT') > 0 THEN 'hot' ELSE 'warm' END AS tier FROM v_staged GROUP BY 1) x ON x.user_id = u.user_id""")
def update_tier(t):
    tier = t.staged.groupBy("user_id").agg(F.when(F.count_if(F.col("event_name") != "VIEWED PRODUCT") > 0, "hot").otherwise("warm").alias("tier"))
    return sinks.update_column(t.users.select("user_id", F.lit("cold").alias("tier")), tier, ["user_id"], "tier")


@query("K06", "user_id:l tier region:l touched:l", """
SELECT u.user_id, CASE WHEN u.user_id % 8 < 3 THEN coalesce(x.tier, 'cold') ELSE 'cold' END AS tier, u.user_id % 8 AS region,
  (SELECT count(DISTINCT user_id % 8) FROM v_staged WHERE user_id % 8 < 3 AND user_id IN (SELECT user_id FROM v_users)) AS touched
FROM v_users u LEFT JOIN (
  SELECT user_id, CASE WHEN count(*) FILTER (event_name <> 'VIEWED PRODUCT') > 0 THEN 'hot' ELSE 'warm' END AS tier FROM v_staged GROUP BY 1) x ON x.user_id = u.user_id""")
def update_stored_tier(t):
    """The stored table's tiers updated in place: of eight partitions those three are rewritten that changes arrive for."""
    path = _scratch(t, "k06")
    region = (F.col("user_id") % 8).alias("region")
    t.users.select("user_id", F.lit("cold").alias("tier"), region).write.partitionBy("region").parquet(path)
    kind = F.when(F.count_if(F.col("event_name") != "VIEWED PRODUCT") > 0, "hot").otherwise("warm").alias("tier")
    changes = t.staged.groupBy("user_id").agg(kind).select("user_id", "tier", region).where("region < 3")
    touched = sinks.update_partitioned(t.spark, path, changes, ["user_id"], "tier", "region")
    return t.spark.read.parquet(path).withColumn("touched", touched.agg(F.count(F.lit(1))).scalar())
