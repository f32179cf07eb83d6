"""Canonical model of the test tables as SQL views, for the SQL side of each check."""

SKU = "concat('P', {k} // 2, CASE WHEN {k} % 2 = 0 THEN 'B' ELSE '' END)"
NORM = "regexp_replace({c}, '([0-9])[BRGP]$', '\\1')"


def norm(c: str) -> str:
    return NORM.format(c=c)


VIEWS = {
    "v_users": """
SELECT c_custkey AS user_id, lower(c_name) AS email, CAST(2000 + c_custkey % 10 AS INTEGER) AS seg_year,
       n_name AS seg_make, c_mktsegment AS seg_model, c_acctbal AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_catalog": f"""
SELECT p_partkey AS part_id, {SKU.format(k='p_partkey')} AS sku, p_type AS category,
       CASE WHEN p_size = 50 THEN 'Sale,REFURBISHED' ELSE p_brand END AS tags, p_retailprice AS price,
       concat(CASE WHEN p_size = 49 THEN 'ftp://' WHEN p_partkey % 3 = 0 THEN '//' ELSE 'http://' END,
              'img.example/', p_partkey) AS image_raw,
       p_name AS name, p_brand AS brand, p_size AS size
FROM part""",
    "v_fitment": f"""
SELECT n_name AS make, {SKU.format(k='p_partkey')} AS sku
FROM nation JOIN part ON (p_partkey // 2 + n_nationkey) % 5 = 0 AND p_size > 5""",
    "v_orders": f"""
SELECT o_orderkey AS order_id, o_custkey AS user_id, {SKU.format(k='l_partkey')} AS sku,
       o_orderdate AS order_ts, CAST(o_orderdate AS DATE) AS order_date,
       CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))) AS amount, l_linenumber AS line
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_imported": """
SELECT u.email, o.sku, o.order_date, o.order_id FROM v_orders o JOIN v_users u ON o.user_id = u.user_id""",
    "v_events": f"""
SELECT event_id, user_id, ts AS event_ts, event_type,
       CASE event_type WHEN 'view' THEN 'VIEWED PRODUCT' WHEN 'click' THEN 'CART UPDATE'
            WHEN 'purchase' THEN 'PLACED ORDER' END AS event_name,
       k, {SKU.format(k='k')} AS sku, value AS price
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) e""",
    "v_staged": """
SELECT user_id, sku, event_ts, event_name, price, event_id FROM v_events WHERE event_name IS NOT NULL""",
    "v_generations": """
SELECT n_name AS make, 2000 AS year_start, 2004 AS year_end, 'G1' AS generation FROM nation
UNION ALL SELECT n_name, 2005, 2008, 'G2' FROM nation""",
    "v_sends": """
SELECT event_id AS tracking_id, user_id, k % 10 AS treatment_id, event_ts AS sent_ts, user_id % 2 AS arm_id,
       k % 3 AS model_id, CASE WHEN k = 13 THEN -1.0 ELSE price / 1000 END AS score,
       CASE WHEN k % 25 = 7 THEN 'TEST' ELSE 'LIVE' END AS source,
       CASE WHEN k % 10 < 5 THEN 'Personalized' ELSE 'Static' END AS treatment_type,
       CASE WHEN event_ts < TIMESTAMP '2024-01-15' THEN 'p1' ELSE 'p2' END AS period
FROM v_events WHERE event_type = 'view'""",
    "v_interactions": """
SELECT user_id, interaction_id, ts, type, tracking_id, treatment_id FROM (
  SELECT e.user_id, e.event_id AS interaction_id, e.event_ts AS ts,
         CASE e.event_type WHEN 'click' THEN 'VIEWED' ELSE 'CLICKED' END AS type, s.tracking_id, s.treatment_id,
         row_number() OVER (PARTITION BY e.event_id ORDER BY s.sent_ts DESC, s.tracking_id DESC) AS rn
  FROM v_events e JOIN v_sends s ON e.user_id = s.user_id AND s.sent_ts < e.event_ts
       AND e.event_ts <= s.sent_ts + INTERVAL 7 DAY
  WHERE e.event_type IN ('click', 'signup')) x WHERE rn = 1""",
    "v_purchases": """
SELECT user_id, event_id AS order_id, event_ts AS order_ts, CAST(price AS DECIMAL(12,2)) AS order_value, sku
FROM v_events WHERE event_type = 'purchase'""",
    "v_deliveries": """
SELECT s.user_id, s.event_id AS tracking_id, s.event_ts AS ts,
       CASE WHEN b.user_id IS NOT NULL THEN 'DELIVERY_FAILED' ELSE 'DELIVERY_SUCCESSFUL' END AS status,
       CASE WHEN b.user_id IS NOT NULL THEN
         CASE s.k % 4 WHEN 0 THEN 'event limit reached' WHEN 1 THEN 'provider API error'
              WHEN 2 THEN 'UNAVAILABLE: try later' ELSE 'mailbox full' END END AS failure_reason
FROM v_events s LEFT JOIN (SELECT DISTINCT user_id, CAST(event_ts AS DATE) AS day FROM v_events
                           WHERE event_type = 'error') b
  ON s.user_id = b.user_id AND CAST(s.event_ts AS DATE) = b.day
WHERE s.event_type = 'view'""",
}
