"""Campaign queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import campaign as K
from .registry import once, query
from .sql_views import VIEWS

BOTH = "count(*) FILTER (opened = 1 AND clicked = 1)"
VIEWS.update({
    "v_elig": "SELECT user_id FROM v_users WHERE balance >= 0",
    "v_base": """
SELECT s.*, CAST(s.sent_ts AS DATE) AS send_date, s.sent_ts >= TIMESTAMP '2024-01-14' AS in_crash, e.user_id IS NOT NULL AS eligible,
  CASE WHEN v.tracking_id IS NOT NULL THEN 1 ELSE 0 END AS opened, CASE WHEN c.tracking_id IS NOT NULL THEN 1 ELSE 0 END AS clicked,
  CASE s.model_id WHEN 0 THEN 'Post Purchase' WHEN 1 THEN 'Browse Recovery' ELSE 'Other' END AS campaign
FROM v_sends s LEFT JOIN v_elig e ON s.user_id = e.user_id
LEFT JOIN (SELECT DISTINCT tracking_id FROM v_interactions WHERE type = 'VIEWED') v ON v.tracking_id = s.tracking_id
LEFT JOIN (SELECT DISTINCT tracking_id FROM v_interactions WHERE type = 'CLICKED') c ON c.tracking_id = s.tracking_id
WHERE s.source = 'LIVE'""",
    "v_first": "SELECT user_id, min(sent_ts) AS sent_ts FROM v_sends GROUP BY user_id",
    "v_journey": """
SELECT s.user_id, s.sent_ts,
  CASE WHEN s.user_id IN (SELECT user_id FROM v_deliveries WHERE status = 'DELIVERY_SUCCESSFUL') THEN 1 ELSE 0 END AS delivered,
  CASE WHEN s.user_id IN (SELECT user_id FROM v_interactions WHERE type = 'VIEWED') THEN 1 ELSE 0 END AS opened,
  CASE WHEN s.user_id IN (SELECT user_id FROM v_interactions WHERE type = 'CLICKED') THEN 1 ELSE 0 END AS clicked,
  coalesce(o.n, 0) AS orders, o.v AS revenue
FROM v_first s LEFT JOIN (SELECT p.user_id, count(*) AS n, sum(order_value) AS v FROM v_purchases p JOIN v_first f ON p.user_id = f.user_id
  WHERE p.order_ts > f.sent_ts GROUP BY p.user_id) o ON o.user_id = s.user_id""",
})
RATES = f"count(*) AS sends, count(DISTINCT user_id) AS users, sum(opened) AS opens, {BOTH} AS clicks"
RATE_COLS = "sends:l users:l opens:l clicks:l open_rate:d2 ctr_of_opens:d2 ctr_of_sends:d2"
PCT = ("round(opens / nullif(sends, 0) * 100, 2) AS open_rate, round(clicks / nullif(opens, 0) * 100, 2) AS ctr_of_opens, "
       "round(clicks / nullif(sends, 0) * 100, 2) AS ctr_of_sends")


def rates_sql(keys, where="TRUE", src="v_base", more=""):
    return f"SELECT *, {PCT}{more} FROM (SELECT {keys}, {RATES} FROM {src} WHERE {where} GROUP BY ALL) r"


@once
def base(t):
    b = K.uplift_base(t.sends, t.interactions, K.eligible_users(t.attributes), "2024-01-14")
    name = F.when(F.col("model_id") == 0, "Post Purchase mail").when(F.col("model_id") == 1, "Browse mail").otherwise("Weekly")
    return b.withColumn("campaign", K.campaign_of(name))


@once
def journey(t):
    return K.user_journey(t.sends, t.deliveries, t.interactions, t.purchases)


@query("C01 A13", "step:l stage users:l pct_of_sent:d2", """
SELECT step, stage, users, round(users / sent * 100, 2) AS pct_of_sent FROM (
  SELECT count(*) AS sent, sum(delivered) AS d, sum(opened) AS o, sum(clicked) AS c, count(*) FILTER (orders > 0) AS b FROM v_journey) f,
LATERAL (SELECT * FROM (VALUES (1, 'sent', sent), (2, 'delivered', d), (3, 'opened', o), (4, 'clicked', c), (5, 'ordered', b)) v(step, stage, users)) x""")
def funnel(t):
    return K.funnel(journey(t))


@query("C02", "path users:l orders:l revenue:d2 avg_order:d2", """
SELECT CASE WHEN clicked = 1 THEN 'clicked' WHEN opened = 1 THEN 'opened' WHEN delivered = 1 THEN 'delivered' ELSE 'sent' END AS path,
  count(*) AS users, sum(orders) AS orders, sum(revenue) AS revenue, round(CAST(sum(revenue) AS DOUBLE) / sum(orders), 2) AS avg_order
FROM v_journey WHERE orders > 0 GROUP BY 1""")
def conversion_path(t):
    return K.conversion_path(journey(t))


@query("C03", "day buyers:l orders:l revenue:d2", """
SELECT CAST(p.order_ts AS DATE) AS day, count(DISTINCT p.user_id) AS buyers, count(*) AS orders, sum(order_value) AS revenue
FROM v_purchases p JOIN v_first f ON p.user_id = f.user_id WHERE p.order_ts > f.sent_ts GROUP BY 1""")
def revenue_by_day(t):
    return K.revenue_by_day(t.sends, t.purchases)


@query("C04 P09", "bucket orders:l", """
SELECT CASE WHEN h < 1 THEN '< 1 hour' WHEN h < 6 THEN '1-6 hours' WHEN h < 12 THEN '6-12 hours' WHEN h < 24 THEN '12-24 hours'
  WHEN h < 48 THEN '1-2 days' ELSE '2+ days' END AS bucket, count(*) AS orders
FROM (SELECT date_sub('hour', f.sent_ts, o.order_ts) AS h FROM v_first f JOIN (SELECT user_id, min(order_ts) AS order_ts FROM v_purchases GROUP BY 1) o
  ON f.user_id = o.user_id WHERE o.order_ts > f.sent_ts) a GROUP BY 1""")
def time_to_purchase(t):
    return K.time_to_purchase(t.sends, t.purchases)


@query("C05", "treatment_id:l sends:l users_sent:l opens:l users_opened:l clicks:l users_clicked:l open_rate:d2 ctr:d2", """
SELECT s.treatment_id, s.sends, s.users_sent, coalesce(o.n, 0) AS opens, coalesce(o.u, 0) AS users_opened, coalesce(c.n, 0) AS clicks, coalesce(c.u, 0) AS users_clicked,
  round(coalesce(o.u, 0) / s.users_sent * 100, 2) AS open_rate, round(coalesce(c.u, 0) / nullif(o.u, 0) * 100, 2) AS ctr
FROM (SELECT treatment_id, count(*) AS sends, count(DISTINCT user_id) AS users_sent FROM v_sends GROUP BY 1) s
LEFT JOIN (SELECT treatment_id, count(*) AS n, count(DISTINCT user_id) AS u FROM v_interactions WHERE type = 'VIEWED' GROUP BY 1) o ON o.treatment_id = s.treatment_id
LEFT JOIN (SELECT treatment_id, count(*) AS n, count(DISTINCT user_id) AS u FROM v_interactions WHERE type = 'CLICKED' GROUP BY 1) c ON c.treatment_id = s.treatment_id
WHERE s.users_sent >= 100""")
def by_treatment(t):
    return K.by_treatment(t.sends, t.interactions, 100)


@query("C06 P09", "category status n:l users:l", """
SELECT CASE WHEN failure_reason LIKE '%event limit%' THEN 'Event Limit Exceeded' WHEN failure_reason LIKE '%API%' THEN 'Provider API Error'
  WHEN failure_reason LIKE '%UNAVAILABLE%' THEN 'Service Unavailable' WHEN failure_reason IS NULL OR failure_reason = '' THEN 'Success' ELSE 'Other Error' END AS category,
  status, count(*) AS n, count(DISTINCT user_id) AS users FROM v_deliveries GROUP BY ALL""")
def failures(t):
    return K.failures(t.deliveries)


@query("C07", "segment buyers:l orders:l revenue:d2 avg_order:d2 per_buyer:d2", """
SELECT CASE WHEN s.user_id IS NULL THEN 'other' ELSE 'recipient' END AS segment, count(DISTINCT p.user_id) AS buyers, count(*) AS orders, sum(order_value) AS revenue,
  round(CAST(sum(order_value) AS DOUBLE) / count(*), 2) AS avg_order, round(CAST(sum(order_value) AS DOUBLE) / count(DISTINCT p.user_id), 2) AS per_buyer
FROM v_purchases p LEFT JOIN (SELECT DISTINCT user_id FROM v_sends WHERE period = 'p2' AND treatment_id = 1) s ON s.user_id = p.user_id GROUP BY 1""")
def recipients_vs_others(t):
    return K.recipients_vs_others(t.purchases, t.sends.where("period = 'p2' and treatment_id = 1"))


@query("C08", "hour:l type events:l users:l",
       "SELECT hour(ts) AS hour, type, count(*) AS events, count(DISTINCT user_id) AS users FROM v_interactions GROUP BY ALL")
def hourly(t):
    return K.hourly(t.interactions)


@query("C09", "user_id:l order_id:l minutes_to_open:l minutes_to_order:l order_value:d2 sku", """
SELECT p.user_id, p.order_id, date_sub('minute', f.sent_ts, o.open_ts) AS minutes_to_open, date_sub('minute', o.open_ts, p.order_ts) AS minutes_to_order, p.order_value, p.sku
FROM v_purchases p JOIN v_first f ON f.user_id = p.user_id JOIN (SELECT user_id, min(ts) AS open_ts FROM v_interactions WHERE type = 'VIEWED' GROUP BY 1) o ON o.user_id = p.user_id
WHERE p.order_ts > o.open_ts""")
def open_to_order(t):
    return K.open_to_order(t.sends, t.interactions, t.purchases)


@query("C10 J15", "sent:l delivered:l opened:l clicked:l ordered:l revenue:d2", """
SELECT count(*) AS sent, sum(delivered) AS delivered, sum(opened) AS opened, sum(clicked) AS clicked, count(*) FILTER (orders > 0) AS ordered, sum(revenue) AS revenue FROM v_journey""")
def summary(t):
    return K.summary(journey(t))


@query("C11 J03", "day users_sent:l users_opened:l users_clicked:l open_rate:d2 ctr:d2", """
SELECT coalesce(s.day, i.day) AS day, users_sent, users_opened, users_clicked, round(users_opened / nullif(users_sent, 0) * 100, 2) AS open_rate,
  round(users_clicked / nullif(users_opened, 0) * 100, 2) AS ctr
FROM (SELECT CAST(sent_ts AS DATE) AS day, count(DISTINCT user_id) AS users_sent FROM v_sends GROUP BY 1) s
FULL JOIN (SELECT CAST(ts AS DATE) AS day, count(DISTINCT CASE WHEN type = 'VIEWED' THEN user_id END) AS users_opened,
  count(DISTINCT CASE WHEN type = 'CLICKED' THEN user_id END) AS users_clicked FROM v_interactions GROUP BY 1) i ON s.day = i.day""")
def daily(t):
    return K.daily(t.sends, t.interactions)


DEPTH = ", ".join(f"count(*) FILTER ({{c}} {op}) AS {n}" for n, op in
                  (("once", "= 1"), ("twice", "= 2"), ("three_times", "= 3"), ("four_plus", ">= 4")))


@query("C12 A10", "metric once:l twice:l three_times:l four_plus:l", f"""
SELECT 'Opens' AS metric, {DEPTH.format(c='o')} FROM ud UNION ALL SELECT 'Clicks', {DEPTH.format(c='c')} FROM ud""",
       "ud AS (SELECT user_id, treatment_id, count(*) FILTER (type = 'VIEWED') AS o, count(*) FILTER (type = 'CLICKED') AS c FROM v_interactions GROUP BY ALL)")
def engagement_depth(t):
    return K.depth(t.interactions)


@query("C13 A06", "type n:l avg_minutes:d1 median_minutes:l", """
SELECT type, count(*) AS n, round(avg(m), 1) AS avg_minutes, quantile_disc(m, 0.5) AS median_minutes FROM (
  SELECT i.type, date_sub('minute', s.sent_ts, i.f) AS m FROM v_sends s JOIN (SELECT user_id, treatment_id, type, min(ts) AS f FROM v_interactions GROUP BY ALL) i
  ON s.user_id = i.user_id AND s.treatment_id = i.treatment_id WHERE i.f > s.sent_ts) a GROUP BY type""")
def time_to_action(t):
    return K.time_to_action(t.sends, t.interactions)


@query("C14", "clickers:l ordered_after:l ordered_before:l conversion:d2", """
SELECT count(*) AS clickers, count(*) FILTER (a) AS ordered_after, count(*) FILTER (b) AS ordered_before, round(count(*) FILTER (a) / count(*) * 100, 2) AS conversion
FROM (SELECT c.user_id, EXISTS (SELECT 1 FROM v_purchases p WHERE p.user_id = c.user_id AND p.order_ts > c.t) AS a,
  EXISTS (SELECT 1 FROM v_purchases p WHERE p.user_id = c.user_id AND p.order_ts < c.t) AS b
  FROM (SELECT user_id, min(ts) AS t FROM v_interactions WHERE type = 'CLICKED' GROUP BY 1) c) x""")
def click_to_order(t):
    return K.click_to_order(t.interactions, t.purchases)


@query("C15", "treatment_id:l users_sent:l users_interacted:l rate:d2", """
SELECT treatment_id, count(*) AS users_sent, count(hit) AS users_interacted, round(count(hit) / count(*) * 100, 2) AS rate FROM (
  SELECT s.user_id, s.treatment_id, i.user_id AS hit FROM (SELECT DISTINCT user_id, treatment_id FROM v_sends) s
  LEFT JOIN (SELECT DISTINCT user_id, treatment_id FROM v_interactions) i ON i.user_id = s.user_id AND i.treatment_id = s.treatment_id) a GROUP BY 1""")
def sent_vs_interacted(t):
    return K.sent_vs_interacted(t.sends, t.interactions)


@query("C16", "tracking_id:l user_id:l treatment_id:l treatment_type period in_crash:b eligible:b opened:l clicked:l campaign", "SELECT * FROM v_base")
def uplift_base(t):
    return base(t)


@query("C17 A11", "period treatment_type " + RATE_COLS, rates_sql("period, treatment_type", "eligible"))
def rates_block(t):
    return K.rates(base(t).where("eligible"), ["period", "treatment_type"])


WILSON = """, (clicks / opens + 1.96*1.96/opens/2 - 1.96 * sqrt((clicks / opens) * (1 - clicks / opens) / opens + 1.96*1.96/opens/opens/4)) / (1 + 1.96*1.96/opens) AS ci_low,
(clicks / opens + 1.96*1.96/opens/2 + 1.96 * sqrt((clicks / opens) * (1 - clicks / opens) / opens + 1.96*1.96/opens/opens/4)) / (1 + 1.96*1.96/opens) AS ci_high"""


@query("C18", "period treatment_type clicks:l opens:l ci_low:d6 ci_high:d6", rates_sql("period, treatment_type", more=WILSON))
def wilson_interval(t):
    return K.rates_with_interval(base(t), ["period", "treatment_type"])


UT = f"""ut AS (SELECT user_id, %s,
  count(*) FILTER (treatment_type = 'Personalized') AS p_sends, count(*) FILTER (treatment_type = 'Personalized' AND opened = 1) AS p_opens,
  count(*) FILTER (treatment_type = 'Personalized' AND opened = 1 AND clicked = 1) AS p_clicks,
  max(CASE WHEN treatment_type = 'Personalized' AND clicked = 1 THEN 1 ELSE 0 END) AS pc,
  count(*) FILTER (treatment_type = 'Static') AS s_sends, count(*) FILTER (treatment_type = 'Static' AND opened = 1) AS s_opens,
  count(*) FILTER (treatment_type = 'Static' AND opened = 1 AND clicked = 1) AS s_clicks,
  max(CASE WHEN treatment_type = 'Static' AND clicked = 1 THEN 1 ELSE 0 END) AS sc
  FROM v_base GROUP BY ALL HAVING count(DISTINCT treatment_type) = 2)"""


@query("C19", "period overlap_users:l p_sends:l p_opens:l p_clicks:l p_open_rate:d2 p_ctr:d2 s_sends:l s_opens:l s_clicks:l s_open_rate:d2 s_ctr:d2 ctr_delta:d2", """
SELECT *, round(p_opens / p_sends * 100, 2) AS p_open_rate, round(p_clicks / nullif(p_opens, 0) * 100, 2) AS p_ctr,
  round(s_opens / s_sends * 100, 2) AS s_open_rate, round(s_clicks / nullif(s_opens, 0) * 100, 2) AS s_ctr,
  round(p_clicks / nullif(p_opens, 0) * 100 - s_clicks / nullif(s_opens, 0) * 100, 2) AS ctr_delta
FROM (SELECT period, count(*) AS overlap_users, sum(p_sends) AS p_sends, sum(p_opens) AS p_opens, sum(p_clicks) AS p_clicks,
  sum(s_sends) AS s_sends, sum(s_opens) AS s_opens, sum(s_clicks) AS s_clicks FROM ut GROUP BY period) a""", UT % "period")
def paired_comparison(t):
    return K.paired_comparison(base(t))


ONCE = """SELECT *, round(clicked_p / overlap_users * 100, 2) AS pct_p, round(clicked_s / overlap_users * 100, 2) AS pct_s,
  round((clicked_p / overlap_users - clicked_s / overlap_users) * 100, 2) AS delta_pp FROM (
  SELECT %s count(*) AS overlap_users, sum(pc) AS clicked_p, sum(sc) AS clicked_s, count(*) FILTER (pc = 1 AND sc = 1) AS clicked_both,
  count(*) FILTER (pc = 0 AND sc = 0) AS clicked_neither FROM ut %s) a"""
ONCE_COLS = "overlap_users:l clicked_p:l clicked_s:l clicked_both:l clicked_neither:l pct_p:d2 pct_s:d2 delta_pp:d2"


@query("C20", "period " + ONCE_COLS, ONCE % ("period,", "GROUP BY period"), UT % "period")
def at_least_once_by_period(t):
    return K.at_least_once(base(t), ["period"])


@query("C20", ONCE_COLS, ONCE % ("", ""), UT % "1 AS one")
def at_least_once_all(t):
    return K.at_least_once(base(t))


PS = """ps AS (SELECT treatment_type, period, sum(opened) / count(*) AS o, count(*) FILTER (opened = 1 AND clicked = 1) / nullif(sum(opened), 0) AS c,
  count(*) FILTER (opened = 1 AND clicked = 1) / count(*) AS s FROM v_base WHERE eligible GROUP BY ALL),
pv AS (SELECT treatment_type, max(o) FILTER (period = 'p1') AS o1, max(o) FILTER (period = 'p2') AS o2, max(c) FILTER (period = 'p1') AS c1,
  max(c) FILTER (period = 'p2') AS c2, max(s) FILTER (period = 'p1') AS s1, max(s) FILTER (period = 'p2') AS s2 FROM ps GROUP BY 1)"""


@query("C21", "treatment_type open_before:d2 open_after:d2 open_change:d2 open_relative:d1 ctr_before:d2 ctr_after:d2 ctr_change:d2 ctr_sends_change:d2", """
SELECT treatment_type, round(o1 * 100, 2) AS open_before, round(o2 * 100, 2) AS open_after, round((o2 - o1) * 100, 2) AS open_change,
  round((o2 - o1) / o1 * 100, 1) AS open_relative, round(c1 * 100, 2) AS ctr_before, round(c2 * 100, 2) AS ctr_after,
  round((c2 - c1) * 100, 2) AS ctr_change, round((s2 - s1) * 100, 2) AS ctr_sends_change FROM pv""", PS)
def period_change(t):
    return K.period_change(base(t), "p1", "p2")


@query("C21", "open_did:d2 ctr_did:d2 ctr_sends_did:d2", """
SELECT round(((p.o2 - p.o1) - (s.o2 - s.o1)) * 100, 2) AS open_did, round(((p.c2 - p.c1) - (s.c2 - s.c1)) * 100, 2) AS ctr_did,
  round(((p.s2 - p.s1) - (s.s2 - s.s1)) * 100, 2) AS ctr_sends_did FROM pv p, pv s WHERE p.treatment_type = 'Personalized' AND s.treatment_type = 'Static'""", PS)
def diff_in_diff(t):
    return K.diff_in_diff(base(t), "p1", "p2")


@query("C22 J07", "period users:l sends:l opens:l clicks:l open_rate:d2 ctr_of_opens:d2",
       rates_sql("period", "treatment_type = 'Personalized' AND user_id IN (SELECT user_id FROM v_base WHERE treatment_type = 'Personalized' GROUP BY 1 HAVING count(DISTINCT period) = 2)"))
def same_user_periods(t):
    return K.same_user_periods(base(t))


@query("C23", "period p_open_rate:d2 p_ctr:d2 s_open_rate:d2 s_ctr:d2 winner", """
SELECT p.period, round(p.o * 100, 2) AS p_open_rate, round(p.c * 100, 2) AS p_ctr, round(s.o * 100, 2) AS s_open_rate, round(s.c * 100, 2) AS s_ctr,
  CASE WHEN p.c > s.c THEN 'Personalized' ELSE 'Static' END AS winner FROM ps p JOIN ps s ON p.period = s.period AND p.treatment_type = 'Personalized' AND s.treatment_type = 'Static'""", PS)
def winner_per_period(t):
    return K.winner_per_period(base(t))


@once
def clean_base(t):
    """Sends of one model keep their type, the others take the type of the user's first send, so some users have one type only."""
    b = base(t)
    first = b.groupBy("user_id").agg(F.min_by("treatment_type", F.struct("sent_ts", "tracking_id")).alias("_t"))
    mixed = F.col("model_id") == 0
    rows = b.join(first, "user_id").withColumn("treatment_type", F.when(mixed, F.col("treatment_type")).otherwise(F.col("_t"))).drop("_t")
    return rows


CLEAN = """cb AS (SELECT b.* EXCLUDE (treatment_type), CASE WHEN b.model_id = 0 THEN b.treatment_type ELSE f.tt END AS treatment_type
  FROM v_base b JOIN (SELECT user_id, arg_min(treatment_type, (sent_ts, tracking_id)) AS tt FROM v_base GROUP BY 1) f ON f.user_id = b.user_id),
sc AS (SELECT * FROM cb WHERE eligible AND user_id NOT IN (SELECT user_id FROM cb WHERE eligible GROUP BY 1 HAVING count(DISTINCT treatment_type) > 1)),
uo AS (SELECT user_id, CAST(order_ts AS DATE) AS order_date, order_value, min(order_ts) AS order_ts FROM v_purchases GROUP BY ALL),
att AS (SELECT * FROM (SELECT o.*, s.treatment_type, s.period, s.sent_ts, s.tracking_id,
  row_number() OVER (PARTITION BY o.user_id, o.order_date, o.order_value ORDER BY s.sent_ts DESC, s.tracking_id DESC) AS rn
  FROM uo o JOIN sc s ON s.user_id = o.user_id AND o.order_ts > s.sent_ts AND o.order_ts <= s.sent_ts + INTERVAL 30 DAY) a WHERE rn = 1)"""


@query("J10 C24", "user_id:l order_date order_value:d2 tracking_id:l treatment_type period", "SELECT * FROM att", CLEAN)
def asof_attribution(t):
    return K.attributed_orders(clean_base(t), t.purchases)


@query("C24", "treatment_type period users_sent:l buyers_short:l conversion_short:d2 revenue_short:d2 per_user_short:d2 buyers_long:l conversion_long:d2 revenue_long:d2 per_user_long:d2", """
SELECT u.*, coalesce(b7, 0) AS buyers_short, round(coalesce(b7, 0) / users_sent * 100, 2) AS conversion_short, coalesce(r7, 0) AS revenue_short,
  round(coalesce(r7, 0) / users_sent, 2) AS per_user_short, coalesce(b30, 0) AS buyers_long, round(coalesce(b30, 0) / users_sent * 100, 2) AS conversion_long,
  coalesce(r30, 0) AS revenue_long, round(coalesce(r30, 0) / users_sent, 2) AS per_user_long
FROM (SELECT treatment_type, period, count(DISTINCT user_id) AS users_sent FROM sc GROUP BY ALL) u LEFT JOIN (
  SELECT treatment_type, period, count(DISTINCT CASE WHEN near THEN user_id END) AS b7, CAST(sum(CASE WHEN near THEN order_value END) AS DOUBLE) AS r7,
    count(DISTINCT user_id) AS b30, CAST(sum(order_value) AS DOUBLE) AS r30 FROM (SELECT *, order_ts <= sent_ts + INTERVAL 7 DAY AS near FROM att) n GROUP BY ALL) r
ON u.treatment_type = r.treatment_type AND u.period = r.period""", CLEAN)
def revenue_attribution(t):
    return K.revenue_attribution(clean_base(t), t.purchases)


@query("C25 O04", "period total_users:l overlap_users:l clean_users:l", """
SELECT period, count(*) AS total_users, count(o) AS overlap_users, count(*) - count(o) AS clean_users FROM (
  SELECT DISTINCT b.user_id, b.period, k.user_id AS o FROM cb b LEFT JOIN (SELECT user_id FROM cb WHERE eligible GROUP BY 1 HAVING count(DISTINCT treatment_type) > 1) k
  ON k.user_id = b.user_id WHERE b.eligible) a GROUP BY 1""", CLEAN)
def overlap_diagnostics(t):
    return K.overlap_diagnostics(clean_base(t))


@query("C25", "metric value:d1", """
SELECT 'raw' AS metric, (SELECT count(*) FROM v_purchases) AS value UNION ALL SELECT 'deduped', (SELECT count(*) FROM uo)
UNION ALL SELECT 'removed', (SELECT count(*) FROM v_purchases) - (SELECT count(*) FROM uo)""", CLEAN)
def dedupe_diagnostics(t):
    return K.dedupe_diagnostics(t.purchases)


@query("C26", "treatment_type period sends:l clicks:l no_open:l with_open:l old_ctr:d2 corrected_ctr:d2", f"""
SELECT treatment_type, period, count(*) AS sends, sum(clicked) AS clicks, count(*) FILTER (opened = 0 AND clicked = 1) AS no_open, {BOTH} AS with_open,
  round(sum(clicked) / nullif(sum(opened), 0) * 100, 2) AS old_ctr, round({BOTH} / nullif(sum(opened), 0) * 100, 2) AS corrected_ctr
FROM v_base WHERE eligible GROUP BY ALL""")
def click_without_open(t):
    return K.click_without_open(base(t))


@query("C27", "period treatment_type arm_id:l " + RATE_COLS, rates_sql("period, treatment_type, arm_id", "eligible") + " WHERE sends >= 10")
def rates_by_arm(t):
    return K.rates(base(t).where("eligible"), ["period", "treatment_type", "arm_id"], 10)


@query("C27", "in_crash:b treatment_type arm_id:l " + RATE_COLS, rates_sql("in_crash, treatment_type, arm_id", "eligible"))
def rates_by_crash(t):
    return K.rates(base(t).where("eligible"), ["in_crash", "treatment_type", "arm_id"])


@query("C28 A02", "period treatment_type users:l openers:l clickers:l sends:l pct_opened:d2 pct_clicked:d2 sends_per_user:d2", """
SELECT *, round(openers / users * 100, 2) AS pct_opened, round(clickers / users * 100, 2) AS pct_clicked, round(sends / users, 2) AS sends_per_user FROM (
  SELECT period, treatment_type, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN opened = 1 THEN user_id END) AS openers,
  count(DISTINCT CASE WHEN opened = 1 AND clicked = 1 THEN user_id END) AS clickers, count(*) AS sends FROM v_base GROUP BY ALL) a""")
def binary_user_rates(t):
    return K.binary_user_rates(base(t))


@query("C29 W07", "treatment_type period " + RATE_COLS, rates_sql("treatment_type, period", "rn = 1",
       "(SELECT *, row_number() OVER (PARTITION BY user_id, treatment_type, period ORDER BY sent_ts, tracking_id) AS rn FROM v_base) x"))
def first_send_only(t):
    return K.first_send_only(base(t))


@query("C29 P09", "treatment_type bucket sends:l opens:l clicks:l open_rate:d2 ctr_of_opens:d2", f"""
SELECT *, {PCT} FROM (SELECT treatment_type, CASE WHEN rn = 1 THEN '1st' WHEN rn = 2 THEN '2nd' WHEN rn = 3 THEN '3rd' WHEN rn <= 5 THEN '4th-5th' ELSE '6th+' END AS bucket,
  count(*) AS sends, sum(opened) AS opens, {BOTH} AS clicks FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, treatment_type ORDER BY sent_ts, tracking_id) AS rn FROM v_base) a GROUP BY ALL) b""")
def fatigue(t):
    return K.fatigue(base(t))


@query("C30 P10", "campaign treatment_type " + RATE_COLS + " pct_clicked:d2 pct_opened:d2", f"""
SELECT *, {PCT}, round(cl / users * 100, 2) AS pct_clicked, round(op / users * 100, 2) AS pct_opened FROM (
  SELECT b.campaign, b.treatment_type, count(*) AS sends, count(DISTINCT b.user_id) AS users, sum(opened) AS opens, {BOTH} AS clicks,
  count(DISTINCT CASE WHEN clicked = 1 THEN b.user_id END) AS cl, count(DISTINCT CASE WHEN opened = 1 THEN b.user_id END) AS op
  FROM v_base b JOIN ut u ON u.user_id = b.user_id AND u.campaign = b.campaign GROUP BY ALL) a""", UT % "campaign")
def campaign_overlap(t):
    return K.campaign_overlap(base(t))


@query("C30", "campaign p_only:l s_only:l clicked_both:l neither:l users:l", """
SELECT campaign, count(*) FILTER (pc = 1 AND sc = 0) AS p_only, count(*) FILTER (pc = 0 AND sc = 1) AS s_only, count(*) FILTER (pc = 1 AND sc = 1) AS clicked_both,
  count(*) FILTER (pc = 0 AND sc = 0) AS neither, count(*) AS users FROM ut GROUP BY campaign""", UT % "campaign")
def user_preference(t):
    return K.user_preference(base(t))


ARMS = """SELECT {k} arm_id, sends, users, round(sends / sum(sends) OVER ({p}) * 100, 2) AS share FROM (
SELECT {e} arm_id, count(*) AS sends, count(DISTINCT user_id) AS users FROM v_base GROUP BY ALL) a"""


@query("C31 A12", "arm_id:l sends:l users:l share:d2", ARMS.format(k="", p="", e=""))
def arm_split(t):
    return K.arm_split(base(t))


@query("C31", "week arm_id:l sends:l users:l share:d2",
       ARMS.format(k="week,", p="PARTITION BY week", e="send_date - CAST(dayofweek(send_date) AS INTEGER) AS week,"))
def arm_split_weekly_sunday(t):
    return K.arm_split(base(t), "sunday")


@query("C31", "week arm_id:l sends:l users:l share:d2",
       ARMS.format(k="week,", p="PARTITION BY week", e="CAST(date_trunc('week', send_date) AS DATE) AS week,"))
def arm_split_weekly_monday(t):
    return K.arm_split(base(t), "monday")


@query("C32 J14", "a_sends:l a_clicks:l a_ctr:d3 b_sends:l b_clicks:l b_ctr:d3 lift_pp:d3 z:d3 significant", """
SELECT *, CASE WHEN abs(z) >= 2.576 THEN '99%' WHEN abs(z) >= 1.96 THEN '95%' WHEN abs(z) >= 1.645 THEN '90%' ELSE 'not significant' END AS significant FROM (
SELECT a.n AS a_sends, a.k AS a_clicks, round(a.p * 100, 3) AS a_ctr, b.n AS b_sends, b.k AS b_clicks, round(b.p * 100, 3) AS b_ctr,
  round((b.p - a.p) * 100, 3) AS lift_pp, (b.p - a.p) / sqrt(a.p * (1 - a.p) / a.n + b.p * (1 - b.p) / b.n) AS z FROM st a, st b
WHERE a.treatment_type = 'Static' AND b.treatment_type = 'Personalized') q""",
       "st AS (SELECT treatment_type, count(*) AS n, sum(clicked) AS k, sum(clicked) / count(*) AS p FROM v_base GROUP BY 1)")
def ab_test(t):
    return K.ab_test(base(t), "Static", "Personalized")


@query("C33 J11", "treatment_type users:l clickers:l buyers:l orders:l revenue:d2 aov:d2 click_to_order:d2 per_user:d2", """
SELECT u.treatment_type, users, clickers, buyers, orders, revenue, round(revenue / orders, 2) AS aov, round(buyers / clickers * 100, 2) AS click_to_order, round(revenue / users, 2) AS per_user
FROM (SELECT treatment_type, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN clicked = 1 THEN user_id END) AS clickers FROM v_base GROUP BY 1) u
JOIN (SELECT treatment_type, count(DISTINCT user_id) AS buyers, count(*) AS orders, CAST(sum(order_value) AS DOUBLE) AS revenue FROM (
  SELECT DISTINCT s.treatment_type, p.user_id, p.order_id, p.order_value FROM v_base s JOIN v_purchases p ON p.user_id = s.user_id AND p.order_ts >= s.sent_ts
  AND p.order_ts <= s.sent_ts + INTERVAL 24 HOUR) d GROUP BY 1) r ON r.treatment_type = u.treatment_type""")
def revenue_24h(t):
    return K.revenue_24h(base(t), t.purchases)


@query("C34", "user_id:l", "SELECT user_id FROM v_elig")
def eligible_users(t):
    return K.eligible_users(t.attributes)


@query("C35", "treatment_type sent:l opened:l clicked:l ordered:l orders:l revenue:d2 aov:d2", """
SELECT f.treatment_type, count(*) AS sent, sum(o) AS opened, sum(c) AS clicked, count(n) AS ordered, sum(n) AS orders, sum(v) AS revenue,
  round(CAST(sum(v) AS DOUBLE) / sum(n), 2) AS aov FROM f LEFT JOIN (
  SELECT f.treatment_type, f.user_id, count(*) AS n, sum(order_value) AS v FROM f JOIN v_purchases p ON p.user_id = f.user_id AND p.order_ts > f.t GROUP BY ALL) b
ON b.treatment_type = f.treatment_type AND b.user_id = f.user_id GROUP BY 1""",
       "f AS (SELECT treatment_type, user_id, min(sent_ts) AS t, max(opened) AS o, max(clicked) AS c FROM v_base GROUP BY ALL)")
def scorecard(t):
    return K.scorecard(base(t), t.purchases)


@query("P10", "name campaign kind n:l", """
SELECT name, CASE WHEN lower(name) LIKE '%post purchase%' THEN 'Post Purchase' WHEN lower(name) LIKE '%abandon%' THEN 'Abandoned Cart'
  WHEN lower(name) LIKE '%browse%' THEN 'Browse Recovery' ELSE 'Other' END AS campaign,
  CASE WHEN lower(name) LIKE '%personalized%' OR lower(name) LIKE '%fitment%' THEN 'Personalized' ELSE 'Static' END AS kind, count(*) AS n
FROM (SELECT concat(CASE treatment_id % 4 WHEN 0 THEN 'Post Purchase ' WHEN 1 THEN 'ABANDONED cart ' WHEN 2 THEN 'Browse ' ELSE 'Weekly ' END,
  CASE WHEN treatment_id < 5 THEN 'Fitment' ELSE 'Generic' END) AS name FROM v_sends) a GROUP BY 1""")
def classify_names(t):
    k = F.col("treatment_id") % 4
    name = F.concat(F.when(k == 0, "Post Purchase ").when(k == 1, "ABANDONED cart ").when(k == 2, "Browse ").otherwise("Weekly "),
                    F.when(F.col("treatment_id") < 5, "Fitment").otherwise("Generic"))
    return t.sends.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumns({
        "campaign": K.campaign_of("name"), "kind": K.treatment_kind("name")})
