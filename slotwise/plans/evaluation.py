"""Evaluation and backtest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.keyed import metric_rows
from ..operators import candidates as C
from ..operators import eligibility as EL
from ..operators import evaluate as E
from ..operators import popularity as P
from ..operators import ranking as R
from ..params import TEST_PARAMS as p
from . import recs
from .registry import once, query
from .sql_views import VIEWS, norm

START, END = "2001-01-01", "2001-08-01"
VIEWS.update({
    # holdout purchases and three rankings per user: segment, make and global popularity
    "x_act": f"SELECT DISTINCT user_id, {norm('sku')} AS item FROM v_orders WHERE order_date BETWEEN DATE '{START}' AND DATE '{END}'",
    "x_pred": """
SELECT u.user_id, 'segment' AS list_type, s.sku AS item, s.rank_in_segment AS pos FROM v_users u JOIN v_seg s ON s.seg_make = u.seg_make AND s.seg_model = u.seg_model WHERE s.rank_in_segment <= 10
UNION ALL SELECT u.user_id, 'baseline', m.sku, m.rank_in_make FROM v_users u JOIN v_make m ON m.seg_make = u.seg_make WHERE m.rank_in_make <= 10""",
    "x_per": """
SELECT p.user_id, p.list_type, n.n AS n_actual, {cols}, coalesce(max(1.0 / p.pos) FILTER (a.item IS NOT NULL), 0) AS mrr,
  coalesce(sum(h / CAST(p.pos AS DOUBLE)) FILTER (a.item IS NOT NULL), 0) / n.n AS map
FROM (SELECT p.*, sum(CASE WHEN a.item IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY p.user_id, p.list_type ORDER BY p.pos) AS h
      FROM x_pred p LEFT JOIN x_act a ON a.user_id = p.user_id AND a.item = p.item) p
JOIN (SELECT user_id, count(*) AS n FROM x_act GROUP BY 1) n ON n.user_id = p.user_id
LEFT JOIN x_act a ON a.user_id = p.user_id AND a.item = p.item GROUP BY p.user_id, p.list_type, n.n""".format(cols=", ".join(
        f"count(a.item) FILTER (p.pos <= {k}) / {k}.0 AS precision_{k}, count(a.item) FILTER (p.pos <= {k}) / n.n AS recall_{k}, "
        f"coalesce(sum(1 / log2(p.pos + 1)) FILTER (p.pos <= {k} AND a.item IS NOT NULL), 0) / (SELECT sum(1 / log2(i + 1)) FROM range(1, {k + 1}) r(i) WHERE i <= n.n) AS ndcg_{k}, "
        f"CASE WHEN count(a.item) FILTER (p.pos <= {k}) > 0 THEN 1 ELSE 0 END AS hit_{k}" for k in (4, 10))),
    "x_tiers": "SELECT user_id, CASE WHEN balance < 3000 THEN 'cold' WHEN balance < 7000 THEN 'warm' ELSE 'hot' END AS tier FROM v_users",
    "x_buy": f"SELECT DISTINCT user_id, {norm('sku')} AS sku, order_date FROM v_orders WHERE order_date BETWEEN DATE '{START}' AND DATE '{END}'",
    "x_old": "SELECT u.user_id, u.seg_make, u.seg_model, m.rank_in_make AS slot, m.sku FROM v_users u JOIN v_make m ON m.seg_make = u.seg_make WHERE m.rank_in_make <= 4",
    "x_new": "SELECT u.user_id, u.seg_make, u.seg_model, s.rank_in_segment AS slot, s.sku FROM v_users u JOIN v_seg s ON s.seg_make = u.seg_make AND s.seg_model = u.seg_model WHERE s.rank_in_segment <= 4",
})
METRICS = [f"{m}_{k}" for k in (4, 10) for m in ("precision", "recall", "ndcg", "hit")] + ["mrr", "map"]
MCOLS = " ".join(f"{m}:d6" for m in METRICS)


@once
def actuals(t):
    return E.window_purchases(t.orders, START, END).select("user_id", F.col("sku").alias("item")).distinct()


def _lists(t, table, keys, rank, name, n):
    top = table.where(F.col(rank) <= n).groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(rank, "sku"))), lambda e: e["sku"]).alias("items"))
    return t.users.select("user_id", *keys).join(top, list(keys)).select("user_id", F.lit(name).alias("list_type"), "items")


@once
def predictions(t):
    """Ranked lists by segment and by make popularity; built once per segment, then given to its users."""
    seg, mk, _ = recs.tiers(t)
    return _lists(t, seg, ["seg_make", "seg_model"], "rank_in_segment", "segment", 10).unionByName(
        _lists(t, mk, ["seg_make"], "rank_in_make", "baseline", 10))


@once
def per_user(t):
    return E.per_user_metrics(predictions(t), actuals(t), (4, 10))


@once
def tiers(t):
    b = F.col("balance")
    return t.users.select("user_id", F.when(b < 3000, "cold").when(b < 7000, "warm").otherwise("hot").alias("tier"))


@once
def old_recs(t):
    m = recs.tiers(t)[1].where("rank_in_make <= 4").select("seg_make", "sku", F.col("rank_in_make").alias("slot"))
    return t.users.select("user_id", "seg_make", "seg_model").join(m, "seg_make")


@once
def new_recs(t):
    s = recs.tiers(t)[0].where("rank_in_segment <= 4").select("seg_make", "seg_model", "sku", F.col("rank_in_segment").alias("slot"))
    return t.users.select("user_id", "seg_make", "seg_model").join(s, ["seg_make", "seg_model"])


@once
def bought(t):
    return E.window_purchases(t.orders, START, END)


@query("E01 E02 E03 E04 E05 E06", "user_id:l list_type n_actual:l " + MCOLS, "SELECT * FROM x_per")
def ranking_metrics(t):
    return per_user(t)


@query("E07", "items:l coverage:d6", """
SELECT count(DISTINCT item) AS items, count(DISTINCT item) / (SELECT count(DISTINCT base) FROM (SELECT regexp_replace(sku, '([0-9])[BRGP]$', '\\1') AS base FROM v_catalog) c) AS coverage
FROM x_pred WHERE list_type = 'segment' AND pos <= 10""")
def catalog_coverage(t):
    size = t.catalog.agg(F.count_distinct(X.normalize_variant("sku"))).scalar()
    return E.catalog_coverage(predictions(t).where("list_type = 'segment'").drop("list_type"), size, 10)


@query("E08", "list_type users:l " + MCOLS, "SELECT list_type, count(*) AS users, " + ", ".join(f"avg({m}) AS {m}" for m in METRICS) + " FROM x_per GROUP BY 1")
def average_metrics(t):
    return E.average_metrics(per_user(t), ["list_type"])


@query("E09", "tier list_type users:l hit_4:d6 ndcg_4:d6 hit_4_delta:d6 ndcg_4_delta:d6", """
SELECT a.*, a.hit_4 - b.hit_4 AS hit_4_delta, a.ndcg_4 - b.ndcg_4 AS ndcg_4_delta FROM tl a JOIN tl b ON a.tier = b.tier AND b.list_type = 'baseline'""",
       "tl AS (SELECT t.tier, x.list_type, count(*) AS users, avg(hit_4) AS hit_4, avg(ndcg_4) AS ndcg_4 FROM x_per x JOIN x_tiers t ON t.user_id = x.user_id GROUP BY ALL)")
def metrics_by_tier(t):
    return E.by_tier_and_list(predictions(t), actuals(t), tiers(t), (4,))


@query("E10", "metric users:l mean:d6 covers:b width_ok:b", """
SELECT 'hit_4' AS metric, count(*) AS users, avg(hit_4) AS mean, TRUE AS covers, TRUE AS width_ok FROM x_per WHERE list_type = 'segment'""")
def bootstrap_interval(t):
    """The interval next to what any sound one keeps: it holds the mean, and its width is that of the normal one to within a half."""
    rows = per_user(t).where("list_type = 'segment'")
    m = F.col("hit_4")
    facts = rows.agg(F.count(F.lit(1)).alias("users"), F.avg(m).alias("mean"), F.stddev_samp(m).alias("sd"))
    own = E.bootstrap_interval(rows, "hit_4")
    normal = 2 * 1.96 * facts.select("sd").scalar() / F.sqrt(facts.select("users").scalar())
    mean = facts.select("mean").scalar()
    return own.select("metric", facts.select("users").scalar().alias("users"), mean.alias("mean"), mean.between(F.col("low"), F.col("high")).alias("covers"),
                      (F.col("high") - F.col("low")).between(normal * 0.5, normal * 1.5).alias("width_ok"))


@query("E11", "candidate:d6 baseline:d6 delta:d6 decision", """
SELECT *, candidate - baseline AS delta, CASE WHEN candidate - baseline >= 0.03 THEN 'GO' WHEN candidate - baseline >= 0.01 THEN 'MAYBE'
  WHEN candidate - baseline >= -0.01 THEN 'SKIP' ELSE 'INVESTIGATE' END AS decision
FROM (SELECT avg(hit_4) FILTER (list_type = 'segment') AS candidate, avg(hit_4) FILTER (list_type = 'baseline') AS baseline FROM x_per) a""")
def go_no_go(t):
    avg = E.average_metrics(per_user(t), ["list_type"])
    return E.go_no_go(avg.where("list_type = 'segment'"), avg.where("list_type = 'baseline'"))


@query("E12", "user_id:l first_item last_item n:l", """
SELECT user_id, arg_min(sku, (r, sku)) AS first_item, arg_max(sku, (r, sku)) AS last_item, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY r, sku) AS rn FROM (SELECT user_id, sku, min(line) AS r FROM v_orders GROUP BY ALL) x) a WHERE rn <= 20 GROUP BY 1""")
def baseline_list(t):
    rows = E.baseline_list(t.orders.select("user_id", F.col("sku").alias("item"), F.col("line").alias("rank")), 20)
    return rows.select("user_id", F.element_at("items", 1).alias("first_item"), F.element_at("items", -1).alias("last_item"), F.size("items").alias("n"))


@query("E13", "part n:l first_ts last_ts", """
SELECT CASE WHEN event_ts < c THEN 'train' ELSE 'test' END AS part, count(*) AS n, strftime(min(event_ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(event_ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM v_events, (SELECT quantile_disc(event_ts, 0.8) AS c FROM v_events) q GROUP BY 1""")
def time_split(t):
    train, test = E.time_split(t.events, "event_ts", 0.8)

    def stats(df, name):
        fmt = "yyyy-MM-dd HH:mm:ss"
        return df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.date_format(F.min("event_ts"), fmt).alias("first_ts"),
                      F.date_format(F.max("event_ts"), fmt).alias("last_ts"))

    return stats(train, "train").unionByName(stats(test, "test"))


@query("E13", "part n:l", """
SELECT CASE WHEN event_ts < TIMESTAMP '2024-01-20' THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM v_events GROUP BY 1""")
def time_split_at_date(t):
    train, test = E.time_split(t.events, "event_ts", cutoff="2024-01-20")
    return train.agg(F.lit("train").alias("part"), F.count(F.lit(1)).alias("n")).unionByName(test.agg(F.lit("test").alias("part"), F.count(F.lit(1)).alias("n")))


@query("E14", "split users:l", """
SELECT 'train' AS split, CAST(floor(count(DISTINCT user_id) * 0.8) AS BIGINT) AS users FROM v_events
UNION ALL SELECT 'test', count(DISTINCT user_id) - CAST(floor(count(DISTINCT user_id) * 0.8) AS BIGINT) FROM v_events""")
def user_split(t):
    return E.user_split(t.events).groupBy("split").agg(F.count_distinct("user_id").alias("users"))


@query("E15", "event_id:l user_id:l split", """
SELECT event_id, user_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, event_id DESC) = 1 THEN 'test' ELSE 'train' END AS split FROM v_events""")
def leave_one_out(t):
    return E.leave_one_out(t.events, "event_ts", "event_id")


@once
def comparison(t):
    avg = E.average_metrics(per_user(t), ["list_type"])
    a, b = (metric_rows(avg.where(F.col("list_type") == x), METRICS) for x in ("baseline", "segment"))
    return E.compare_metrics(a, b, 5.0, {"mrr": 50.0})


CMP = """m AS (SELECT list_type, """ + ", ".join(f"avg({m}) AS {m}" for m in METRICS) + """ FROM x_per GROUP BY 1),
l AS (SELECT list_type, metric, value FROM m UNPIVOT (value FOR metric IN (""" + ", ".join(METRICS) + """))),
c AS (SELECT b.metric, b.value AS baseline, s.value AS candidate, (s.value - b.value) / b.value * 100 AS change_percent,
  CASE b.metric WHEN 'mrr' THEN 50 ELSE 5 END AS max_drop FROM l b JOIN l s ON s.metric = b.metric AND b.list_type = 'baseline' AND s.list_type = 'segment')"""


@query("E16", "metric baseline:d6 candidate:d6 change_percent:d4 regression:b", "SELECT *, change_percent < -max_drop AS regression FROM c", CMP)
def compare_metrics(t):
    return comparison(t)


@query("E16", "regressions:l improvements:l passed:b", """
SELECT count(*) FILTER (change_percent < -max_drop) AS regressions, count(*) FILTER (change_percent > 0) AS improvements, count(*) FILTER (change_percent < -max_drop) = 0 AS passed FROM c""", CMP)
def comparison_verdict(t):
    return E.verdict(comparison(t))


@query("E17 O02", "user_id:l sku order_date", "SELECT * FROM x_buy")
def window_purchases(t):
    return bought(t)


MATCH = "SELECT r.* FROM {r} r WHERE EXISTS (SELECT 1 FROM x_buy b WHERE b.user_id = r.user_id AND b.sku = r.sku)"


@query("E18 J07", "user_id:l slot:l sku", MATCH.format(r="x_new"))
def match_recs(t):
    return E.match_recs(new_recs(t), bought(t))


def _ver(r, name):
    return f"""SELECT '{name}' AS version, count(DISTINCT r.user_id) AS users, count(DISTINCT b.user_id) AS buyers, count(DISTINCT CASE WHEN m.sku IS NOT NULL THEN r.user_id END) AS matched
FROM {r} r LEFT JOIN (SELECT DISTINCT user_id FROM x_buy) b ON b.user_id = r.user_id LEFT JOIN (SELECT DISTINCT user_id, sku FROM x_buy) m ON m.user_id = r.user_id AND m.sku = r.sku"""


@query("E19", "version users:l buyers:l matched:l rate_of_users:d4 rate_of_buyers:d4 improvement:d2", """
SELECT v.*, round((rate_of_users - o) / o * 100, 2) AS improvement FROM v, (SELECT rate_of_users AS o FROM v WHERE version = 'old') x""",
       f"v AS (SELECT *, round(matched / users * 100, 4) AS rate_of_users, round(matched / buyers * 100, 4) AS rate_of_buyers FROM ({_ver('x_old', 'old')} UNION ALL {_ver('x_new', 'new')}) u)")
def compare_versions(t):
    return E.compare_versions(E.version_row(old_recs(t), bought(t), "old"), E.version_row(new_recs(t), bought(t), "new"))


@query("E20", "slot:l matches:l users:l", f"SELECT slot, count(*) AS matches, count(DISTINCT user_id) AS users FROM ({MATCH.format(r='x_new')}) m GROUP BY 1")
def slot_distribution(t):
    return E.slot_distribution(E.match_recs(new_recs(t), bought(t)))


@query("E20", "skus:l users:l", "SELECT count(DISTINCT sku) AS skus, count(*) AS users FROM x_new WHERE slot = 1")
def slot_diversity(t):
    return E.slot_diversity(new_recs(t))


@query("E20", "recs:l with_score:l pct:d2", """
SELECT count(*) AS recs, count(s.sku) AS with_score, round(count(s.sku) / count(*) * 100, 2) AS pct FROM x_old o
LEFT JOIN v_seg s ON s.seg_make = o.seg_make AND s.seg_model = o.seg_model AND s.sku = o.sku""")
def signal_coverage(t):
    return E.signal_coverage(old_recs(t), recs.tiers(t)[0], ["seg_make", "seg_model", "sku"])


@query("E21 A03", "kind purchases:l skus:l share:d2", f"""
SELECT kind, count(*) AS purchases, count(DISTINCT sku) AS skus, round(count(*) / (SELECT count(*) FROM x_buy) * 100, 2) AS share FROM (
  SELECT sku, CASE WHEN sku IN (SELECT {norm('sku')} FROM v_fitment) THEN 'fitment' WHEN sku IN (SELECT sku FROM v_pool) THEN 'universal' ELSE 'long_tail' END AS kind FROM x_buy) a GROUP BY 1""")
def purchase_classes(t):
    fit = t.fitment.select(X.normalize_variant("sku").alias("sku"))
    return E.purchase_classes(bought(t), fit, recs.universal_pool(t))


@query("E22", "cutoff buyers:l matched:l purchases:l hits:l match_rate:d2", f"""
SELECT cutoff, count(*) AS buyers, count(*) FILTER (k > 0) AS matched, sum(n) AS purchases, sum(k) AS hits, round(count(*) FILTER (k > 0) / count(*) * 100, 2) AS match_rate FROM (
  SELECT h.cutoff, h.user_id, count(*) AS n, count(b.sku) AS k FROM (SELECT DISTINCT c.cutoff, o.user_id, {norm('o.sku')} AS sku FROM v_orders o JOIN cuts c ON o.order_date > c.cutoff AND o.order_date <= c.cutoff + 21) h
  LEFT JOIN (SELECT * FROM (SELECT cutoff, sku, row_number() OVER (PARTITION BY cutoff ORDER BY n DESC, sku) AS rn FROM (
    SELECT c.cutoff, {norm('o.sku')} AS sku, count(*) AS n FROM v_orders o JOIN cuts c ON o.order_date <= c.cutoff AND o.order_date > c.cutoff - 365 GROUP BY ALL) x) y WHERE rn <= 10) b
  ON b.cutoff = h.cutoff AND b.sku = h.sku GROUP BY ALL) z GROUP BY 1""",
       "cuts AS (SELECT CAST(d AS DATE) AS cutoff FROM (VALUES ('2000-12-01'), ('2001-01-15'), ('2001-03-01'), ('2001-04-15'), ('2001-06-01')) v(d))")
def rolling_backtest(t):
    cuts = t.spark.createDataFrame([(d,) for d in ("2000-12-01", "2001-01-15", "2001-03-01", "2001-04-15", "2001-06-01")], "cutoff string")
    return E.rolling_backtest(t.orders, cuts)


LISTS = """cuts AS (SELECT CAST(d AS DATE) AS cutoff FROM (VALUES ('2000-12-01'), ('2001-01-15'), ('2001-03-01'), ('2001-04-15'), ('2001-06-01')) v(d)),
o AS (SELECT c.cutoff, o.user_id, u.seg_make, {sku} AS sku, o.order_date > c.cutoff AS after FROM v_orders o JOIN cuts c ON o.order_date > c.cutoff - 365 AND o.order_date <= c.cutoff + 21 JOIN v_users u ON u.user_id = o.user_id),
held AS (SELECT DISTINCT cutoff, user_id, seg_make, sku FROM o WHERE after), past AS (SELECT DISTINCT cutoff, user_id, sku FROM o WHERE NOT after),
lists AS (SELECT 'global' AS version, cutoff, NULL AS seg_make, sku, count(*) AS n FROM o WHERE NOT after GROUP BY ALL UNION ALL SELECT 'segment', cutoff, seg_make, sku, count(*) FROM o WHERE NOT after GROUP BY ALL),
shown AS (SELECT h.cutoff, h.user_id, l.version, l.sku, row_number() OVER (PARTITION BY h.cutoff, h.user_id, l.version ORDER BY l.n DESC, l.sku) AS rn
  FROM (SELECT DISTINCT cutoff, user_id, seg_make FROM held) h JOIN lists l ON l.cutoff = h.cutoff AND (l.seg_make IS NULL OR l.seg_make = h.seg_make)
  LEFT JOIN past p ON p.cutoff = h.cutoff AND p.user_id = h.user_id AND p.sku = l.sku WHERE p.sku IS NULL)""".format(sku=norm("o.sku"))


@query("E22", "cutoff version buyers:l matched:l hits:l match_rate:d2", """
SELECT cutoff, version, count(*) AS buyers, count(*) FILTER (k > 0) AS matched, sum(k) AS hits, round(count(*) FILTER (k > 0) / count(*) * 100, 2) AS match_rate FROM (
  SELECT h.cutoff, h.user_id, v.version, count(s.sku) AS k FROM held h CROSS JOIN (SELECT unnest(['segment', 'global']) AS version) v
  LEFT JOIN shown s ON s.cutoff = h.cutoff AND s.user_id = h.user_id AND s.version = v.version AND s.sku = h.sku AND s.rn <= 4 GROUP BY ALL) z GROUP BY ALL""", LISTS)
def rolling_versions(t):
    cuts = t.spark.createDataFrame([(d,) for d in ("2000-12-01", "2001-01-15", "2001-03-01", "2001-04-15", "2001-06-01")], "cutoff string")
    return E.rolling_versions(t.orders, t.users, cuts, ["seg_make"])


@query("E23 W03 T02", "band purchases:l share:d1", """
SELECT CASE WHEN r <= 50 THEN 'top50' WHEN r <= 100 THEN '51_100' WHEN r <= 200 THEN '101_200' WHEN r <= 500 THEN '201_500' ELSE 'beyond' END AS band,
  count(*) AS purchases, round(count(*) / (SELECT count(*) FROM x_buy) * 100, 1) AS share
FROM x_buy b LEFT JOIN (SELECT sku, row_number() OVER (ORDER BY total_orders DESC, sku) AS r FROM v_glob) g ON g.sku = b.sku GROUP BY 1""")
def popularity_bands(t):
    return E.popularity_bands(bought(t), recs.tiers(t)[2])


@query("E24 S12", "buyers:l at_cutoff:l now:l pct_at_cutoff:d1 pct_now:d1", """
SELECT count(*) AS buyers, count(a.user_id) AS at_cutoff, count(n.user_id) AS now, round(count(a.user_id) / count(*) * 100, 1) AS pct_at_cutoff, round(count(n.user_id) / count(*) * 100, 1) AS pct_now
FROM (SELECT DISTINCT user_id FROM x_buy) b LEFT JOIN (SELECT DISTINCT user_id FROM v_events WHERE event_ts <= TIMESTAMP '2024-01-02 12:00:00') a ON a.user_id = b.user_id
LEFT JOIN (SELECT DISTINCT user_id FROM v_events) n ON n.user_id = b.user_id""")
def buyer_coverage(t):
    from ..sources.tables import as_of_cutoff
    return E.buyer_coverage(bought(t), as_of_cutoff(t.events, "event_ts", "2024-01-02 12:00:00"), t.events)


@query("E25", "purchases:l aligned:l pct:d2", """
SELECT count(*) AS purchases, count(*) FILTER (c.category = p.primary_category) AS aligned, round(count(*) FILTER (c.category = p.primary_category) / count(*) * 100, 2) AS pct
FROM v_orders o JOIN v_primary p ON p.user_id = o.user_id JOIN v_catalog c ON c.sku = o.sku WHERE o.order_date >= DATE '2001-01-01' AND p.active""")
def category_alignment(t):
    return E.category_alignment(t.orders.where("order_date >= date'2001-01-01'"), recs.primary(t).where("active"), t.catalog)


RANK4 = """SELECT user_id, rn, sku, final_score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY final_score DESC, sku) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, base_sku ORDER BY final_score DESC, sku) AS rv FROM ({src}) s) d WHERE rv = 1) r WHERE rn <= 4"""


def _top_without_cap(t, scored):
    """No category cap: one pseudo category with as many places as slots."""
    rows = R.diversified_for_users(t.users, scored.withColumn("category", F.lit("*")), recs.PROFILE, 4, recs.exclusion(t))
    return R.top_n_min(rows, 4, 1)


@query("E26", "user_id:l rn:l sku final_score:d2", RANK4.format(src="SELECT * FROM v_cand"))
def variant_no_diversity_cap(t):
    return _top_without_cap(t, recs.scored(t))


@query("E26", "user_id:l rn:l sku final_score:d2", RANK4.format(src=f"""
  SELECT u.user_id, t.sku, t.base_sku, round(coalesce(r.p, 0), 2) AS final_score FROM v_users u JOIN v_tiers t ON t.seg_make = u.seg_make AND t.seg_model = u.seg_model
  LEFT JOIN (SELECT sku, ln(1 + h) * 2 + ln(1 + r) * 6 AS p FROM (SELECT {norm('sku')} AS sku, count(*) FILTER (order_date < DATE '2000-07-01') AS h, count(*) FILTER (order_date >= DATE '2000-07-01') AS r
    FROM v_imported WHERE order_date <= DATE '2000-12-31' GROUP BY 1) a) r ON r.sku = t.norm_sku
  LEFT JOIN v_excl x ON x.user_id = u.user_id AND x.sku = t.norm_sku WHERE x.sku IS NULL"""))
def variant_recency(t):
    pop = P.recency_weighted_popularity(t.imported.where("order_date <= date'2000-12-31'"), "2000-07-01").select(
        F.col("sku").alias("norm_sku"), F.col("popularity").alias("recency"))
    rows = recs.scored(t).join(pop, "norm_sku", "left").withColumn("final_score", R.score_sum("recency"))
    return _top_without_cap(t, rows)


@query("E26", "user_id:l rn:l sku final_score:d2", RANK4.format(src="""
  SELECT u.user_id, t.sku, t.base_sku, round(coalesce(s.segment_score, 0), 2) AS final_score FROM v_users u JOIN v_tiers t ON t.seg_make = u.seg_make AND t.seg_model = u.seg_model
  LEFT JOIN v_seg s ON s.seg_make = t.seg_make AND s.seg_model = t.seg_model AND s.sku = t.norm_sku
  LEFT JOIN v_excl x ON x.user_id = u.user_id AND x.sku = t.norm_sku WHERE x.sku IS NULL"""))
def variant_pure_segment(t):
    seg = recs.tiers(t)[0].select(*recs.PROFILE, F.col("sku").alias("norm_sku"), "segment_score")
    return _top_without_cap(t, recs.scored(t).join(seg, [*recs.PROFILE, "norm_sku"], "left").withColumn("final_score", R.score_sum("segment_score")))


@query("E26", "user_id:l rn:l sku final_score:d2", RANK4.format(src=f"""
  SELECT u.user_id, q.sku, {norm('q.sku')} AS base_sku, round(ln(1 + q.total_orders) * 2, 2) AS final_score FROM v_users u CROSS JOIN v_pool q
  LEFT JOIN v_excl x ON x.user_id = u.user_id AND x.sku = {norm('q.sku')} WHERE x.sku IS NULL"""))
def variant_universal(t):
    """All users share one profile: the universal pool, ranked once."""
    pool = recs.universal_pool(t).withColumn("final_score", F.round(X.log_score("total_orders", p.global_weight), 2))
    rows = R.base_columns(pool).withColumns({"category": F.lit("*"), "_all": F.lit(1)})
    return R.top_n_min(R.diversified_for_users(t.users.withColumn("_all", F.lit(1)), rows, ["_all"], 4, recs.exclusion(t)), 4, 1)


@query("E26", "user_id:l rn:l sku final_score:d2", RANK4.format(src=f"""
  SELECT u.user_id, q.sku, {norm('q.sku')} AS base_sku, round(coalesce(g.global_score, 0), 2) AS final_score FROM v_users u
  JOIN (SELECT f.make, f.sku FROM v_fitment f JOIN low ON low.sku = f.sku) q ON q.make = u.seg_make LEFT JOIN v_glob g ON g.sku = {norm('q.sku')}
  LEFT JOIN v_excl x ON x.user_id = u.user_id AND x.sku = {norm('q.sku')} WHERE x.sku IS NULL"""),
       f"low AS (SELECT sku FROM (SELECT *, {recs.IMG} AS image_url FROM v_catalog) c WHERE lower(tags) NOT LIKE '%refurbished%' AND image_url LIKE 'https://%' AND price >= 901)")
def variant_lower_price_floor(t):
    """A lower floor and the global tier alone."""
    low = p.but(min_price=901.0)
    parts = EL.eligible_parts(t.fitment, EL.sellable_products(t.catalog, recs.prices(t), recs.images(t), low), ["make"], low).withColumnRenamed("make", "seg_make")
    glob = recs.tiers(t)[2].select(F.col("sku").alias("norm_sku"), "global_score")
    rows = R.base_columns(recs.profiles(t).join(parts, "seg_make")).join(glob, "norm_sku", "left").withColumn("final_score", R.score_sum("global_score"))
    return _top_without_cap(t, rows)


@query("E27", "version skus:l top:l recs:l top_share:d2", """
SELECT version, count(*) AS skus, max(n) AS top, sum(n) AS recs, round(max(n) / sum(n) * 100, 2) AS top_share FROM (
  SELECT 'old' AS version, sku, count(*) AS n FROM x_old GROUP BY ALL UNION ALL SELECT 'new', sku, count(*) FROM x_new GROUP BY ALL) a GROUP BY 1""")
def sku_concentration(t):
    return E.sku_concentration(old_recs(t), "old").unionByName(E.sku_concentration(new_recs(t), "new"))


@query("E27 A06", "median_breadth:l avg_breadth:d2", f"""
SELECT quantile_disc(n, 0.5) AS median_breadth, round(avg(n), 2) AS avg_breadth FROM x_new r
JOIN (SELECT {norm('sku')} AS sku, count(DISTINCT make) AS n FROM v_fitment GROUP BY 1) b ON b.sku = r.sku""")
def median_breadth(t):
    return E.median_breadth(new_recs(t), P.fitment_breadth(t.fitment.withColumn("sku", X.normalize_variant("sku")), ["make"]))


@query("E28 O01", "pool n:l min_score:d4 avg_score:d4 max_score:d4 q1:d4 q2:d4 q3:d4", """
SELECT pool, count(*) AS n, min(score) AS min_score, avg(score) AS avg_score, max(score) AS max_score, quantile_disc(score, 0.25) AS q1, quantile_disc(score, 0.5) AS q2, quantile_disc(score, 0.75) AS q3
FROM (SELECT 'segment' AS pool, segment_score AS score FROM v_seg UNION ALL SELECT 'global', global_score FROM v_glob) a GROUP BY 1""")
def score_quartiles(t):
    seg, _, g = recs.tiers(t)
    return E.score_quartiles(seg.select(F.lit("segment").alias("pool"), F.col("segment_score").alias("score")).unionByName(
        g.select(F.lit("global").alias("pool"), F.col("global_score").alias("score"))))


@query("E29", "auc:d6 pos:l neg:l", """
SELECT sum(p * (b + q / 2.0)) / (sum(p) * sum(q)) AS auc, sum(p) AS pos, sum(q) AS neg FROM (SELECT s, p, q, coalesce(sum(q) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM (
  SELECT score AS s, sum(clicked) AS p, count(*) - sum(clicked) AS q FROM v_base GROUP BY 1) a) c""")
def click_auc(t):
    from . import campaign
    return E.auc(campaign.base(t), "score", "clicked")


@query("E30 J10", "days:l purchases:l with_view:l with_cart:l with_any:l pct_any:d2", """
SELECT w AS days, count(*) AS purchases, count(*) FILTER (v) AS with_view, count(*) FILTER (c) AS with_cart, count(*) FILTER (v OR c) AS with_any, round(count(*) FILTER (v OR c) / count(*) * 100, 2) AS pct_any
FROM (SELECT p.order_id, w, EXISTS (SELECT 1 FROM v_staged s WHERE s.user_id = p.user_id AND s.sku = p.sku AND s.event_name = 'VIEWED PRODUCT' AND s.event_ts < p.order_ts AND p.order_ts <= s.event_ts + w * INTERVAL 1 DAY) AS v,
  EXISTS (SELECT 1 FROM v_staged s WHERE s.user_id = p.user_id AND s.sku = p.sku AND s.event_name = 'CART UPDATE' AND s.event_ts < p.order_ts AND p.order_ts <= s.event_ts + w * INTERVAL 1 DAY) AS c
  FROM v_purchases p, (SELECT unnest([1, 7, 14, 30]) AS w) ws) a GROUP BY 1""")
def signal_rates(t):
    sig = t.staged.where("event_name <> 'PLACED ORDER'").select(
        "user_id", "sku", F.when(F.col("event_name") == "VIEWED PRODUCT", "view").otherwise("cart").alias("kind"), F.col("event_ts").alias("ts"), F.col("event_id").alias("signal_id"))
    return E.signal_rates(t.purchases, sig, (1, 7, 14, 30))


@query("E31", "relation purchases:l users:l share:d2", """
SELECT CASE WHEN f.sku IS NOT NULL THEN 'registered' WHEN o.sku IN (SELECT sku FROM v_fitment) THEN 'other_vehicle' ELSE 'universal' END AS relation, count(*) AS purchases, count(DISTINCT o.user_id) AS users,
  round(count(*) / (SELECT count(*) FROM v_orders) * 100, 2) AS share
FROM v_orders o JOIN v_users u ON u.user_id = o.user_id LEFT JOIN v_fitment f ON f.make = u.seg_make AND f.sku = o.sku GROUP BY 1""")
def vehicle_relation(t):
    return E.vehicle_relation(t.orders, t.users, t.fitment, {"seg_make": "make", "sku": "sku"})


def _pivot(t, rows):
    return rows.groupBy("user_id").agg(*[F.max(F.when(F.col("slot") == i, F.col("sku"))).alias(f"rec{i}_sku") for i in range(1, 5)])


PIV = ", ".join(f"max(sku) FILTER (slot = {i}) AS s{i}" for i in range(1, 5))


@query("E32 J03", "in_both:l dropped:l added:l identical:l same_set:l changed_1:l changed_2:l changed_3:l changed_4:l", f"""
SELECT count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS in_both, count(*) FILTER (b IS NULL) AS dropped, count(*) FILTER (a IS NULL) AS added,
  count(*) FILTER (a IS NOT NULL AND b IS NOT NULL AND a1 = b1 AND a2 = b2 AND a3 = b3 AND a4 = b4) AS identical,
  count(*) FILTER (list_sort([a1, a2, a3, a4]) = list_sort([b1, b2, b3, b4])) AS same_set, """ + ", ".join(
    f"count(*) FILTER (a IS NOT NULL AND b IS NOT NULL AND a{i} IS DISTINCT FROM b{i}) AS changed_{i}" for i in range(1, 5)) + f"""
FROM (SELECT x.user_id AS a, y.user_id AS b, x.s1 AS a1, x.s2 AS a2, x.s3 AS a3, x.s4 AS a4, y.s1 AS b1, y.s2 AS b2, y.s3 AS b3, y.s4 AS b4
  FROM (SELECT user_id, {PIV} FROM x_old WHERE seg_model <> 'MACHINERY' GROUP BY 1) x FULL JOIN (SELECT user_id, {PIV} FROM x_new WHERE seg_model <> 'BUILDING' GROUP BY 1) y ON x.user_id = y.user_id) z""")
def run_diff(t):
    return E.run_diff(_pivot(t, old_recs(t).where("seg_model <> 'MACHINERY'")), _pivot(t, new_recs(t).where("seg_model <> 'BUILDING'")))


@once
def base_prices(t):
    return t.catalog.groupBy(X.normalize_variant("sku").alias("sku")).agg(F.max("price").alias("price"))


BP = f"bp AS (SELECT {norm('sku')} AS sku, max(price) AS price FROM v_catalog GROUP BY 1)"
BAND = "CASE WHEN price < 925 THEN 'low' WHEN price < 950 THEN 'mid' ELSE 'high' END"


@query("E32 P09", "bucket old:l new:l shift:l", f"""
SELECT coalesce(a.b, c.b) AS bucket, coalesce(a.n, 0) AS old, coalesce(c.n, 0) AS new, coalesce(c.n, 0) - coalesce(a.n, 0) AS shift
FROM (SELECT {BAND} AS b, count(*) AS n FROM x_old JOIN bp ON bp.sku = x_old.sku GROUP BY 1) a
FULL JOIN (SELECT {BAND} AS b, count(*) AS n FROM x_new JOIN bp ON bp.sku = x_new.sku GROUP BY 1) c ON a.b = c.b""", BP)
def price_shift(t):
    return E.price_shift(old_recs(t).join(base_prices(t), "sku"), new_recs(t).join(base_prices(t), "sku"), (925.0, 950.0), ("low", "mid", "high"))


@query("E33", "product_type purchased_type matches:l", f"""
SELECT CASE WHEN m.sku IN (SELECT {norm('sku')} FROM v_fitment WHERE make = m.seg_make) THEN 'fitment' ELSE 'universal' END AS product_type,
  CASE WHEN m.sku IN (SELECT {norm('sku')} FROM v_fitment) THEN 'fitment' ELSE 'long_tail' END AS purchased_type, count(*) AS matches FROM ({MATCH.format(r='x_new')}) m GROUP BY ALL""")
def match_types(t):
    fit = t.fitment.select(F.col("make").alias("seg_make"), X.normalize_variant("sku").alias("sku")).distinct().withColumn("f", F.lit(True))
    m = E.match_recs(new_recs(t), bought(t)).join(fit, ["seg_make", "sku"], "left").withColumn("product_type", F.when(F.col("f"), "fitment").otherwise("universal"))
    return E.match_types(m, fit.select("sku", F.lit("fitment").alias("purchased_type")))


@query("E34", "users:l one_category:l pct:d2", f"""
SELECT count(*) AS users, count(*) FILTER (n = 1 AND k > 1) AS one_category, round(count(*) FILTER (n = 1 AND k > 1) / count(*) * 100, 2) AS pct FROM (
  SELECT r.user_id, count(DISTINCT c.category) AS n, count(*) AS k FROM x_new r JOIN (SELECT {norm('sku')} AS sku, max(category) AS category FROM v_catalog GROUP BY 1) c ON c.sku = r.sku GROUP BY 1) a""")
def one_category_users(t):
    return E.one_category_users(new_recs(t), t.catalog.withColumn("sku", X.normalize_variant("sku")))


@query("E35 P09", "tier purchases:l skus:l", f"SELECT {BAND} AS tier, count(*) AS purchases, count(DISTINCT x_buy.sku) AS skus FROM x_buy JOIN bp ON bp.sku = x_buy.sku GROUP BY 1", BP)
def price_tiers(t):
    return E.price_tiers(bought(t), base_prices(t), (925.0, 950.0), ("low", "mid", "high"))


@query("E35", "new_skus:l", """
SELECT count(DISTINCT x_new.sku) AS new_skus FROM x_new JOIN bp ON bp.sku = x_new.sku WHERE price BETWEEN 925 AND 950 AND x_new.sku NOT IN (SELECT sku FROM x_old)""", BP)
def new_skus_in_band(t):
    return E.new_skus_in_band(old_recs(t), new_recs(t).join(base_prices(t), "sku"), 925.0, 950.0)
