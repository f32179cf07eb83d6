"""Bandit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bandit as B
from .registry import once, query
from .sql_views import VIEWS

VIEWS["v_all_flags"] = """
SELECT s.*, CASE s.model_id WHEN 1 THEN 'Random' ELSE 'Bandit' END AS arm, CAST(s.sent_ts AS DATE) AS send_date,
  coalesce(i.o, 0) AS opened, coalesce(i.c, 0) AS clicked, fo AS first_open, fc AS first_click
FROM v_sends s LEFT JOIN (SELECT tracking_id, max(CASE WHEN type = 'VIEWED' THEN 1 ELSE 0 END) AS o, max(CASE WHEN type = 'CLICKED' THEN 1 ELSE 0 END) AS c,
  min(CASE WHEN type = 'VIEWED' THEN ts END) AS fo, min(CASE WHEN type = 'CLICKED' THEN ts END) AS fc FROM v_interactions GROUP BY 1) i
ON i.tracking_id = s.tracking_id"""
VIEWS["v_flags"] = "SELECT * FROM v_all_flags WHERE source = 'LIVE'"
BOTH = "count(*) FILTER (opened = 1 AND clicked = 1)"
CTR = f"""ctr AS (SELECT *, clicks / n AS ctr FROM (SELECT treatment_id, count(*) FILTER (opened = 1) AS n, {BOTH} AS clicks
  FROM v_flags WHERE send_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-29' GROUP BY 1) a WHERE n > 0)"""


@once
def all_flags(t):
    return B.send_flags(t.sends, t.interactions)


@once
def flags(t):
    return all_flags(t).where("source = 'LIVE'")


@once
def ctr(t):
    return B.treatment_ctr(flags(t), "2024-01-05", "2024-01-29")


@query("B01", "treatment_id:l n:l clicks:l ctr:d6", "SELECT * FROM ctr", CTR)
def treatment_ctr(t):
    return ctr(t)


@query("B02", "treatment_id:l alpha:d4 beta:d4 mean:d6 stddev:d6", """
SELECT treatment_id, a AS alpha, b AS beta, a / (a + b) AS mean, sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS stddev
FROM (SELECT treatment_id, 1.0 + clicks AS a, 1.0 + n - clicks AS b FROM (SELECT treatment_id, CAST(n AS DOUBLE) AS n, CAST(clicks AS DOUBLE) AS clicks FROM ctr) d) e""", CTR)
def beta_posterior(t):
    return B.with_beta(ctr(t))


NIG = """SELECT treatment_id, k / (1 + n) AS mu, 1 + n AS lam, 1 + n / 2 AS alpha, b AS beta, sqrt(b / ((1 + n) * (1 + n / 2 - 0.5))) AS stddev FROM (
SELECT *, 1 + 0.5 * (k - k * k / {d}) + 0.5 * n * (k / n) * (k / n) / (1 + n) AS b FROM (SELECT treatment_id, CAST(n AS DOUBLE) AS n, CAST(clicks AS DOUBLE) AS k FROM ctr) c) e"""
NIG_COLS = "treatment_id:l mu:d6 lam:d2 alpha:d2 beta:d6 stddev:d6"


@query("B03", NIG_COLS, NIG.format(d="(1 + n)"), CTR)
def nig_posterior(t):
    return B.with_nig(ctr(t))


@query("B03", NIG_COLS, NIG.format(d="n"), CTR)
def nig_posterior_exact(t):
    return B.with_nig(ctr(t), exact=True)


@once
def assigned(t):
    return B.thompson_assign(t.users, t.sends.select("treatment_id"), B.with_beta(ctr(t)), 19754)


# The same draw from MD5 digits: uniform, Box-Muller normal, best of the user's draws.
UNIFORM = "(CAST(concat('0x', substr(md5(concat(seed, ':{salt}')), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0"
THOMPSON = CTR + f""", arms AS (SELECT d.treatment_id, coalesce(a / (a + b), 0.0) AS mean, coalesce(sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0.05) AS sd
  FROM (SELECT DISTINCT treatment_id FROM v_sends) d LEFT JOIN (SELECT treatment_id, 1.0 + CAST(clicks AS DOUBLE) AS a, 1.0 + CAST(n AS DOUBLE) - clicks AS b FROM ctr) c
  ON c.treatment_id = d.treatment_id),
seeds AS (SELECT u.user_id, r.*, concat(r.treatment_id, ':', u.user_id, '@19754') AS seed FROM v_users u CROSS JOIN arms r),
draws AS (SELECT user_id, treatment_id, mean + sd * sqrt(-2 * ln({UNIFORM.format(salt=0)})) * cos(2 * pi() * {UNIFORM.format(salt=1)}) AS score FROM seeds),
drawn AS (SELECT user_id, treatment_id, score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, treatment_id DESC) AS rn FROM draws) a WHERE rn = 1)"""


@query("B04", "user_id:l treatment_id:l score:d6", "SELECT * FROM drawn", THOMPSON)
def thompson_assign(t):
    return assigned(t)


@query("B05", "treatment_id:l selected:l share:d6 n:l clicks:l ctr:d6", """
SELECT s.treatment_id, s.selected, s.selected / sum(s.selected) OVER () AS share, c.n, c.clicks, c.ctr
FROM (SELECT treatment_id, count(*) AS selected FROM drawn GROUP BY 1) s LEFT JOIN ctr c ON c.treatment_id = s.treatment_id""", THOMPSON)
def selection_share(t):
    return B.selection_share(assigned(t), ctr(t))


@query("B05", "treatment_id:l selected:l share:d6 n:l clicks:l ctr:d6", """
SELECT s.treatment_id, s.selected, s.selected / sum(s.selected) OVER () AS share, c.n, c.clicks, c.ctr
FROM (SELECT treatment_id, count(*) AS selected FROM v_flags GROUP BY 1) s LEFT JOIN ctr c ON c.treatment_id = s.treatment_id""", CTR)
def sent_share_vs_ctr(t):
    return B.selection_share(flags(t), ctr(t))


@query("B06 A05", "send_date arm sends:l avg_score:d9 std_score:d9 min_score:d9 max_score:d9 distinct_scores:l", """
SELECT send_date, arm, count(*) AS sends, avg(score) AS avg_score, stddev_samp(score) AS std_score, min(score) AS min_score, max(score) AS max_score,
  count(DISTINCT round(score, 4)) AS distinct_scores FROM v_flags GROUP BY ALL""")
def score_drift(t):
    return B.score_drift(flags(t))


@query("B07 T02", "send_date treatment_id:l sends:l avg_score:d9", """
SELECT send_date, treatment_id, count(*) AS sends, avg(score) AS avg_score FROM v_flags WHERE treatment_id IN (
  SELECT treatment_id FROM v_flags GROUP BY 1 ORDER BY count(*) DESC, treatment_id LIMIT 5) GROUP BY ALL""")
def top_treatment_scores(t):
    return B.top_treatment_scores(flags(t))


RATES = f"""SELECT *, round(opens / sends * 100, 2) AS open_rate, round(clicks / nullif(opens, 0) * 100, 2) AS ctr_of_opens, round(clicks / sends * 100, 2) AS ctr_of_sends
FROM (SELECT {{k}}, count(*) AS sends, sum(opened) AS opens, {BOTH} AS clicks FROM v_flags GROUP BY ALL) a"""
RCOLS = "sends:l opens:l clicks:l open_rate:d2 ctr_of_opens:d2 ctr_of_sends:d2"


@query("B08", "week arm " + RCOLS, RATES.format(k="CAST(date_trunc('week', send_date) AS DATE) AS week, arm"))
def weekly_rates(t):
    return B.rates_by(flags(t).withColumn("week", F.to_date(F.date_trunc("week", "send_date"))), "week", "arm")


@query("B08", "period arm treatment_type " + RCOLS, RATES.format(k="period, arm, treatment_type"))
def pre_post_rates(t):
    return B.rates_by(flags(t), "period", "arm", "treatment_type")


@query("B08", "send_date arm sends:l avg_score:d4 std_score:d4 opens:l clicks:l open_rate:d2 ctr_of_opens:d2", f"""
SELECT *, round(opens / sends * 100, 2) AS open_rate, round(clicks / nullif(opens, 0) * 100, 2) AS ctr_of_opens FROM (
SELECT send_date, arm, count(*) AS sends, round(avg(score), 4) AS avg_score, round(stddev_samp(score), 4) AS std_score, sum(opened) AS opens, {BOTH} AS clicks
FROM v_flags WHERE send_date >= DATE '2024-01-24' GROUP BY ALL) a""")
def seven_day_health(t):
    return B.health(flags(t), "2024-01-24")


DAYS = """days AS (SELECT treatment_id, send_date, count(*) AS sends, avg(score) AS avg_score, sum(opened) AS opens, sum(clicked) AS clicks FROM v_flags GROUP BY ALL)"""


@query("B09 W05", "treatment_id:l send_date sends:l opens:l clicks:l avg_score:d9 next_score:d9 delta:d9", """
SELECT *, next_score - avg_score AS delta FROM (SELECT *, lead(avg_score) OVER (PARTITION BY treatment_id ORDER BY send_date) AS next_score FROM days) a""", DAYS)
def click_feedback(t):
    return B.click_feedback(flags(t))


@query("B09 W05", "treatment_id:l send_date clicks:l delta_d1:d9 delta_d2:d9 direction", """
SELECT *, d1 - avg_score AS delta_d1, d2 - avg_score AS delta_d2, CASE WHEN d1 > avg_score THEN 'UP' WHEN d1 < avg_score THEN 'DOWN' ELSE 'FLAT' END AS direction
FROM (SELECT *, lead(avg_score) OVER w AS d1, lead(avg_score, 2) OVER w AS d2 FROM days WHERE clicks > 0 WINDOW w AS (PARTITION BY treatment_id ORDER BY send_date)) a
WHERE d1 IS NOT NULL""", DAYS)
def click_direction(t):
    return B.click_direction(flags(t))


@query("B10 W06 A04", "arm treatment_id:l sends:l avg_score:d9 share:d2", """
SELECT * FROM (SELECT *, round(sends / sum(sends) OVER (PARTITION BY arm) * 100, 2) AS share FROM (
  SELECT arm, treatment_id, count(*) AS sends, avg(score) AS avg_score FROM v_flags GROUP BY ALL) a) b WHERE sends >= 10""")
def selection_distribution(t):
    return B.selection_distribution(flags(t))


@query("B11 P09 W06", "arm bucket sends:l share:d2", """
SELECT *, round(sends / sum(sends) OVER (PARTITION BY arm) * 100, 2) AS share FROM (SELECT arm,
  CASE WHEN score < 0 THEN '<0' WHEN score < 0.01 THEN '0-0.01' WHEN score < 0.02 THEN '0.01-0.02' WHEN score < 0.05 THEN '0.02-0.05' WHEN score < 0.1 THEN '0.05-0.1'
   WHEN score < 0.2 THEN '0.1-0.2' WHEN score < 0.5 THEN '0.2-0.5' WHEN score < 1 THEN '0.5-1' ELSE '>=1' END AS bucket, count(*) AS sends FROM v_flags GROUP BY ALL) a""")
def score_histogram(t):
    return B.score_histogram(flags(t))


@query("B12 A10", "segment users:l sends:l avg_sends:d1 random_sends:l bandit_sends:l", """
SELECT CASE WHEN b = 0 THEN 'Random Only' WHEN r = 0 THEN 'Bandit Only' ELSE 'Both Arms' END AS segment, count(*) AS users, sum(n) AS sends, round(avg(n), 1) AS avg_sends,
  sum(r) AS random_sends, sum(b) AS bandit_sends FROM (SELECT user_id, count(*) AS n, count(*) FILTER (arm = 'Random') AS r, count(*) FILTER (arm = 'Bandit') AS b FROM v_flags GROUP BY 1) a GROUP BY 1""")
def stickiness(t):
    return B.stickiness(flags(t))


@query("B13 A13", "metric value:d1", """
SELECT 'total_sends' AS metric, count(*) FILTER (source = 'LIVE') AS value FROM v_all_flags
UNION ALL SELECT 'phantom_clicks', count(*) FILTER (source = 'LIVE' AND clicked = 1 AND opened = 0) FROM v_all_flags
UNION ALL SELECT 'phantom_clicks_bandit', count(*) FILTER (source = 'LIVE' AND clicked = 1 AND opened = 0 AND arm = 'Bandit') FROM v_all_flags
UNION ALL SELECT 'duplicate_ids', count(*) - count(DISTINCT tracking_id) FROM v_flags
UNION ALL SELECT 'not_live', count(*) FILTER (source <> 'LIVE') FROM v_all_flags
UNION ALL SELECT 'clicks_before_send', count(*) FILTER (first_click < sent_ts) FROM v_flags
UNION ALL SELECT 'opens_before_send', count(*) FILTER (first_open < sent_ts) FROM v_flags
UNION ALL SELECT 'score_not_positive', count(*) FILTER (score <= 0 AND arm = 'Bandit') FROM v_flags
UNION ALL SELECT 'score_above_limit', count(*) FILTER (score > 0.2 AND arm = 'Bandit') FROM v_flags""")
def training_audit(t):
    return B.training_audit(all_flags(t), 0.2)


@query("B14", "send_date arm treatments:l top_share:d2 hhi:d4 uniform:d4", """
SELECT send_date, arm, count(*) AS treatments, max(s) * 100 AS top_share, sum(s * s) AS hhi, 1.0 / count(*) AS uniform FROM (
  SELECT *, n / sum(n) OVER (PARTITION BY send_date, arm) AS s FROM (SELECT send_date, arm, treatment_id, count(*) AS n FROM v_flags GROUP BY ALL) a) b GROUP BY ALL""")
def concentration(t):
    return B.concentration(flags(t))


@query("B15", "treatment_id:l n_sends:l n_clicks:l expected:d6 recent_score:d9 delta:d6 ratio:d2 recent_std:d9 expected_std:d6 verdict", """
SELECT *, recent_score - expected AS delta, round(recent_score / nullif(expected, 0), 2) AS ratio, sqrt(1.0 / ((1 + n_sends) * (0.5 + n_sends / 2))) AS expected_std,
  CASE WHEN abs(recent_score - expected) < 0.005 THEN 'MATCH' WHEN abs(recent_score - expected) < 0.01 THEN 'CLOSE' WHEN abs(recent_score - expected) < 0.02 THEN 'DIVERGENT' ELSE 'MISMATCH' END AS verdict
FROM (SELECT s.treatment_id, n_sends, n_clicks, round(n_clicks / (1 + n_sends), 6) AS expected, r.recent_score, r.recent_std
  FROM (SELECT treatment_id, count(*) AS n_sends, sum(clicked) AS n_clicks FROM v_flags GROUP BY 1 HAVING count(*) >= 100) s
  LEFT JOIN (SELECT treatment_id, avg(score) AS recent_score, stddev_samp(score) AS recent_std FROM v_flags WHERE send_date >= DATE '2024-01-28' GROUP BY 1) r
  ON r.treatment_id = s.treatment_id) a""")
def posterior_check(t):
    return B.posterior_check(flags(t), "2024-01-28")


INVALID = "SELECT {k}, count(*) AS sends, avg(score) AS avg_score, max(score) AS max_score, min(send_date) AS first_day, max(send_date) AS last_day FROM v_flags WHERE score > 0.2 GROUP BY 1"


@query("B16", "send_date sends:l avg_score:d4 max_score:d4", INVALID.format(k="send_date"))
def invalid_scores_daily(t):
    return B.invalid_scores(flags(t), "send_date", 0.2)


@query("B16", "treatment_id:l sends:l avg_score:d4 max_score:d4 first_day last_day", INVALID.format(k="treatment_id"))
def invalid_scores_by_treatment(t):
    return B.invalid_scores(flags(t), "treatment_id", 0.2)


@query("B16 P09", "treatment_id:l sends:l clicks:l opens:l ctr:d2 volume", """
SELECT treatment_id, count(*) AS sends, sum(clicked) AS clicks, sum(opened) AS opens, round(sum(clicked) / count(*) * 100, 2) AS ctr,
  CASE WHEN count(*) < 50 THEN 'LOW' WHEN count(*) < 200 THEN 'MEDIUM' ELSE 'HIGH' END AS volume FROM v_flags
WHERE send_date < DATE '2024-01-22' AND treatment_id IN (SELECT treatment_id FROM v_flags WHERE score > 0.2) GROUP BY 1""")
def invalid_history(t):
    return B.invalid_history(flags(t), "2024-01-22", 0.2)


@query("B17", "treatment_id:l sends:l opens:l clicks:l active_days:l ctr:d2 per_day:d2 opens_per_week:d1", f"""
SELECT *, round(clicks / nullif(opens, 0) * 100, 2) AS ctr, round(sends / active_days, 2) AS per_day, round(opens / active_days * 7, 1) AS opens_per_week FROM (
  SELECT treatment_id, count(*) AS sends, sum(opened) AS opens, {BOTH} AS clicks, count(DISTINCT send_date) AS active_days FROM v_flags GROUP BY 1) a""")
def treatment_volume(t):
    return B.treatment_volume(flags(t))
