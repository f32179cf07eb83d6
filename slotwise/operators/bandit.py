"""Posteriors, treatment assignment and audits of a click bandit.

Interactions are reduced to one row per message before they meet the sends. Windows only
run over daily or per-treatment aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.keyed import global_top, metric_rows, share_of_group

RANDOM_MODEL = 1
DEFAULT_MEAN, DEFAULT_STDDEV = 0.0, 0.05
#: Treatments in one array.
TREATMENT_BLOCK = 4096


def _n() -> Column:
    return F.count(F.lit(1))


def arm(model_id="model_id") -> Column:
    return F.when(X.col(model_id) == RANDOM_MODEL, "Random").otherwise("Bandit")


def send_flags(sends: DataFrame, interactions: DataFrame) -> DataFrame:
    """Sends with opened/clicked flags and the first time of each."""
    v, c = F.col("type") == "VIEWED", F.col("type") == "CLICKED"
    i = interactions.groupBy("tracking_id").agg(
        F.max(v.cast("int")).alias("opened"), F.max(c.cast("int")).alias("clicked"),
        F.min(F.when(v, F.col("ts"))).alias("first_open"), F.min(F.when(c, F.col("ts"))).alias("first_click"))
    return sends.join(i, "tracking_id", "left").fillna(0, ["opened", "clicked"]).withColumns({
        "arm": arm(), "send_date": F.to_date("sent_ts")})


def _clicks() -> Column:
    return F.count_if((F.col("opened") == 1) & (F.col("clicked") == 1))


def treatment_ctr(flags: DataFrame, start: str, end: str) -> DataFrame:
    """Viewed messages and clicks among them per treatment in the window; treatments with views."""
    rows = flags.where(F.col("send_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    out = rows.groupBy("treatment_id").agg(F.count_if(F.col("opened") == 1).alias("n"), _clicks().alias("clicks"))
    return out.where("n > 0").withColumn("ctr", X.safe_div("clicks", "n"))


def with_beta(ctr: DataFrame, a0: float = 1.0, b0: float = 1.0) -> DataFrame:
    """Beta posterior per treatment."""
    return ctr.withColumns(X.beta_posterior("clicks", "n", a0, b0))


def with_nig(ctr: DataFrame, **prior) -> DataFrame:
    """Normal-inverse-gamma posterior per treatment."""
    return ctr.withColumns(X.nig_posterior("clicks", "n", **prior))


def thompson_assign(users: DataFrame, treatments: DataFrame, posterior: DataFrame, day: int) -> DataFrame:
    """One treatment per user by a posterior draw that depends only on (treatment, user, day).

    The treatment list becomes arrays of about TREATMENT_BLOCK entries, and the best draw of an array is taken inside the row. A
    list of one array rides along as a scalar subquery, so users are neither shuffled nor multiplied. A longer list meets
    each user once per array by an equi-join on the array's number, and the best of these is kept, combined
    map-side. Unknown treatments draw from the default prior.
    """
    t = treatments.select("treatment_id").distinct().join(posterior.select("treatment_id", "mean", "stddev"), "treatment_id", "left").select(
        "treatment_id", F.coalesce("mean", F.lit(DEFAULT_MEAN)).alias("mean"), F.coalesce("stddev", F.lit(DEFAULT_STDDEV)).alias("stddev"))
    number = treatments.agg(F.count_distinct("treatment_id")).first()[0]
    blocks = max(1, -(-number // TREATMENT_BLOCK))

    def draw(e):
        seed = F.concat(e["treatment_id"].cast("string"), F.lit(":"), F.col("user_id").cast("string"), F.lit(f"@{day}"))
        return F.struct((e["mean"] + e["stddev"] * X.hash_normal(seed)).alias("score"), e["treatment_id"].alias("treatment_id"))

    entry = F.struct("treatment_id", "mean", "stddev")
    best = F.array_max(F.transform("_t", draw)).alias("_b")
    if blocks == 1:
        rows = users.select("user_id", t.agg(F.collect_list(entry)).scalar().alias("_t")).select("user_id", best)
    else:
        arrays = t.groupBy(F.pmod(F.xxhash64("treatment_id"), F.lit(blocks)).cast("int").alias("_block")).agg(F.collect_list(entry).alias("_t"))
        each = users.select("user_id").distinct().withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        rows = each.join(arrays, "_block").select("user_id", best).groupBy("user_id").agg(F.max("_b").alias("_b"))
        rows = users.select("user_id").join(rows, "user_id", "left")
    return rows.select("user_id", "_b.treatment_id", "_b.score")


def selection_share(assigned: DataFrame, ctr: DataFrame) -> DataFrame:
    """Share of users per treatment next to its click rate."""
    counts = assigned.groupBy("treatment_id").agg(_n().alias("selected"))
    return share_of_group(counts, [], "selected").join(ctr.select("treatment_id", "n", "clicks", "ctr"), "treatment_id", "left")


def score_drift(flags: DataFrame) -> DataFrame:
    """Daily score statistics per arm. Scores are told apart by their four digits as scaled doubles (x 10,000, half away from zero), as SQL rounds."""
    return flags.groupBy("send_date", "arm").agg(
        _n().alias("sends"), F.avg("score").alias("avg_score"), F.stddev_samp("score").alias("std_score"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.count_distinct(F.round(F.col("score") * 10000)).alias("distinct_scores"))


def top_treatment_scores(flags: DataFrame, n: int = 5) -> DataFrame:
    """Daily average score of the n most sent treatments."""
    top = global_top(flags.groupBy("treatment_id").agg(_n().alias("total")), [F.desc("total"), F.asc("treatment_id")], n)
    return flags.join(top.select("treatment_id"), "treatment_id", "left_semi").groupBy("send_date", "treatment_id").agg(
        _n().alias("sends"), F.avg("score").alias("avg_score"))


def rates_by(flags: DataFrame, *keys) -> DataFrame:
    """Rates per key (week and arm, period and campaign, ...)."""
    rows = flags.groupBy(*keys).agg(_n().alias("sends"), F.sum("opened").alias("opens"), _clicks().alias("clicks"))
    return rows.withColumns({"open_rate": X.pct("opens", "sends"), "ctr_of_opens": X.pct("clicks", "opens"),
                             "ctr_of_sends": X.pct("clicks", "sends")})


def health(flags: DataFrame, since: str) -> DataFrame:
    """Recent daily health per arm: scores and rates."""
    rows = flags.where(F.col("send_date") >= F.lit(since).cast("date")).groupBy("send_date", "arm").agg(
        _n().alias("sends"), F.round(F.avg("score"), 4).alias("avg_score"), F.round(F.stddev_samp("score"), 4).alias("std_score"),
        F.sum("opened").alias("opens"), _clicks().alias("clicks"))
    return rows.withColumns({"open_rate": X.pct("opens", "sends"), "ctr_of_opens": X.pct("clicks", "opens")})


def click_feedback(flags: DataFrame) -> DataFrame:
    """Score of the treatment on its next day against today, with today's clicks."""
    days = flags.groupBy("treatment_id", "send_date").agg(
        _n().alias("sends"), F.avg("score").alias("avg_score"), F.sum("opened").alias("opens"), F.sum("clicked").alias("clicks"))
    nxt = F.lead("avg_score").over(Window.partitionBy("treatment_id").orderBy("send_date"))
    return days.withColumn("next_score", nxt).withColumn("delta", F.col("next_score") - F.col("avg_score"))


def click_direction(flags: DataFrame) -> DataFrame:
    """Score change over the next two days with clicks, and its direction."""
    days = click_feedback(flags).where("clicks > 0").drop("next_score", "delta")
    w = Window.partitionBy("treatment_id").orderBy("send_date")
    rows = days.withColumns({"d1": F.lead("avg_score").over(w), "d2": F.lead("avg_score", 2).over(w)}).where("d1 is not null")
    return rows.withColumns({
        "delta_d1": F.col("d1") - F.col("avg_score"), "delta_d2": F.col("d2") - F.col("avg_score"),
        "direction": F.when(F.col("d1") > F.col("avg_score"), "UP").when(F.col("d1") < F.col("avg_score"), "DOWN").otherwise("FLAT")})


def selection_distribution(flags: DataFrame, least: int = 10) -> DataFrame:
    """Sends per arm and treatment, share of the arm; treatments with enough sends."""
    rows = flags.groupBy("arm", "treatment_id").agg(_n().alias("sends"), F.avg("score").alias("avg_score"))
    return share_of_group(rows, ["arm"], "sends").withColumn("share", F.round(F.col("share") * 100, 2)).where(F.col("sends") >= least)


# ---- fixed values: upper edges and labels of the score histogram ----
HISTOGRAM = ((0.0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0), ("<0", "0-0.01", "0.01-0.02", "0.02-0.05", "0.05-0.1", "0.1-0.2", "0.2-0.5", "0.5-1", ">=1"))


def score_histogram(flags: DataFrame, bins=HISTOGRAM) -> DataFrame:
    """Score buckets per arm with their share of the arm."""
    rows = flags.groupBy("arm", X.bucket("score", *bins).alias("bucket")).agg(_n().alias("sends"))
    return share_of_group(rows, ["arm"], "sends").withColumn("share", F.round(F.col("share") * 100, 2))


def stickiness(flags: DataFrame) -> DataFrame:
    """Users by the arms they were sent from."""
    r = F.count_if(F.col("arm") == "Random")
    per = flags.groupBy("user_id").agg(r.alias("random_sends"), (_n() - r).alias("bandit_sends"), _n().alias("total"))
    seg = (F.when(F.col("bandit_sends") == 0, "Random Only").when(F.col("random_sends") == 0, "Bandit Only").otherwise("Both Arms"))
    return per.groupBy(seg.alias("segment")).agg(
        _n().alias("users"), F.sum("total").alias("sends"), F.round(F.avg("total"), 1).alias("avg_sends"),
        F.sum("random_sends").alias("random_sends"), F.sum("bandit_sends").alias("bandit_sends"))


AUDIT = ("total_sends", "phantom_clicks", "phantom_clicks_bandit", "duplicate_ids", "not_live", "clicks_before_send",
         "opens_before_send", "score_not_positive", "score_above_limit")


def training_audit(flags: DataFrame, limit: float = 1.0) -> DataFrame:
    """Data defects among the sends a model would learn from, one pass.

    Duplicates are rows minus distinct ids; ``flags`` keeps duplicated sends apart.
    """
    live = F.col("source") == "LIVE"
    phantom = (F.col("clicked") == 1) & (F.col("opened") == 0)
    bandit = F.col("arm") == "Bandit"
    row = flags.agg(
        F.count_if(live).alias(AUDIT[0]), F.count_if(live & phantom).alias(AUDIT[1]), F.count_if(live & phantom & bandit).alias(AUDIT[2]),
        (F.count_if(live) - F.count_distinct(F.when(live, F.col("tracking_id")))).alias(AUDIT[3]), F.count_if(~live).alias(AUDIT[4]),
        F.count_if(live & (F.col("first_click") < F.col("sent_ts"))).alias(AUDIT[5]),
        F.count_if(live & (F.col("first_open") < F.col("sent_ts"))).alias(AUDIT[6]),
        F.count_if(live & bandit & (F.col("score") <= 0)).alias(AUDIT[7]), F.count_if(live & bandit & (F.col("score") > limit)).alias(AUDIT[8]))
    return metric_rows(row, AUDIT)


def concentration(flags: DataFrame) -> DataFrame:
    """Per day and arm the treatments used, largest share, sum of squared shares, even share."""
    per = flags.groupBy("send_date", "arm", "treatment_id").agg(_n().alias("sends"))
    return share_of_group(per, ["send_date", "arm"], "sends").groupBy("send_date", "arm").agg(
        _n().alias("treatments"), F.round(F.max("share") * 100, 2).alias("top_share"),
        F.round(F.sum(F.col("share") * F.col("share")), 4).alias("hhi"), F.round(F.lit(1.0) / _n(), 4).alias("uniform"))


def posterior_check(flags: DataFrame, recent_since: str, least: int = 100) -> DataFrame:
    """Expected posterior mean k/(1+n) against the recent average score, with a verdict."""
    s = flags.groupBy("treatment_id").agg(_n().alias("n_sends"), F.sum("clicked").alias("n_clicks")).where(F.col("n_sends") >= least)
    recent = flags.where(F.col("send_date") >= F.lit(recent_since).cast("date")).groupBy("treatment_id").agg(
        F.avg("score").alias("recent_score"), F.stddev_samp("score").alias("recent_std"))
    rows = s.join(recent, "treatment_id", "left").withColumn("expected", F.round(F.col("n_clicks") / (1 + F.col("n_sends")), 6))
    gap = F.abs(F.col("recent_score") - F.col("expected"))
    return rows.withColumns({
        "delta": F.round(F.col("recent_score") - F.col("expected"), 6), "ratio": F.round(X.safe_div("recent_score", "expected"), 2),
        "expected_std": F.round(F.sqrt(1.0 / ((1 + F.col("n_sends")) * (F.col("n_sends") / 2 + 0.5))), 6),
        "verdict": F.when(gap < 0.005, "MATCH").when(gap < 0.01, "CLOSE").when(gap < 0.02, "DIVERGENT").otherwise("MISMATCH")})


def invalid_scores(flags: DataFrame, by: str, limit: float = 1.0) -> DataFrame:
    """Sends with a score above the limit, per day or per treatment."""
    return flags.where(F.col("score") > limit).groupBy(by).agg(
        _n().alias("sends"), F.round(F.avg("score"), 4).alias("avg_score"), F.max("score").alias("max_score"),
        F.min("send_date").alias("first_day"), F.max("send_date").alias("last_day"))


def invalid_history(flags: DataFrame, before: str, limit: float = 1.0) -> DataFrame:
    """What the treatments with invalid scores did before the anomaly, and their volume class."""
    bad = flags.where(F.col("score") > limit).select("treatment_id").distinct()
    rows = flags.where(F.col("send_date") < F.lit(before).cast("date")).join(bad, "treatment_id", "left_semi").groupBy("treatment_id").agg(
        _n().alias("sends"), F.sum("clicked").alias("clicks"), F.sum("opened").alias("opens"))
    return rows.withColumns({"ctr": X.pct("clicks", "sends"), "volume": X.bucket("sends", (50, 200), ("LOW", "MEDIUM", "HIGH"))})


def treatment_volume(flags: DataFrame) -> DataFrame:
    """Volume and rates per treatment, per active day and per week."""
    rows = flags.groupBy("treatment_id").agg(
        _n().alias("sends"), F.sum("opened").alias("opens"), _clicks().alias("clicks"), F.count_distinct("send_date").alias("active_days"))
    return rows.withColumns({
        "ctr": X.pct("clicks", "opens"), "per_day": F.round(X.safe_div("sends", "active_days"), 2),
        "opens_per_week": F.round(X.safe_div("opens", "active_days") * 7, 1)})
