"""Ranking metrics, splits, backtests and comparisons.

Predictions are arrays per user, so a user's list is bounded; actuals are (user_id, item)
rows of any size and are only counted or probed by equi-join, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..functions.asof import asof_join
from ..functions.indexing import disc_quantile, rank_by_hash, rank_in_order
from ..functions.keyed import global_top, top_n_per_key

DAY = 86_400


def _n() -> Column:
    return F.count(F.lit(1))


# ---- ranking metrics -----------------------------------------------------------------
def ranked_items(preds: DataFrame, items: str = "items") -> DataFrame:
    """One row per (user, position from 1, item)."""
    keep = [c for c in preds.columns if c != items]
    return preds.select(*keep, F.posexplode(items).alias("_p", "item")).withColumn("pos", F.col("_p") + 1).drop("_p")


def baseline_list(ranked: DataFrame, k: int) -> DataFrame:
    """The k items per user that metrics look at, in rank order, a repeated item at its first rank."""
    first = ranked.groupBy("user_id", "item").agg(F.min("rank").alias("rank"))
    first = top_n_per_key(first, ["user_id"], [F.asc("rank"), F.asc("item")], k)
    return first.groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "item"))), lambda e: e["item"]).alias("items"))


def _at_most(k: int):
    return lambda p: p <= k


def per_user_metrics(preds: DataFrame, actuals: DataFrame, ks=(5, 10, 20)) -> DataFrame:
    """E01-E06 for each user with predictions and actuals.

    The hit positions of a list are gathered into one short array; every metric is an
    expression over it.
    """
    keys = [c for c in preds.columns if c != "items"]
    acts = actuals.select("user_id", "item").distinct()
    n_act = acts.groupBy("user_id").agg(_n().alias("n_actual"))
    hits = ranked_items(preds).join(acts, ["user_id", "item"], "left_semi").groupBy(*keys).agg(F.sort_array(F.collect_list("pos")).alias("hits"))
    rows = preds.where(F.size("items") > 0).select(*keys).join(n_act, "user_id").join(hits, keys, "left").withColumn(
        "hits", F.coalesce("hits", F.array().cast("array<int>")))
    h, n = F.col("hits"), F.col("n_actual")
    cols = {}
    for k in ks:
        top = F.filter(h, _at_most(k))
        dcg = F.aggregate(top, F.lit(0.0), lambda s, p: s + 1.0 / F.log2(p + F.lit(1.0)))
        ideal = F.aggregate(F.sequence(F.lit(1), F.least(n, F.lit(k)).cast("int")), F.lit(0.0), lambda s, i: s + 1.0 / F.log2(i + F.lit(1.0)))
        cols |= {f"precision_{k}": F.size(top) / F.lit(float(k)), f"recall_{k}": F.size(top) / n,
                 f"ndcg_{k}": dcg / ideal, f"hit_{k}": (F.size(top) > 0).cast("double")}
    cols["mrr"] = F.coalesce(1.0 / F.get(h, F.lit(0)), F.lit(0.0))
    numbered = F.transform(h, lambda p, i: (i + 1) / p.cast("double"))
    cols["map"] = F.aggregate(numbered, F.lit(0.0), lambda s, x: s + x) / n
    return rows.select(*keys, "n_actual", *[c.alias(name) for name, c in cols.items()])


def metric_names(per_user: DataFrame) -> list[str]:
    return [c for c in per_user.columns if c in ("mrr", "map") or c.split("_")[0] in ("precision", "recall", "ndcg", "hit")]


def average_metrics(per_user: DataFrame, keys=()) -> DataFrame:
    """Mean over evaluated users, with their number."""
    return per_user.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in metric_names(per_user)], _n().alias("users"))


def catalog_coverage(preds: DataFrame, catalog_size: Column | int, k: int) -> DataFrame:
    """Distinct items among the first k of all lists over the catalogue size."""
    size = F.lit(catalog_size) if isinstance(catalog_size, int) else catalog_size
    row = ranked_items(preds).where(F.col("pos") <= k).agg(F.count_distinct("item").alias("items"))
    return row.withColumn("coverage", X.safe_div("items", size))


def by_tier_and_list(preds: DataFrame, actuals: DataFrame, tiers: DataFrame, ks=(4,), base: str = "baseline") -> DataFrame:
    """Metrics per tier and list type, with the difference to the baseline list."""
    per = per_user_metrics(preds, actuals, ks).join(tiers.select("user_id", "tier"), "user_id", "left").withColumn("tier", F.coalesce("tier", F.lit("unknown")))
    rows = average_metrics(per, ["tier", "list_type"])
    names = metric_names(per)
    ref = rows.where(F.col("list_type") == base).select("tier", *[F.col(c).alias(f"_{c}") for c in names])
    return rows.join(ref, "tier", "left").withColumns({f"{c}_delta": F.col(c) - F.col(f"_{c}") for c in names}).drop(*[f"_{c}" for c in names])


def bootstrap_interval(per_user: DataFrame, metric: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """95 % interval of a mean by Poisson bootstrap.

    Each user gets an independent Poisson(1) weight per replicate. Users with equal metric values are interchangeable, and a
    sum of c such weights is Poisson(c), so weights are drawn per distinct value, all replicates of it as one vector. A task adds the
    vectors of its values up and hands on one row of n sums, so what is shuffled is n numbers a task, whatever the metric.
    """
    import numpy as np
    import pandas as pd

    groups = per_user.groupBy(F.col(metric).alias("v")).agg(_n().alias("c")).where("v is not null")
    groups = groups.withColumn("s", F.pmod(F.xxhash64("v", F.lit(seed)), F.lit(1 << 31)))

    def draw(batches):
        w, wv = np.zeros(n), np.zeros(n)
        for pdf in batches:
            for v, c, s in zip(pdf["v"], pdf["c"], pdf["s"], strict=True):
                own = np.random.default_rng(s).poisson(c, n)
                w += own
                wv += own * v
        if w.any():
            yield pd.DataFrame({"w": [w], "wv": [wv]})

    sums = groups.select("v", "c", "s").mapInPandas(draw, "w array<double>, wv array<double>")
    means = sums.select(F.posexplode(F.arrays_zip("w", "wv")).alias("r", "e")).groupBy("r").agg((F.sum("e.wv") / F.greatest(F.sum("e.w"), F.lit(1.0))).alias("m"))
    q = F.percentile("m", F.array(F.lit(0.025), F.lit(0.975)))
    return means.agg(q.alias("q")).select(F.lit(metric).alias("metric"), F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def go_no_go(candidate: DataFrame, baseline: DataFrame, metric: str = "hit_4", go: float = 0.03, maybe: float = 0.01, skip: float = -0.01) -> DataFrame:
    """Decision by the difference of one metric between two one-row metric frames."""
    row = candidate.select(F.col(metric).alias("candidate")).withColumn("baseline", baseline.select(metric).scalar())
    d = F.round(F.col("candidate") - F.col("baseline"), 9)
    return row.withColumns({"delta": d, "decision": F.when(d >= go, "GO").when(d >= maybe, "MAYBE").when(d >= skip, "SKIP").otherwise("INVESTIGATE")})


def compare_metrics(baseline: DataFrame, candidate: DataFrame, max_drop: float = 5.0, limits: dict[str, float] | None = None) -> DataFrame:
    """(metric, value) frames joined; percent change, regression beyond the allowed drop, pass flag."""
    rows = baseline.select("metric", F.col("value").alias("baseline")).join(candidate.select("metric", F.col("value").alias("candidate")), "metric")
    b, c = F.col("baseline"), F.col("candidate")
    change = F.when(b == 0, F.when(c == 0, 0.0).otherwise(float("inf"))).otherwise(F.try_divide(c - b, b) * 100)
    limit = F.lit(max_drop)
    for name, value in (limits or {}).items():
        limit = F.when(F.col("metric") == name, value).otherwise(limit)
    return rows.withColumns({"change_percent": change, "limit": limit}).withColumns({
        "regression": F.col("change_percent") < -F.col("limit"), "improvement": F.col("change_percent") > 0})


def verdict(comparison: DataFrame) -> DataFrame:
    """Passed unless a metric regressed."""
    return comparison.agg(F.count_if("regression").alias("regressions"), F.count_if("improvement").alias("improvements")).withColumn(
        "passed", F.col("regressions") == 0)


def auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve by rank sums, ties at their average rank.

    Rows collapse to (score, positives, negatives). Ranks need a running count over the
    distinct scores: these are cut into ranges by value, summed per range, and only the
    running total over the ranges (at most 1000) and the rows inside one range are ordered.
    """
    c = scored.groupBy(F.col(score).cast("double").alias("s")).agg(F.sum(F.col(label).cast("long")).alias("p"), _n().alias("n")).withColumn("q", F.col("n") - F.col("p"))
    cuts = c.agg(F.percentile_approx("s", [i / 1000 for i in range(1, 1000)], 10000)).scalar()
    c = c.withColumn("_cuts", cuts).withColumn("b", F.size(F.filter("_cuts", lambda x: x < F.col("s")))).drop("_cuts")
    per = c.groupBy("b").agg(F.sum("q").alias("bq"))
    per = per.select("b", (F.sum("bq").over(Window.orderBy("b")) - F.col("bq")).alias("before"))
    inside = F.sum("q").over(Window.partitionBy("b").orderBy("s")) - F.col("q")
    rows = c.withColumn("inside", inside).join(per, "b")
    wins = F.sum(F.col("p") * (F.col("before") + F.col("inside") + F.col("q") / 2.0))
    return rows.agg(wins.alias("w"), F.sum("p").alias("pos"), F.sum("q").alias("neg")).select(
        F.try_divide(F.col("w"), F.col("pos") * F.col("neg")).alias("auc"), "pos", "neg")


# ---- splits ----------------------------------------------------------------------------
def time_split(df: DataFrame, ts: str, ratio: float = 0.8, cutoff: str | None = None):
    """Train before the cutoff, test from it; the cutoff is a date or a time quantile."""
    if cutoff is not None:
        cut = F.lit(cutoff).cast(df.schema[ts].dataType)
    else:
        cut = disc_quantile(df, [], ts, ratio, "_cut").agg(F.max("_cut")).scalar()
    marked = df.withColumn("_cut", cut)
    return marked.where(F.col(ts) < F.col("_cut")).drop("_cut"), marked.where(F.col(ts) >= F.col("_cut")).drop("_cut")


def user_split(df: DataFrame, ratio: float = 0.8, seed: int = 42, user: str = "user_id") -> DataFrame:
    """Whole users to train or test, int(n * ratio) of them to train; adds ``split``."""
    users = rank_by_hash(df.select(user).distinct(), [], [user], seed)
    side = F.when(F.col("pos") < F.floor(F.col("pos_n") * F.lit(ratio)), "train").otherwise("test")
    return df.join(users.select(user, side.alias("split")), user)


def leave_one_out(df: DataFrame, ts: str, row_id: str, user: str = "user_id") -> DataFrame:
    """The last row of each user is test, the others train; adds ``split``."""
    last = df.groupBy(user).agg(F.max_by(row_id, F.struct(ts, row_id)).alias(row_id)).withColumn("_l", F.lit(True))
    return df.join(last, [user, row_id], "left").withColumn("split", F.when(F.col("_l"), "test").otherwise("train")).drop("_l")


# ---- backtests -------------------------------------------------------------------------
def window_purchases(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct (user, sku, day) of the window, variant-normalised."""
    d = F.col("order_date")
    return orders.where(d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(
        "user_id", X.normalize_variant("sku").alias("sku"), "order_date").distinct()


def match_recs(recs: DataFrame, purchases: DataFrame) -> DataFrame:
    """Recommended rows (user, slot, sku) the user then bought."""
    bought = purchases.select("user_id", "sku").distinct()
    return recs.join(bought, ["user_id", "sku"], "left_semi")


def version_row(recs: DataFrame, purchases: DataFrame, name: str) -> DataFrame:
    """Users with recs, buyers among them, matched users and match rates of one version."""
    u = recs.groupBy("user_id").agg(F.lit(1).alias("r"))
    b = purchases.groupBy("user_id").agg(F.lit(1).alias("b"))
    m = match_recs(recs, purchases).groupBy("user_id").agg(F.lit(1).alias("m"))
    row = u.join(b, "user_id", "left").join(m, "user_id", "left").agg(
        F.lit(name).alias("version"), F.sum("r").alias("users"), F.coalesce(F.sum("b"), F.lit(0)).alias("buyers"), F.coalesce(F.sum("m"), F.lit(0)).alias("matched"))
    return row.withColumns({"rate_of_users": X.pct("matched", "users", 4), "rate_of_buyers": X.pct("matched", "buyers", 4)})


def compare_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both versions and the improvement of the match rate over the first."""
    base = old.select("rate_of_users").scalar()
    rows = old.unionByName(new)
    return rows.withColumn("improvement", F.round(F.try_divide(F.col("rate_of_users") - base, base) * 100, 2))


def slot_distribution(matches: DataFrame) -> DataFrame:
    """Matches per slot."""
    return matches.groupBy("slot").agg(_n().alias("matches"), F.count_distinct("user_id").alias("users"))


def slot_diversity(recs: DataFrame, slot: int = 1) -> DataFrame:
    """Distinct skus in one slot."""
    return recs.where(F.col("slot") == slot).agg(F.count_distinct("sku").alias("skus"), _n().alias("users"))


def signal_coverage(recs: DataFrame, table: DataFrame, keys) -> DataFrame:
    """Recommended rows that a score table knows."""
    hit = table.select(*keys).distinct().withColumn("_h", F.lit(1))
    row = recs.join(hit, list(keys), "left").agg(_n().alias("recs"), F.count("_h").alias("with_score"))
    return row.withColumn("pct", X.pct("with_score", "recs"))


def purchase_classes(purchases: DataFrame, fitment: DataFrame, universal: DataFrame) -> DataFrame:
    """Purchases of fitment skus, pool skus and the long tail, with shares."""
    f = fitment.select("sku").distinct().withColumn("_f", F.lit(True))
    u = universal.select("sku").distinct().withColumn("_u", F.lit(True))
    kind = F.when(F.col("_f"), "fitment").when(F.col("_u"), "universal").otherwise("long_tail")
    rows = purchases.join(f, "sku", "left").join(u, "sku", "left")
    out = rows.groupBy(kind.alias("kind")).agg(_n().alias("purchases"), F.count_distinct("sku").alias("skus"))
    return out.withColumn("share", F.round(F.col("purchases") / purchases.agg(_n()).scalar() * 100, 2))


def _per_cutoff(orders: DataFrame, cutoffs: DataFrame, history_days: int, horizon_days: int) -> DataFrame:
    """Order rows with each cutoff they serve, as history (gap <= 0) or as holdout (gap > 0).

    The cutoffs are one bounded array of parameters, filtered by date inside the row, so an order is
    only repeated for the periods it belongs to.
    """
    arr = cutoffs.agg(F.sort_array(F.collect_set(F.col("cutoff").cast("date")))).scalar()
    gap = F.datediff("order_date", "cutoff")
    rows = orders.select("user_id", X.normalize_variant("sku").alias("sku"), "order_date").withColumn("_c", arr)
    served = F.filter("_c", lambda c: F.datediff("order_date", c).between(1 - history_days, horizon_days))
    return rows.withColumn("cutoff", F.explode(served)).withColumn("gap", gap).drop("_c")


def rolling_backtest(orders: DataFrame, cutoffs: DataFrame, top: int = 10, history_days: int = 365, horizon_days: int = 21) -> DataFrame:
    """Per cutoff, popularity of the days before it judged by the purchases after it.

    All periods share one scan and every later step is keyed by cutoff.
    """
    rows = _per_cutoff(orders, cutoffs, history_days, horizon_days)
    hist = rows.where("gap <= 0").groupBy("cutoff", "sku").agg(_n().alias("orders"))
    best = top_n_per_key(hist, ["cutoff"], [F.desc("orders"), F.asc("sku")], top).select("cutoff", "sku").withColumn("_m", F.lit(1))
    held = rows.where("gap > 0").select("cutoff", "user_id", "sku").distinct().join(best, ["cutoff", "sku"], "left")
    per = held.groupBy("cutoff", "user_id").agg(F.max("_m").alias("m"), _n().alias("n"), F.count("_m").alias("k"))
    out = per.groupBy("cutoff").agg(_n().alias("buyers"), F.count("m").alias("matched"), F.sum("n").alias("purchases"), F.sum("k").alias("hits"))
    return out.withColumn("match_rate", X.pct("matched", "buyers"))


def rolling_versions(orders: DataFrame, users: DataFrame, cutoffs: DataFrame, segment, top: int = 4, history_days: int = 365, horizon_days: int = 21) -> DataFrame:
    """Per cutoff, match rates of two recommenders built from the days before it.

    ``segment`` recommends the best products of the user's segment that the user has not bought before the
    cutoff, ``global`` the best of all. A user's purchases can push the list down by as many places, so the lists keep
    ``top`` plus the user's purchases; a recommendation counts by its rank among the products left.
    """
    segment = list(segment)
    rows = _per_cutoff(orders, cutoffs, history_days, horizon_days).join(users.select("user_id", *segment), "user_id")
    hist, held = rows.where("gap <= 0"), rows.where("gap > 0").select("cutoff", "user_id", *segment, "sku").distinct()
    bought = hist.join(held.select("cutoff", "user_id").distinct(), ["cutoff", "user_id"], "left_semi").select("cutoff", "user_id", *segment, "sku").distinct()
    out = None
    for version, keys in (("segment", ["cutoff", *segment]), ("global", ["cutoff"])):
        counts = hist.groupBy(*keys, "sku").agg(_n().alias("orders"))
        ranks = rank_in_order(counts, keys, [F.desc("orders"), F.asc("sku")]).select(*keys, "sku", "rank")
        # Rank of a purchase among the products left: its rank less the user's earlier products before it.
        mine = bought.join(ranks, [*keys, "sku"]).select("cutoff", "user_id", F.col("rank").alias("_b"))
        hit = held.join(bought, ["cutoff", "user_id", "sku"], "left_anti").join(ranks, [*keys, "sku"])
        before = hit.join(mine, ["cutoff", "user_id"], "left").groupBy("cutoff", "user_id", "sku", "rank").agg(F.count_if(F.col("_b") < F.col("rank")).alias("_before"))
        matched = before.where(F.col("rank") - F.col("_before") <= top).groupBy("cutoff", "user_id").agg(_n().alias("k"))
        per = held.groupBy("cutoff", "user_id").agg(_n().alias("n")).join(matched, ["cutoff", "user_id"], "left")
        part = per.groupBy("cutoff").agg(_n().alias("buyers"), F.count("k").alias("matched"), F.coalesce(F.sum("k"), F.lit(0)).alias("hits"))
        part = part.select("cutoff", F.lit(version).alias("version"), "buyers", "matched", "hits", X.pct("matched", "buyers").alias("match_rate"))
        out = part if out is None else out.unionByName(part)
    return out


BANDS = ((50, "top50"), (100, "51_100"), (200, "101_200"), (500, "201_500"))


def popularity_bands(purchases: DataFrame, popularity: DataFrame, bands=BANDS) -> DataFrame:
    """Purchases by the global popularity rank of their sku."""
    top = global_top(popularity.select("sku", "total_orders"), [F.desc("total_orders"), F.asc("sku")], bands[-1][0]).select("sku", "rank")
    label = None
    for edge, name in bands:
        c = F.col("rank") <= edge
        label = F.when(c, name) if label is None else label.when(c, name)
    counts = purchases.groupBy("sku").agg(_n().alias("n")).join(top, "sku", "left")
    rows = counts.groupBy(label.otherwise("beyond").alias("band")).agg(F.sum("n").alias("purchases"))
    return rows.withColumn("share", F.round(F.col("purchases") / purchases.agg(_n()).scalar() * 100, 1))


def buyer_coverage(buyers: DataFrame, at_cutoff: DataFrame, now: DataFrame) -> DataFrame:
    """Buyers that had the attribute at the cutoff and that have it now."""
    a = at_cutoff.select("user_id").distinct().withColumn("_a", F.lit(1))
    b = now.select("user_id").distinct().withColumn("_b", F.lit(1))
    row = buyers.select("user_id").distinct().join(a, "user_id", "left").join(b, "user_id", "left").agg(
        _n().alias("buyers"), F.count("_a").alias("at_cutoff"), F.count("_b").alias("now"))
    return row.withColumns({"pct_at_cutoff": X.pct("at_cutoff", "buyers", 1), "pct_now": X.pct("now", "buyers", 1)})


def category_alignment(purchases: DataFrame, primary: DataFrame, catalog: DataFrame) -> DataFrame:
    """Purchases inside the user's primary category."""
    cat = catalog.groupBy("sku").agg(F.max("category").alias("category"))
    rows = purchases.join(primary.select("user_id", "primary_category"), "user_id").join(cat, "sku")
    return rows.agg(_n().alias("purchases"), F.count_if(F.col("category") == F.col("primary_category")).alias("aligned")).withColumn(
        "pct", X.pct("aligned", "purchases"))


def sku_concentration(recs: DataFrame, name: str) -> DataFrame:
    """Distinct skus of a version and the share of its most shown sku."""
    c = recs.groupBy("sku").agg(_n().alias("n"))
    return c.agg(F.lit(name).alias("version"), _n().alias("skus"), F.max("n").alias("top"), F.sum("n").alias("recs")).withColumn("top_share", X.pct("top", "recs"))


def median_breadth(recs: DataFrame, breadth: DataFrame) -> DataFrame:
    """Median number of vehicles of the recommended skus."""
    return recs.join(breadth, "sku").agg(F.percentile_approx("breadth", 0.5, 10000).alias("median_breadth"), F.round(F.avg("breadth"), 2).alias("avg_breadth"))


def score_quartiles(scores: DataFrame) -> DataFrame:
    """Score distribution per pool."""
    q = F.percentile_approx("score", [0.25, 0.5, 0.75], 10000)
    return scores.groupBy("pool").agg(_n().alias("n"), F.min("score").alias("min_score"), F.avg("score").alias("avg_score"), F.max("score").alias("max_score"),
                                      q.alias("_q")).select("pool", "n", "min_score", "avg_score", "max_score", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q2"), F.col("_q")[2].alias("q3"))


def signal_rates(purchases: DataFrame, signals: DataFrame, windows=(7, 14, 30, 60, 90), kinds=("view", "cart")) -> DataFrame:
    """Share of purchases with an earlier signal of the same (user, sku), per lookback window.

    One as-of join per kind finds the nearest earlier signal; every window is a test on that
    gap. ``purchases``: user_id, sku, order_id, order_ts; ``signals``: user_id, sku, kind, ts, signal_id.
    """
    far = max(windows) * DAY
    out = purchases.select("user_id", "sku", "order_id", "order_ts")
    for k in kinds:
        s = signals.where(F.col("kind") == k).select("user_id", "sku", F.col("ts").alias(f"ts_{k}"), F.col("signal_id").alias(f"id_{k}"))
        out = asof_join(out, s, ["user_id", "sku"], "order_ts", f"ts_{k}", f"id_{k}", far, bucket_seconds=DAY, how="left").drop(f"id_{k}")

    rows = out.withColumn("w", F.explode(F.array(*[F.lit(w) for w in windows])))
    flags = {k: F.coalesce(F.unix_micros("order_ts") - F.unix_micros(f"ts_{k}") <= F.col("w") * (DAY * 1_000_000), F.lit(False)) for k in kinds}
    any_ = None
    for f in flags.values():
        any_ = f if any_ is None else any_ | f
    agg = rows.groupBy(F.col("w").alias("days")).agg(_n().alias("purchases"), *[F.count_if(f).alias(f"with_{k}") for k, f in flags.items()], F.count_if(any_).alias("with_any"))
    return agg.withColumns({f"pct_{k}": X.pct(f"with_{k}", "purchases") for k in (*kinds, "any")})


def vehicle_relation(purchases: DataFrame, users: DataFrame, fitment: DataFrame, on: dict[str, str]) -> DataFrame:
    """Purchases by relation to the user's vehicle: registered, other vehicle, universal."""
    mine = [m for m, t in on.items() if t != "sku"]
    fit = fitment.select(*[F.col(t).alias(m) for m, t in on.items()]).distinct().withColumn("_own", F.lit(True))
    some = fitment.select("sku").distinct().withColumn("_any", F.lit(True))
    rows = purchases.join(users.select("user_id", *mine), "user_id").join(fit, list(on), "left").join(some, "sku", "left")
    kind = F.when(F.col("_own"), "registered").when(F.col("_any"), "other_vehicle").otherwise("universal")
    out = rows.groupBy(kind.alias("relation")).agg(_n().alias("purchases"), F.count_distinct("user_id").alias("users"))
    return out.withColumn("share", F.round(F.col("purchases") / rows.agg(_n()).scalar() * 100, 2))


def run_diff(old: DataFrame, new: DataFrame, slots: int = 4) -> DataFrame:
    """Users in both runs, dropped, new; identical rows and changed slots of the users in both."""
    a = old.select("user_id", *[F.col(f"rec{i}_sku").alias(f"a{i}") for i in range(1, slots + 1)], F.lit(True).alias("_a"))
    b = new.select("user_id", *[F.col(f"rec{i}_sku").alias(f"b{i}") for i in range(1, slots + 1)], F.lit(True).alias("_b"))
    rows = a.join(b, "user_id", "full")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    changed = [~F.col(f"a{i}").eqNullSafe(F.col(f"b{i}")) for i in range(1, slots + 1)]
    any_ = changed[0]
    for c in changed[1:]:
        any_ = any_ | c
    same_set = F.array_sort(F.array(*[f"a{i}" for i in range(1, slots + 1)])) == F.array_sort(F.array(*[f"b{i}" for i in range(1, slots + 1)]))
    return rows.agg(F.count_if(both).alias("in_both"), F.count_if(F.col("_b").isNull()).alias("dropped"), F.count_if(F.col("_a").isNull()).alias("added"),
                    F.count_if(both & ~any_).alias("identical"), F.count_if(both & F.coalesce(same_set, F.lit(False))).alias("same_set"),
                    *[F.count_if(both & c).alias(f"changed_{i}") for i, c in enumerate(changed, 1)])


def price_shift(old: DataFrame, new: DataFrame, edges, labels) -> DataFrame:
    """Recommended rows per price bucket in both runs."""
    def counts(df, name):
        return df.groupBy(X.bucket("price", edges, labels).alias("bucket")).agg(_n().alias(name))

    return counts(old, "old").join(counts(new, "new"), "bucket", "full").fillna(0, ["old", "new"]).withColumn("shift", F.col("new") - F.col("old"))


def match_types(matches: DataFrame, purchase_kind: DataFrame) -> DataFrame:
    """Matches by recommended type and purchased type."""
    rows = matches.join(purchase_kind.select("sku", "purchased_type").distinct(), "sku", "left")
    return rows.groupBy("product_type", F.coalesce("purchased_type", F.lit("long_tail")).alias("purchased_type")).agg(_n().alias("matches"))


def one_category_users(recs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Users whose recommendations share one category."""
    cat = catalog.groupBy("sku").agg(F.max("category").alias("category"))
    per = recs.join(cat, "sku").groupBy("user_id").agg(F.min("category").alias("lo"), F.max("category").alias("hi"), _n().alias("n"))
    return per.agg(_n().alias("users"), F.count_if((F.col("lo") == F.col("hi")) & (F.col("n") > 1)).alias("one_category")).withColumn("pct", X.pct("one_category", "users"))


def price_tiers(purchases: DataFrame, prices: DataFrame, edges, labels) -> DataFrame:
    """Purchases and skus per price tier."""
    rows = purchases.join(prices.groupBy("sku").agg(F.max("price").alias("price")), "sku")
    return rows.groupBy(X.bucket("price", edges, labels).alias("tier")).agg(_n().alias("purchases"), F.count_distinct("sku").alias("skus"))


def new_skus_in_band(old: DataFrame, new: DataFrame, low: float, high: float) -> DataFrame:
    """Skus of the new run inside a price band that the old run never showed."""
    rows = new.where(F.col("price").between(low, high)).select("sku").distinct().join(old.select("sku").distinct(), "sku", "left_anti")
    return rows.agg(_n().alias("new_skus"))
