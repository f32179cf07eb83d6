"""Funnels, rates, uplift and revenue attribution of campaign sends.

Inputs: ``sends`` (tracking_id, user_id, treatment_id, sent_ts, arm_id, treatment_type,
period, ...), ``interactions`` (tracking_id, user_id, treatment_id, type, ts), ``orders``
(user_id, order_id, order_ts, order_value), ``deliveries`` (user_id, status, ...).

Interactions and orders are reduced per join key before they meet the sends, so no join
multiplies rows and one busy user or message costs no more than its combined rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.indexing import disc_quantile
from ..functions.asof import asof_join
from ..functions.keyed import metric_rows, top_n_per_key

DAY = 86_400
VIEWED, CLICKED = "VIEWED", "CLICKED"
PERSONAL, STATIC = "Personalized", "Static"


def _n() -> Column:
    return F.count(F.lit(1))


def _is(kind: str) -> Column:
    return F.col("type") == kind


def _both() -> Column:
    return (F.col("opened") == 1) & (F.col("clicked") == 1)


def _flag(c: Column) -> Column:
    return F.coalesce(F.max(c.cast("int")), F.lit(0))


# ---- base table -------------------------------------------------------------------
def eligible_users(attrs: DataFrame, bag: str = "props") -> DataFrame:
    """Users with a value for year, make and model."""
    p = F.col("p")
    rows = attrs.select("user_id", F.explode(bag).alias("p")).withColumn("name", F.lower("p.property_name"))
    has = F.nullif(F.trim(p["string_value"]), F.lit("")).isNotNull() | p["long_value"].isNotNull()
    return rows.where(F.col("name").isin("v1_year", "v1_make", "v1_model") & has).groupBy("user_id").agg(
        F.count_distinct("name").alias("n")).where("n = 3").select("user_id")


def interaction_flags(interactions: DataFrame) -> DataFrame:
    """Opened and clicked per message, one row each."""
    return interactions.groupBy("tracking_id").agg(_flag(_is(VIEWED)).alias("opened"), _flag(_is(CLICKED)).alias("clicked"))


def uplift_base(sends: DataFrame, interactions: DataFrame, eligible: DataFrame, crash_date: str, source: str = "LIVE") -> DataFrame:
    """One row per live send with type, period, eligibility and opened/clicked flags."""
    rows = sends.where(F.col("source") == source).join(
        eligible.select("user_id").distinct().withColumn("_e", F.lit(True)), "user_id", "left")
    rows = rows.join(interaction_flags(interactions), "tracking_id", "left")
    return rows.withColumns({
        "send_date": F.to_date("sent_ts"), "in_crash": F.to_date("sent_ts") >= F.lit(crash_date).cast("date"),
        "eligible": F.coalesce("_e", F.lit(False)), "opened": F.coalesce("opened", F.lit(0)),
        "clicked": F.coalesce("clicked", F.lit(0))}).drop("_e")


def rate_aggs() -> list[Column]:
    """C17: sends, users, opens, clicks among opens."""
    return [_n().alias("sends"), F.count_distinct("user_id").alias("users"), F.sum("opened").alias("opens"),
            F.sum(_both().cast("int")).alias("clicks")]


def with_rates(df: DataFrame, digits: int = 2) -> DataFrame:
    """C17: open rate, click rate of opens, click rate of sends, in percent."""
    return df.withColumns({
        "open_rate": X.pct("opens", "sends", digits), "ctr_of_opens": X.pct("clicks", "opens", digits),
        "ctr_of_sends": X.pct("clicks", "sends", digits)})


def rates(base: DataFrame, keys, least: int = 0) -> DataFrame:
    """The rates block per key, keys with at least ``least`` sends."""
    return with_rates(base.groupBy(*keys).agg(*rate_aggs()).where(F.col("sends") >= least))


def rates_with_interval(base: DataFrame, keys) -> DataFrame:
    """Click rate of opens with its Wilson interval."""
    r = rates(base, keys)
    return r.withColumns({"ci_low": X.wilson("clicks", "opens", False), "ci_high": X.wilson("clicks", "opens", True)})


def _per_user_types(base: DataFrame, keys) -> DataFrame:
    p, s = F.col("treatment_type") == PERSONAL, F.col("treatment_type") == STATIC
    aggs = []
    for tag, cond in (("p", p), ("s", s)):
        aggs += [F.sum(cond.cast("int")).alias(f"{tag}_sends"), F.sum((cond & (F.col("opened") == 1)).cast("int")).alias(f"{tag}_opens"),
                 F.sum((cond & _both()).cast("int")).alias(f"{tag}_clicks"),
                 _flag(cond & (F.col("clicked") == 1)).alias(f"{tag}_clicked")]
    return base.groupBy("user_id", *keys).agg(*aggs).where("p_sends > 0 and s_sends > 0")


def paired_comparison(base: DataFrame, keys=("period",)) -> DataFrame:
    """Users who got both types; pooled rates of each type and the difference."""
    names = [f"{t}_{m}" for t in "ps" for m in ("sends", "opens", "clicks")]
    rows = _per_user_types(base, keys).groupBy(*keys).agg(_n().alias("overlap_users"), *[F.sum(c).alias(c) for c in names])
    for t in "ps":
        rows = rows.withColumns({f"{t}_open_rate": X.pct(f"{t}_opens", f"{t}_sends"), f"{t}_ctr": X.pct(f"{t}_clicks", f"{t}_opens")})
    delta = X.safe_div("p_clicks", "p_opens") * 100 - X.safe_div("s_clicks", "s_opens") * 100
    return rows.withColumn("ctr_delta", F.round(delta, 2))


def at_least_once(base: DataFrame, keys=()) -> DataFrame:
    """C20: among users with both types, who clicked each at least once."""
    p, s = F.col("p_clicked") == 1, F.col("s_clicked") == 1
    rows = _per_user_types(base, keys).groupBy(*keys).agg(
        _n().alias("overlap_users"), F.sum("p_clicked").alias("clicked_p"), F.sum("s_clicked").alias("clicked_s"),
        F.count_if(p & s).alias("clicked_both"), F.count_if(~p & ~s).alias("clicked_neither"))
    delta = (X.safe_div("clicked_p", "overlap_users") - X.safe_div("clicked_s", "overlap_users")) * 100
    return rows.withColumns({"pct_p": X.pct("clicked_p", "overlap_users"), "pct_s": X.pct("clicked_s", "overlap_users"),
                             "delta_pp": F.round(delta, 2)})


def period_change(base: DataFrame, before: str, after: str) -> DataFrame:
    """Rates of both periods side by side per type, absolute and relative change."""
    rows = _raw_rates(base.where("eligible"), ["treatment_type", "period"])
    cols = []
    for m in ("open", "ctr", "ctr_sends"):
        a = F.max(F.when(F.col("period") == before, F.col(m)))
        b = F.max(F.when(F.col("period") == after, F.col(m)))
        cols += [F.round(a * 100, 2).alias(f"{m}_before"), F.round(b * 100, 2).alias(f"{m}_after"),
                 F.round((b - a) * 100, 2).alias(f"{m}_change"), F.round(F.try_divide(b - a, a) * 100, 1).alias(f"{m}_relative")]
    return rows.groupBy("treatment_type").agg(*cols)


def _raw_rates(base: DataFrame, keys) -> DataFrame:
    r = base.groupBy(*keys).agg(*rate_aggs())
    return r.select(*keys, X.safe_div("opens", "sends").alias("open"), X.safe_div("clicks", "opens").alias("ctr"),
                    X.safe_div("clicks", "sends").alias("ctr_sends"))


def diff_in_diff(base: DataFrame, before: str, after: str) -> DataFrame:
    """Change of the personalised rate minus change of the static rate, one row."""
    rows = _raw_rates(base.where("eligible"), ["treatment_type", "period"])

    def cell(m, kind, period):
        return F.max(F.when((F.col("treatment_type") == kind) & (F.col("period") == period), F.col(m)))

    return rows.agg(*[
        F.round(((cell(m, PERSONAL, after) - cell(m, PERSONAL, before)) - (cell(m, STATIC, after) - cell(m, STATIC, before))) * 100, 2)
        .alias(f"{m}_did") for m in ("open", "ctr", "ctr_sends")])


def same_user_periods(base: DataFrame, kind: str = PERSONAL, periods: int = 2) -> DataFrame:
    """Rates per period of the users who got the type in every period."""
    per = base.where(F.col("treatment_type") == kind).groupBy("user_id", "period").agg(
        _n().alias("sends"), F.sum("opened").alias("opens"), F.sum(_both().cast("int")).alias("clicks"))
    both = per.groupBy("user_id").agg(_n().alias("_k")).where(F.col("_k") == periods)
    rows = per.join(both.select("user_id"), "user_id", "left_semi").groupBy("period").agg(
        _n().alias("users"), *[F.sum(c).alias(c) for c in ("sends", "opens", "clicks")])
    return with_rates(rows).drop("ctr_of_sends")


def winner_per_period(base: DataFrame) -> DataFrame:
    """Rates of both types per period and which one clicks better."""
    rows = _raw_rates(base.where("eligible"), ["period", "treatment_type"])

    def cell(m, kind):
        return F.max(F.when(F.col("treatment_type") == kind, F.col(m)))

    return rows.groupBy("period").agg(
        F.round(cell("open", PERSONAL) * 100, 2).alias("p_open_rate"), F.round(cell("ctr", PERSONAL) * 100, 2).alias("p_ctr"),
        F.round(cell("open", STATIC) * 100, 2).alias("s_open_rate"), F.round(cell("ctr", STATIC) * 100, 2).alias("s_ctr"),
        F.when(cell("ctr", PERSONAL) > cell("ctr", STATIC), PERSONAL).otherwise(STATIC).alias("winner"))


# ---- revenue ----------------------------------------------------------------------
def dedupe_orders(orders: DataFrame) -> DataFrame:
    """One order per (user, day, amount), at its first time."""
    return orders.groupBy("user_id", F.to_date("order_ts").alias("order_date"), "order_value").agg(F.min("order_ts").alias("order_ts"))


def overlap_users(base: DataFrame) -> DataFrame:
    """Users who received more than one treatment type."""
    return base.groupBy("user_id").agg(F.count_distinct("treatment_type").alias("k")).where("k > 1").select("user_id")


def attributed_orders(base: DataFrame, orders: DataFrame, days: int = 30) -> DataFrame:
    """Each deduplicated order credited to the last send before it, within ``days``."""
    clean = base.where("eligible").join(overlap_users(base.where("eligible")), "user_id", "left_anti")
    right = clean.select("user_id", "sent_ts", "tracking_id", "treatment_type", "period")
    return asof_join(dedupe_orders(orders), right, ["user_id"], "order_ts", "sent_ts", "tracking_id", days * DAY)


def revenue_attribution(base: DataFrame, orders: DataFrame, short: int = 7, long: int = 30) -> DataFrame:
    """Buyers and revenue per type and period within both windows, per user sent."""
    clean = base.where("eligible").join(overlap_users(base.where("eligible")), "user_id", "left_anti")
    sent = clean.groupBy("treatment_type", "period").agg(F.count_distinct("user_id").alias("users_sent"))
    rows = attributed_orders(base, orders, long)
    near = F.col("order_ts") <= F.col("sent_ts") + F.expr(f"INTERVAL {short} DAYS")
    rev = rows.groupBy("treatment_type", "period").agg(
        F.count_distinct(F.when(near, F.col("user_id"))).alias("buyers_short"), F.sum(F.when(near, F.col("order_value"))).alias("revenue_short"),
        F.count_distinct("user_id").alias("buyers_long"), F.sum("order_value").alias("revenue_long"))
    out = sent.join(rev, ["treatment_type", "period"], "left")
    cols = {}
    for w in ("short", "long"):
        b, r = F.coalesce(f"buyers_{w}", F.lit(0)), F.coalesce(F.col(f"revenue_{w}").cast("double"), F.lit(0.0))
        cols |= {f"buyers_{w}": b, f"revenue_{w}": F.round(r, 2), f"conversion_{w}": X.pct(b, "users_sent"),
                 f"per_user_{w}": F.round(X.safe_div(r, "users_sent"), 2)}
    return out.withColumns(cols)


def overlap_diagnostics(base: DataFrame) -> DataFrame:
    """Users per period, those with both types, and the rest."""
    el = base.where("eligible")
    rows = el.select("user_id", "period").distinct().join(overlap_users(el).withColumn("_o", F.lit(1)), "user_id", "left")
    return rows.groupBy("period").agg(_n().alias("total_users"), F.count("_o").alias("overlap_users")).withColumn(
        "clean_users", F.col("total_users") - F.col("overlap_users"))


def dedupe_diagnostics(orders: DataFrame) -> DataFrame:
    """Order events before and after the dedupe, as metric rows."""
    key = orders.groupBy("user_id", F.to_date("order_ts"), "order_value").agg(_n().alias("n"))
    row = key.agg(F.sum("n").alias("raw"), _n().alias("deduped")).withColumn("removed", F.col("raw") - F.col("deduped"))
    return metric_rows(row, ["raw", "deduped", "removed"])


def click_without_open(base: DataFrame) -> DataFrame:
    """Clicks with and without open; click rate before and after the correction."""
    rows = base.where("eligible").groupBy("treatment_type", "period").agg(
        _n().alias("sends"), F.sum("clicked").alias("clicks"), F.count_if((F.col("opened") == 0) & (F.col("clicked") == 1)).alias("no_open"),
        F.count_if(_both()).alias("with_open"), F.sum("opened").alias("opens"))
    return rows.withColumns({"old_ctr": X.pct("clicks", "opens"), "corrected_ctr": X.pct("with_open", "opens")})


def binary_user_rates(base: DataFrame, keys=("period", "treatment_type")) -> DataFrame:
    """Share of users who opened and clicked at least once; sends per user."""
    rows = base.groupBy(*keys).agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct(F.when(F.col("opened") == 1, F.col("user_id"))).alias("openers"),
        F.count_distinct(F.when(_both(), F.col("user_id"))).alias("clickers"), _n().alias("sends"))
    return rows.withColumns({"pct_opened": X.pct("openers", "users"), "pct_clicked": X.pct("clickers", "users"),
                             "sends_per_user": F.round(X.safe_div("sends", "users"), 2)})


def first_send_only(base: DataFrame) -> DataFrame:
    """Rates over the first send of each (user, type, period)."""
    first = top_n_per_key(base, ["user_id", "treatment_type", "period"], [F.asc("sent_ts"), F.asc("tracking_id")], 1)
    return rates(first, ["treatment_type", "period"])


RANK_LABELS = ("1st", "2nd", "3rd", "4th-5th", "6th+")


def fatigue(base: DataFrame, depth: int = 5) -> DataFrame:
    """Rates by the position of the send for the user and type.

    Only positions up to ``depth`` are told apart, so the ranking keeps ``depth`` rows per
    (user, type); everything later is the total minus those rows.
    """
    keys = ["user_id", "treatment_type"]
    head = top_n_per_key(base, keys, [F.asc("sent_ts"), F.asc("tracking_id")], depth, "pos")
    label = X.bucket("pos", (2, 3, 4), (*RANK_LABELS[:3], RANK_LABELS[3]))
    sums = [_n().alias("sends"), F.sum("opened").alias("opens"), F.sum(_both().cast("int")).alias("clicks")]
    near = head.groupBy("treatment_type", label.alias("bucket")).agg(*sums)
    total = base.groupBy("treatment_type").agg(*sums)
    part = near.groupBy("treatment_type").agg(*[F.sum(c).alias(f"_{c}") for c in ("sends", "opens", "clicks")])
    late = total.join(part, "treatment_type").select(
        "treatment_type", F.lit(RANK_LABELS[4]).alias("bucket"),
        *[(F.col(c) - F.col(f"_{c}")).alias(c) for c in ("sends", "opens", "clicks")]).where("sends > 0")
    return with_rates(near.unionByName(late))


def campaign_overlap(base: DataFrame, keys=("campaign",)) -> DataFrame:
    """Rates of users who got both types within a campaign."""
    both = _per_user_types(base, keys).select("user_id", *keys)
    rows = base.join(both, ["user_id", *keys], "left_semi").groupBy(*keys, "treatment_type").agg(
        *rate_aggs(), F.count_distinct(F.when(F.col("clicked") == 1, F.col("user_id"))).alias("clickers"),
        F.count_distinct(F.when(F.col("opened") == 1, F.col("user_id"))).alias("openers"))
    return with_rates(rows).withColumns({"pct_clicked": X.pct("clickers", "users"), "pct_opened": X.pct("openers", "users")})


def user_preference(base: DataFrame, keys=("campaign",)) -> DataFrame:
    """Users by which type they clicked: only one, both, neither."""
    p, s = F.col("p_clicked") == 1, F.col("s_clicked") == 1
    return _per_user_types(base, keys).groupBy(*keys).agg(
        F.count_if(p & ~s).alias("p_only"), F.count_if(~p & s).alias("s_only"), F.count_if(p & s).alias("clicked_both"),
        F.count_if(~p & ~s).alias("neither"), _n().alias("users"))


def arm_split(base: DataFrame, week: str | None = None) -> DataFrame:
    """Sends per arm and their share, overall or per week (``sunday`` or ``monday`` start)."""
    keys = []
    if week:
        d = X.week_sunday("send_date") if week == "sunday" else F.to_date(F.date_trunc("week", "send_date"))
        base, keys = base.withColumn("week", d), ["week"]
    counts = base.groupBy(*keys, "arm_id").agg(_n().alias("sends"), F.count_distinct("user_id").alias("users"))
    # a handful of arms per week: the window runs over aggregated rows
    total = F.sum("sends").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1)))
    return counts.withColumn("share", F.round(F.col("sends") / total * 100, 2))


def ab_test(base: DataFrame, a: str, b: str, by: str = "treatment_type") -> DataFrame:
    """Click rates of two arms, lift and two-proportion z in one conditional pass."""
    def arm(x):
        c = F.col(by) == x
        return F.count_if(c), F.count_if(c & (F.col("clicked") == 1))

    (na, ka), (nb, kb) = arm(a), arm(b)
    row = base.agg(na.alias("a_sends"), ka.alias("a_clicks"), nb.alias("b_sends"), kb.alias("b_clicks"))
    z = X.two_proportion_z("a_clicks", "a_sends", "b_clicks", "b_sends")
    return row.withColumns({
        "a_ctr": X.pct("a_clicks", "a_sends", 3), "b_ctr": X.pct("b_clicks", "b_sends", 3),
        "lift_pp": F.round((X.safe_div("b_clicks", "b_sends") - X.safe_div("a_clicks", "a_sends")) * 100, 3),
        "z": F.round(z, 3), "significant": X.significance(z)})


def revenue_24h(base: DataFrame, orders: DataFrame, by: str = "treatment_type", hours: int = 24) -> DataFrame:
    """Orders within ``hours`` of a send of the arm, each (user, order) once per arm."""
    pairs = base.select("user_id", by).distinct()
    left = orders.join(pairs, "user_id")
    right = base.select("user_id", by, "sent_ts", "tracking_id")
    hits = asof_join(left, right, ["user_id", by], "order_ts", "sent_ts", "tracking_id", hours * 3600, strict=False)
    rev = hits.groupBy(by).agg(F.count_distinct("user_id").alias("buyers"), F.count_distinct("order_id").alias("orders"),
                               F.sum("order_value").alias("revenue"))
    users = base.groupBy(by).agg(F.count_distinct("user_id").alias("users"),
                                 F.count_distinct(F.when(F.col("clicked") == 1, F.col("user_id"))).alias("clickers"))
    rows = users.join(rev, by, "left").fillna(0, ["buyers", "orders"])
    r = F.coalesce(F.col("revenue").cast("double"), F.lit(0.0))
    return rows.withColumns({"revenue": F.round(r, 2), "aov": F.round(X.safe_div(r, "orders"), 2),
                             "click_to_order": X.pct("buyers", "clickers"), "per_user": F.round(X.safe_div(r, "users"), 2)})


def scorecard(base: DataFrame, orders: DataFrame, by: str = "treatment_type") -> DataFrame:
    """Per type distinct users sent, opened, clicked, ordered after the first send, revenue."""
    per = base.groupBy(by, "user_id").agg(F.min("sent_ts").alias("first_ts"), F.max("opened").alias("o"), F.max("clicked").alias("c"))
    bought = per.select(by, "user_id", "first_ts").join(orders, "user_id").where("order_ts > first_ts").groupBy(by, "user_id").agg(
        _n().alias("n"), F.sum("order_value").alias("v"))
    rows = per.join(bought, [by, "user_id"], "left").groupBy(by).agg(
        _n().alias("sent"), F.sum("o").alias("opened"), F.sum("c").alias("clicked"), F.count("n").alias("ordered"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orders"), F.round(F.coalesce(F.sum("v").cast("double"), F.lit(0.0)), 2).alias("revenue"))
    return rows.withColumn("aov", F.round(X.safe_div("revenue", "orders"), 2))


# ---- funnels ----------------------------------------------------------------------
def user_journey(sends: DataFrame, deliveries: DataFrame, interactions: DataFrame, orders: DataFrame) -> DataFrame:
    """Per recipient: first send, flags for delivered/opened/clicked, orders after the first send."""
    s = sends.groupBy("user_id").agg(F.min("sent_ts").alias("sent_ts"))
    d = deliveries.groupBy("user_id").agg(_flag(F.col("status") == "DELIVERY_SUCCESSFUL").alias("delivered"))
    i = interactions.groupBy("user_id").agg(_flag(_is(VIEWED)).alias("opened"), _flag(_is(CLICKED)).alias("clicked"))
    o = orders.join(s, "user_id").where("order_ts > sent_ts").groupBy("user_id").agg(
        _n().alias("orders"), F.sum("order_value").alias("revenue"), F.min("order_ts").alias("first_order"))
    rows = s.join(d, "user_id", "left").join(i, "user_id", "left").join(o, "user_id", "left")
    return rows.fillna(0, ["delivered", "opened", "clicked", "orders"])


def funnel(journey: DataFrame) -> DataFrame:
    """Users per stage and their share of the users sent, one pass."""
    row = journey.agg(_n().alias("sent"), F.sum("delivered").alias("delivered"), F.sum("opened").alias("opened"),
                      F.sum("clicked").alias("clicked"), F.count_if(F.col("orders") > 0).alias("ordered"))
    names = ("sent", "delivered", "opened", "clicked", "ordered")
    items = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("stage"), F.col(n).alias("users"),
                               X.pct(n, "sent").alias("pct_of_sent")) for i, n in enumerate(names)])
    return row.select(F.inline(items))


def conversion_path(journey: DataFrame) -> DataFrame:
    """Buyers by the deepest stage they reached before ordering, with revenue."""
    path = (F.when(F.col("clicked") == 1, "clicked").when(F.col("opened") == 1, "opened")
            .when(F.col("delivered") == 1, "delivered").otherwise("sent"))
    rows = journey.where("orders > 0").groupBy(path.alias("path")).agg(
        _n().alias("users"), F.sum("orders").alias("orders"), F.sum("revenue").cast("double").alias("revenue"))
    return rows.withColumn("avg_order", F.round(X.safe_div("revenue", "orders"), 2))


def revenue_by_day(sends: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders of recipients after their first send, per day."""
    s = sends.groupBy("user_id").agg(F.min("sent_ts").alias("sent_ts"))
    return orders.join(s, "user_id").where("order_ts > sent_ts").groupBy(F.to_date("order_ts").alias("day")).agg(
        F.count_distinct("user_id").alias("buyers"), _n().alias("orders"), F.sum("order_value").cast("double").alias("revenue"))


def time_to_purchase(sends: DataFrame, orders: DataFrame) -> DataFrame:
    """Whole hours from the first send to the user's first order, in buckets."""
    s = sends.groupBy("user_id").agg(F.min("sent_ts").alias("sent_ts"))
    o = orders.groupBy("user_id").agg(F.min("order_ts").alias("order_ts"))
    hours = X.hours_between("sent_ts", "order_ts")
    label = X.bucket("h", (1, 6, 12, 24, 48), ("< 1 hour", "1-6 hours", "6-12 hours", "12-24 hours", "1-2 days", "2+ days"))
    return s.join(o, "user_id").where("order_ts > sent_ts").withColumn("h", hours).groupBy(label.alias("bucket")).agg(_n().alias("orders"))


def by_treatment(sends: DataFrame, interactions: DataFrame, least_users: int = 100) -> DataFrame:
    """Users sent, opened, clicked per treatment; opens and clicks counted in one pass."""
    s = sends.groupBy("treatment_id").agg(_n().alias("sends"), F.count_distinct("user_id").alias("users_sent"))
    i = interactions.groupBy("treatment_id").agg(
        F.count_if(_is(VIEWED)).alias("opens"), F.count_distinct(F.when(_is(VIEWED), F.col("user_id"))).alias("users_opened"),
        F.count_if(_is(CLICKED)).alias("clicks"), F.count_distinct(F.when(_is(CLICKED), F.col("user_id"))).alias("users_clicked"))
    rows = s.where(F.col("users_sent") >= least_users).join(i, "treatment_id", "left").fillna(0)
    return rows.withColumns({"open_rate": X.pct("users_opened", "users_sent"), "ctr": X.pct("users_clicked", "users_opened")})


# ---- fixed values: (text in the failure reason, category) ----
FAILURES = (("event limit", "Event Limit Exceeded"), ("API", "Provider API Error"), ("UNAVAILABLE", "Service Unavailable"))


def failure_category(reason, rules=FAILURES) -> Column:
    """Category of a failure reason."""
    r = X.col(reason)
    out = None
    for text, label in rules:
        out = F.when(r.contains(text), label) if out is None else out.when(r.contains(text), label)
    return out.when(r.isNull() | (r == ""), "Success").otherwise("Other Error")


def failures(deliveries: DataFrame, rules=FAILURES) -> DataFrame:
    """Deliveries and users per failure category and status."""
    return deliveries.groupBy(failure_category("failure_reason", rules).alias("category"), "status").agg(
        _n().alias("n"), F.count_distinct("user_id").alias("users"))


def recipients_vs_others(orders: DataFrame, sends: DataFrame) -> DataFrame:
    """Buyers, orders and revenue of recipients and of everybody else."""
    got = sends.select("user_id").distinct().withColumn("_g", F.lit("recipient"))
    per = orders.groupBy("user_id").agg(_n().alias("n"), F.sum("order_value").alias("v"))
    rows = per.join(got, "user_id", "left").groupBy(F.coalesce("_g", F.lit("other")).alias("segment")).agg(
        _n().alias("buyers"), F.sum("n").alias("orders"), F.sum("v").cast("double").alias("revenue"))
    return rows.withColumns({"avg_order": F.round(X.safe_div("revenue", "orders"), 2),
                             "per_buyer": F.round(X.safe_div("revenue", "buyers"), 2)})


def hourly(interactions: DataFrame) -> DataFrame:
    """Interactions and users per hour of day and type."""
    return interactions.groupBy(F.hour("ts").alias("hour"), "type").agg(_n().alias("events"), F.count_distinct("user_id").alias("users"))


def open_to_order(sends: DataFrame, interactions: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders after the user's first open with the minute gaps."""
    s = sends.groupBy("user_id").agg(F.min("sent_ts").alias("sent_ts"))
    o = interactions.where(_is(VIEWED)).groupBy("user_id").agg(F.min("ts").alias("open_ts"))
    rows = orders.join(s.join(o, "user_id"), "user_id").where("order_ts > open_ts")
    return rows.withColumns({"minutes_to_open": X.minutes_between("sent_ts", "open_ts"),
                             "minutes_to_order": X.minutes_between("open_ts", "order_ts")})


def summary(journey: DataFrame) -> DataFrame:
    """The funnel and revenue as one row, from one pass."""
    return journey.agg(
        _n().alias("sent"), F.sum("delivered").alias("delivered"), F.sum("opened").alias("opened"), F.sum("clicked").alias("clicked"),
        F.count_if(F.col("orders") > 0).alias("ordered"), F.round(F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)), 2).alias("revenue"))


def daily(sends: DataFrame, interactions: DataFrame) -> DataFrame:
    """Sent, opened and clicked users per day, outer-joined on the day."""
    s = sends.groupBy(F.to_date("sent_ts").alias("day")).agg(F.count_distinct("user_id").alias("users_sent"))
    i = interactions.groupBy(F.to_date("ts").alias("day")).agg(
        F.count_distinct(F.when(_is(VIEWED), F.col("user_id"))).alias("users_opened"),
        F.count_distinct(F.when(_is(CLICKED), F.col("user_id"))).alias("users_clicked"))
    rows = s.join(i, "day", "full")
    return rows.withColumns({"open_rate": X.pct("users_opened", "users_sent"), "ctr": X.pct("users_clicked", "users_opened")})


def depth(interactions: DataFrame) -> DataFrame:
    """How many (user, treatment) pairs opened or clicked once, twice, three times, more."""
    per = interactions.groupBy("user_id", "treatment_id").agg(F.count_if(_is(VIEWED)).alias("o"), F.count_if(_is(CLICKED)).alias("c"))
    names = ("once", "twice", "three_times", "four_plus")

    def counts(c):
        return [F.count_if(F.col(c) == i + 1) if i < 3 else F.count_if(F.col(c) >= 4) for i in range(4)]

    row = per.agg(*[x.alias(f"{c}_{n}") for c in "oc" for n, x in zip(names, counts(c))])
    items = F.array(*[F.struct(F.lit(m).alias("metric"), *[F.col(f"{c}_{n}").alias(n) for n in names])
                      for c, m in (("o", "Opens"), ("c", "Clicks"))])
    return row.select(F.inline(items))


def time_to_action(sends: DataFrame, interactions: DataFrame) -> DataFrame:
    """Minutes from each send to the first interaction of its (user, treatment), mean and median."""
    first = interactions.groupBy("user_id", "treatment_id", "type").agg(F.min("ts").alias("first_ts"))
    rows = sends.select("user_id", "treatment_id", "sent_ts").join(first, ["user_id", "treatment_id"]).where("first_ts > sent_ts")
    rows = rows.select("type", X.minutes_between("sent_ts", "first_ts").alias("m"))
    median = disc_quantile(rows, ["type"], "m", 0.5, "median_minutes")
    return rows.groupBy("type").agg(_n().alias("n"), F.round(F.avg("m"), 1).alias("avg_minutes")).join(median, "type", "left")


def click_to_order(interactions: DataFrame, orders: DataFrame) -> DataFrame:
    """C14: clickers, those who ordered after and those who had ordered before their first click."""
    c = interactions.where(_is(CLICKED)).groupBy("user_id").agg(F.min("ts").alias("click_ts"))
    o = orders.groupBy("user_id").agg(F.min("order_ts").alias("first_order"), F.max("order_ts").alias("last_order"))
    row = c.join(o, "user_id", "left").agg(
        _n().alias("clickers"), F.count_if(F.col("last_order") > F.col("click_ts")).alias("ordered_after"),
        F.count_if(F.col("first_order") < F.col("click_ts")).alias("ordered_before"))
    return row.withColumn("conversion", X.pct("ordered_after", "clickers"))


def sent_vs_interacted(sends: DataFrame, interactions: DataFrame) -> DataFrame:
    """Per treatment users sent and users with any interaction."""
    i = interactions.select("user_id", "treatment_id").distinct().withColumn("_i", F.lit(1))
    rows = sends.select("user_id", "treatment_id").distinct().join(i, ["user_id", "treatment_id"], "left")
    out = rows.groupBy("treatment_id").agg(_n().alias("users_sent"), F.count("_i").alias("users_interacted"))
    return out.withColumn("rate", X.pct("users_interacted", "users_sent"))


# ---- fixed values: keyword -> campaign, in order of precedence ----
CAMPAIGN_WORDS = (("post purchase", "Post Purchase"), ("abandon", "Abandoned Cart"), ("browse", "Browse Recovery"))


def campaign_of(name, words=CAMPAIGN_WORDS) -> Column:
    """P10: campaign by the first keyword found in the treatment name."""
    n = F.lower(X.col(name))
    out = None
    for word, label in words:
        out = F.when(n.contains(word), label) if out is None else out.when(n.contains(word), label)
    return out.otherwise("Other")


def treatment_kind(name) -> Column:
    """P10: personalised or static by treatment name."""
    n = F.lower(X.col(name))
    return F.when(n.contains("personalized") | n.contains("fitment"), PERSONAL).otherwise(STATIC)
