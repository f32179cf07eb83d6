"""Contracts, metrics, graph, campaign, bandit, sources and sinks on small fixtures."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from slotwise.operators import bandit, campaign, candidates, contracts, copurchase, eligibility, evaluate, graph, popularity, quality, slots
from slotwise.params import RecParams
from slotwise.sources import bags, sinks, tables
from slotwise.sources.bags import BAG_ENTRY

BAG = f"array<{BAG_ENTRY}>"


def ts(text):
    return dt.datetime.fromisoformat(text)


# ---- sources ---------------------------------------------------------------------------
def test_latest_attributes(spark):
    rows = [
        (1, ts("2025-01-01"), ts("2025-01-01"), [("email", "a@x", None, None), ("v1_year", None, 1999, None), ("V1_MAKE", "ford", None, None), ("v1_model", "old", None, None)]),
        (1, ts("2025-02-01"), ts("2025-01-01"), [("v1_model", " mustang ", None, None)]),
        (1, ts("2025-02-01"), ts("2025-01-02"), [("Email", " B@X ", None, None)]),
        (2, ts("2025-01-01"), ts("2025-01-01"), [("email", "c@x", None, None), ("v1_year", "19x9", None, None), ("v1_make", "A", None, None), ("v1_model", "B", None, None)]),
        (3, ts("2025-01-01"), ts("2025-01-01"), [("email", "d@x", None, None), ("v1_year", "2001", None, None), ("v1_make", "A", None, None), ("v1_model", "B", None, None)]),
        (3, ts("2025-03-01"), ts("2025-03-01"), [("v1_model", "", None, None)]),
    ]
    df = spark.createDataFrame(rows, f"user_id int, update_ts timestamp, ingest_ts timestamp, props {BAG}")
    out = bags.latest_attributes(df).collect()
    assert [(r.user_id, r.email, r.year, r.make, r.model) for r in out] == [(1, "b@x", 1999, "FORD", "MUSTANG")]


def test_stage_events(spark):
    rows = [
        (1, "Viewed Product", ts("2025-01-01"), [("ProdID", None, 77, None), ("Price", "12.5", None, None), ("ImageURL", "//a", None, None)]),
        (1, "cart update", ts("2025-01-02"), [("Items_0.ProductId", " a1 ", None, None), ("Items_0.ItemPrice", None, None, 5.0), ("Items_1.ProductID", "b2", None, None), ("Items_1.ImageUrl", "http://b", None, None)]),
        (1, "Consumer Website Order", ts("2025-01-03"), [("SKUs_1", "c3", None, None), ("Subtotal", None, None, 9.0)]),
        (1, "Login", ts("2025-01-03"), [("ProductID", "zz", None, None)]),
    ]
    df = spark.createDataFrame(rows, f"user_id int, event_name string, event_ts timestamp, props {BAG}")
    out = sorted((r.sku, r.event_name, r.price, r.image_raw) for r in bags.stage_events(df).collect())
    assert out == [("77", "VIEWED PRODUCT", 12.5, "//a"), ("A1", "CART UPDATE", 5.0, None), ("B2", "CART UPDATE", None, "http://b"), ("C3", "CONSUMER WEBSITE ORDER", None, None)]


def test_import_orders(spark):
    rows = [(" ab1b ", " A@X ", "Friday, January 10, 2025"), ("EXT-1", "a@x", "Friday, January 10, 2025"), ("AB2", "a@x", "someday 2025"),
            (None, "a@x", "Friday, January 10, 2025"), ("AB3", "a@x", "Sunday, January 1, 2012"), ("AB4", "b@x", "Tuesday, December 30, 2025")]
    df = spark.createDataFrame(rows, "item string, ship_to_email string, order_date string")
    out = [tuple(r) for r in tables.import_orders(df, RecParams()).orderBy("sku").collect()]
    assert out == [("AB1", "a@x", dt.date(2025, 1, 10), 1, 0), ("AB4", "b@x", dt.date(2025, 12, 30), 0, 1)]


def test_scan_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", F.timestamp_seconds(F.col("id") * 86400).alias("t")).write.parquet(path)
    df = tables.scan_range(spark.read.parquet(path), "t", "1970-01-05", "1970-01-06").select("id")
    assert sorted(r.id for r in df.collect()) == [4, 5]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ts("2025-01-01 10:00:00")), (2, ts("2025-01-02 10:00:00"))], "user_id int, t timestamp")
    sinks.replace_partitioned(df, str(tmp_path / "a"), "t", ["user_id"])
    assert (tmp_path / "a" / "event_date=2025-01-01").exists()
    back = sinks.publish(df, str(tmp_path / "b"), now=dt.datetime(2025, 1, 1)).collect()
    assert [r.rows for r in back] == [2, 2] and back[1].path.endswith("b/version_20250101_000000_000000")
    assert sinks.publish(df, str(tmp_path / "c"), enabled=False) is None
    sinks.write_shadow(df, str(tmp_path / "d"), "fail")
    with pytest.raises(Exception):
        sinks.write_shadow(df, str(tmp_path / "d"), "fail")
    empty = tables.read_optional(spark, str(tmp_path / "none"), df.schema)
    assert empty.count() == 0 and empty.columns == df.columns


def test_sinks_bucketed(spark):
    df = spark.range(50).select("id", (F.col("id") % 5).alias("k"))
    sinks.save_bucketed(df, "bucketed_t", ["k"], 4)
    a = spark.table("bucketed_t")
    plan = a.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("DROP TABLE bucketed_t")


# ---- contracts ---------------------------------------------------------------------------
def engine(spark):
    return {
        "users": spark.createDataFrame([("u1",), ("u2",)], "user_id string"),
        "products": spark.createDataFrame([("p1", 1.0), ("p2", 2.0)], "product_id string, price double"),
        "interactions": spark.createDataFrame([("u1", "p1", "view", 1.0)], "user_id string, product_id string, interaction_type string, weight double"),
    }


def test_contract_accepts(spark):
    contracts.validate(engine(spark))


def test_contract_reports_all_findings(spark):
    t = engine(spark)
    t["users"] = spark.createDataFrame([("u1",), ("u1",), (None,)], "user_id string")
    t["products"] = spark.createDataFrame([("p1", -1.0), ("p2", float("nan"))], "product_id string, price double")
    t["interactions"] = spark.createDataFrame([("u9", "p1", None, "x")], "user_id string, product_id string, interaction_type string, weight string")
    with pytest.raises(contracts.ContractError) as e:
        contracts.validate(t, "2.0")
    text = str(e.value)
    for part in ("contract_version", "interactions.weight: wrong_type", "users.user_id: null (1)", "users.user_id: duplicate (1)", "products.price: bad_number (2)",
                 "interactions.user_id: orphan (1)", "interactions.interaction_type: null (1)"):
        assert part in text, part
    with pytest.raises(contracts.ContractError, match="missing_table"):
        contracts.validate({k: v for k, v in engine(spark).items() if k != "users"})


# ---- metrics -------------------------------------------------------------------------------
def test_ranking_metrics(spark):
    preds = spark.createDataFrame([(1, [10, 20, 30, 40, 50]), (2, [40, 10, 20, 30, 50]), (3, [50, 40, 30, 20, 10]), (4, [1]), (5, [])], "user_id int, items array<int>")
    acts = {1: {10, 20, 30}, 2: {10, 40}, 3: {20, 30, 40, 50}, 5: {1}}
    adf = spark.createDataFrame([(u, i) for u in acts for i in acts[u]], "user_id int, item int")
    out = {r.user_id: r for r in evaluate.per_user_metrics(preds, adf, (3, 5)).collect()}
    assert set(out) == {1, 2, 3}
    assert out[1].precision_3 == 1.0 and out[1].recall_5 == 1.0 and out[1].ndcg_3 == pytest.approx(1.0) and out[1].map == pytest.approx(1.0)
    assert out[2].precision_3 == pytest.approx(2 / 3) and out[2].mrr == 1.0 and out[2].map == 1.0
    assert out[3].recall_3 == pytest.approx(0.75) and out[3].hit_3 == 1.0
    avg = evaluate.average_metrics(evaluate.per_user_metrics(preds, adf, (3,))).first()
    assert avg.users == 3 and avg.mrr == 1.0
    none = evaluate.per_user_metrics(preds.where("user_id = 1"), spark.createDataFrame([(1, 99)], "user_id int, item int"), (3,)).first()
    assert none.mrr == 0.0 and none.map == 0.0 and none.ndcg_3 == 0.0 and none.hit_3 == 0.0


def test_bootstrap_covers_the_mean(spark):
    df = spark.range(2000).select((F.col("id") % 4 == 0).cast("double").alias("hit_4"))
    r = evaluate.bootstrap_interval(df, "hit_4", 400).first()
    se = math.sqrt(0.25 * 0.75 / 2000)
    assert r.low < 0.25 < r.high and (r.high - r.low) == pytest.approx(2 * 1.96 * se, rel=0.25)


@pytest.mark.parametrize("cand,decision", [(0.13, "GO"), (0.115, "MAYBE"), (0.10, "SKIP"), (0.05, "INVESTIGATE")])
def test_go_no_go(spark, cand, decision):
    def one(v):
        return spark.createDataFrame([(v,)], "hit_4 double")
    assert evaluate.go_no_go(one(cand), one(0.10)).first().decision == decision


def test_auc(spark):
    rows = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1)]
    got = evaluate.auc(spark.createDataFrame(rows, "score double, label int")).first().auc
    pairs = [(p, n) for p, lp in rows if lp for n, ln in rows if not ln]
    assert got == pytest.approx(sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs))


def test_compare_metrics_limits(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 1.0), ("z", 0.0)], "metric string, value double")
    b = spark.createDataFrame([("x", 0.9), ("y", 0.9), ("z", 1.0)], "metric string, value double")
    c = evaluate.compare_metrics(a, b, 5.0, {"y": 20.0})
    assert {r.metric: r.regression for r in c.collect()} == {"x": True, "y": False, "z": False}
    assert evaluate.verdict(c).first().passed is False


# ---- graph -----------------------------------------------------------------------------------
def test_split_ratios_and_stability(spark):
    users = spark.range(1000).select(F.col("id").alias("user_id"), F.when(F.col("id") < 600, "hot").when(F.col("id") < 990, "cold").alias("tier"))
    out = graph.stratified_split(users)
    n = {(r.tier, r.split): r["count"] for r in out.groupBy("tier", "split").count().collect()}
    assert n["hot", "train"] == 480 and n["hot", "val"] == 60 and n["cold", "test"] == 39 and n[None, "train"] == 8
    again = graph.stratified_split(users.repartition(9))
    assert {tuple(r) for r in out.select("user_id", "split").collect()} == {tuple(r) for r in again.select("user_id", "split").collect()}


def test_negative_samples(spark):
    pos = spark.range(1000).select((F.col("id") % 50).alias("user_id"), (F.col("id") % 97).alias("product_id")).distinct()
    products = spark.range(97).select(F.col("id").alias("product_id"))
    fit = spark.range(97).select(F.col("id").alias("product_id"), (F.col("id") % 4).alias("entity_id"))
    own = spark.range(40).select(F.col("id").alias("user_id"), (F.col("id") % 4).alias("entity_id"))
    out = graph.negative_samples(pos, products, fit, own).collect()
    total = pos.count()
    modes = {m: sum(r.mode == m for r in out) for m in ("in_batch", "fitment_hard", "random")}
    assert len(out) == total and modes["in_batch"] == int(total * 0.5) and modes["fitment_hard"] == int(total * 0.3)
    assert all(r.negative_id is not None for r in out)
    for r in out:
        if r.mode == "fitment_hard" and r.user_id < 40:
            assert r.negative_id != r.product_id and r.negative_id % 4 == r.user_id % 4
    with pytest.raises(ValueError):
        graph.negative_samples(pos, products, fit, own, (0.5, 0.5, 0.5))


def test_edges_are_symmetric_and_checked(spark):
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    products = spark.createDataFrame([("a",), ("b",)], "product_id string")
    inter = spark.createDataFrame([("u1", "a", 2.0), ("u9", "a", 1.0), ("u2", "z", 1.0)], "user_id string, product_id string, weight double")
    fit = spark.createDataFrame([("a", "e")], "product_id string, entity_id string")
    own = spark.createDataFrame([("u1", "e")], "user_id string, entity_id string")
    cop = spark.createDataFrame([("a", "b", 3.0), ("a", "z", 3.0)], "product_a string, product_b string, weight double")
    split = spark.createDataFrame([("u1", "train"), ("u2", "test")], "user_id string, split string")
    e = graph.build_edges(inter, fit, own, cop, users, products, split)
    got = sorted((r.src, r.dst, r.edge_type, r.is_train) for r in e.collect())
    assert ("u1", "a", "interacts", True) in got and ("a", "u1", "rev_interacts", False) in got
    assert ("a", "b", "co_purchased", False) in got and ("b", "a", "co_purchased", False) in got and len(got) == 8
    graph.require_edges(e)
    with pytest.raises(ValueError):
        graph.require_edges(e.withColumn("weight", F.lit(float("nan"))))
    with pytest.raises(ValueError):
        graph.require_edges(e.where("edge_type <> 'interacts'"))


def test_bpr_loss(spark):
    df = spark.createDataFrame([(1.0, 0.0, 2.0), (0.0, 3.0, 1.0)], "pos_score double, neg_score double, weight double")
    want = (2 * math.log1p(math.exp(-1)) + math.log1p(math.exp(3))) / 3
    assert graph.bpr_loss(df).first().loss == pytest.approx(want)


def test_category_pairs(spark):
    rows = [(1, "d", f"s{i}") for i in range(8)] + [(2, "d", "s0"), (2, "d", "s1"), (3, "d", "s0"), (3, "d", "s8"), (4, "d", "s9"), (4, "d", "gone"), (4, "d", "s1")]
    orders = spark.createDataFrame(rows, "user_id int, order_date string, sku string")
    cat = spark.createDataFrame([(f"s{i}", f"c{i}") for i in range(8)] + [("s8", "  "), ("s9", None)], "sku string, category string")
    pairs = lambda low, high: {tuple(r) for r in copurchase.category_copurchase(orders, cat, low, high, min_count=1).collect()}
    assert pairs(2, 5) == {("c0", "c1", 1), ("UNIVERSAL", "c0", 1), ("UNIVERSAL", "c1", 1)}
    assert len(pairs(2, 8)) == 30 and ("c0", "c1", 2) in pairs(2, 8)
    skus = copurchase.category_copurchase_skus(orders, cat, 2, 10, min_count=1)
    assert ("c0", "c1", 2) in {tuple(r) for r in skus.collect()} and skus.count() == 29


def test_parts_list_of_a_large_vehicle(spark):
    parts = spark.range(20_000).selectExpr("'big' AS make", "concat('P', id) AS sku").union(spark.createDataFrame([("small", "A")], "make string, sku string"))
    rows = {r.make: r for r in eligibility.vehicle_parts_list(parts, ["make"]).collect()}
    assert len(rows) == 2 and rows["big"].total_count == len(rows["big"].parts) == 20_000 and rows["small"].parts == ["A"]


def test_exclusion_window_cuts_events(spark):
    p = RecParams(event_start="2025-09-01", event_end="2026-02-01", excl_start="2025-02-01", excl_end="2026-02-01")
    staged = spark.createDataFrame([(1, "A", "2025-04-01 10:00:00", "PLACED ORDER"), (1, "B", "2025-01-31 10:00:00", "PLACED ORDER"), (1, "C", "2026-02-01 23:00:00", "PLACED ORDER")],
                                   "user_id int, sku string, event_ts string, event_name string").withColumn("event_ts", F.to_timestamp("event_ts"))
    imported = spark.createDataFrame([("u@x", "D", "2025-02-01"), ("u@x", "E", "2026-02-02")], "email string, sku string, order_date string").withColumn("order_date", F.to_date("order_date"))
    users = spark.createDataFrame([(1, "u@x")], "user_id int, email string")
    assert {r.sku for r in candidates.purchase_exclusion(staged, imported, users, p).collect()} == {"A", "C", "D"}


def test_segment_tier_of_an_unknown_product(spark):
    rows = spark.createDataFrame([("m", "o", "known"), ("m", "o", "unknown")], "seg_make string, seg_model string, sku string")
    seg = spark.createDataFrame([], "seg_make string, seg_model string, sku string, segment_score double, total_segment_orders bigint")
    make = spark.createDataFrame([], "seg_make string, sku string, make_score double, total_make_orders bigint")
    glob = spark.createDataFrame([("known", 3.0)], "sku string, global_score double")
    got = {r.sku: (r.popularity_source, r.popularity) for r in popularity.with_popularity_by_segment(rows, seg, make, glob, RecParams()).collect()}
    assert got == {"known": ("global", 3.0), "unknown": ("none", 0.0)}


def test_fallback_walks_entities_in_their_order(spark):
    recs = spark.createDataFrame([], "user_id int, slot int, product_id bigint, category string, score double")
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    pools = slots.popularity_pools(one([(1, "a", 1.0, False), (2, "b", 9.0, False)], "product_id bigint, category string, popularity double, is_excluded boolean"),
                                   one([(2, 1), (10, 2)], "entity_id int, product_id bigint"), one([(2, None), (10, None)], "entity_id int, group_id string"))
    args = (recs, one([(7,)], "user_id int"), one([(7, 10, 5), (7, 2, 6)], "user_id int, entity_id int, place int"), one([(2, None), (10, None)], "entity_id int, group_id string"), pools,
            one([], "user_id int, product_id bigint"))
    assert [r.product_id for r in slots.popularity_fallback(*args, min_recs=2).orderBy("slot").collect()] == [1, 2]
    assert [r.product_id for r in slots.popularity_fallback(*args, min_recs=2, position="place").orderBy("slot").collect()] == [2, 1]


# ---- eligibility, quality ----------------------------------------------------------------------
def test_eligible_parts(spark):
    p = RecParams(min_price=50.0, min_parts_per_vehicle=2)
    cat = spark.createDataFrame([("A", "Carb", ""), ("B", "Carb", "x,ReFurbished"), ("C", "Wheel Bolt", ""), ("WARRANTY-1", "Carb", ""), ("D", "Carb", "")], "sku string, category string, tags string")
    prices = spark.createDataFrame([("A", 60.0), ("D", 40.0), ("E", 2999.0), ("F", 3001.0)], "sku string, price double")
    images = spark.createDataFrame([(s, "https://i") for s in ("A", "B", "C", "D", "E", "F", "WARRANTY-1")], "sku string, image_url string")
    prod = eligibility.sellable_products(cat, prices, images, p)
    assert {r.sku for r in prod.collect()} == {"A", "F"}
    fit = spark.createDataFrame([(2000, "M", "X", s) for s in "AFBC"] + [(2001, "M", "X", "A"), (2000, "M", "X", "A")], "year int, make string, model string, sku string")
    out = eligibility.eligible_parts(fit, prod, ["year", "make", "model"], p)
    assert sorted((r.year, r.sku) for r in out.collect()) == [(2000, "A"), (2000, "F")]


def wide(spark, rows):
    cols = ", ".join(f"rec{i}_sku string, rec{i}_price double, rec{i}_score double" for i in range(1, 5))
    return spark.createDataFrame(rows, f"user_id int, {cols}, rec_count int")


def test_quality_checks(spark):
    w = wide(spark, [(1, "a", 60.0, 3.0, "b", 60.0, 2.0, "a", 60.0, 1.0, None, None, None, 3), (2, "a", 60.0, 1.0, "b", 40.0, 2.0, "c", 60.0, 1.0, "d", 60.0, 0.5, 4)])
    assert quality.duplicate_slots(w).first().violations == 1
    assert quality.score_order(w).first().ordered == 1
    assert quality.null_fourth_slot(w).first().unexpected == 0
    board = {r.metric: r.value for r in quality.health_board(w, 50.0).collect()}
    assert board == {"users": 2, "duplicate_skus": 1, "below_floor": 1, "order_violations": 1, "missing_slot1": 0}


def test_output_gate(spark):
    cols = ", ".join(f"rec{i}_product_id string, rec{i}_price double, rec{i}_score double" for i in range(1, 5))
    schema = f"user_id int, {cols}, is_fallback boolean, fallback_start_idx int"
    good = spark.createDataFrame([(1, "a", 9.0, 3.0, "b", 9.0, 1.0, "c", 9.0, 5.0, None, None, None, True, 2)], schema)
    quality.require_output(good, 1, floor=5.0)
    with pytest.raises(quality.OutputRejected, match="order_violations"):
        quality.require_output(good.withColumn("is_fallback", F.lit(False)), 1)
    with pytest.raises(quality.OutputRejected, match="duplicate_users"):
        quality.require_output(good.union(good), 2)
    with pytest.raises(quality.OutputRejected, match="low_coverage"):
        quality.require_output(good, 10, min_coverage=0.5)
    with pytest.raises(quality.OutputRejected, match="missing columns"):
        quality.require_output(good.drop("rec4_score"), 1)


def test_check_board_order(spark):
    def row(v, name, sev):
        return quality.check_row(spark.createDataFrame([(v,)], "x int"), "x", name, sev)
    board = [(r.check, r.status) for r in quality.check_board([row(0, "low", "LOW"), row(2, "high", "HIGH"), row(0, "crit", "CRITICAL")]).collect()]
    assert board == [("crit", "PASS"), ("high", "FAIL"), ("low", "PASS")]
    first = quality.check_board([row(0, "low", "LOW"), row(2, "high", "HIGH"), row(0, "crit", "CRITICAL")], failures_first=True).first()
    assert first.check == "high"


# ---- campaign, bandit ----------------------------------------------------------------------------
def test_attribution_goes_to_last_send_and_skips_overlap(spark):
    base = spark.createDataFrame([
        (1, 11, ts("2025-01-01"), "Static", "p"), (1, 12, ts("2025-01-05"), "Static", "p"), (2, 21, ts("2025-01-01"), "Static", "p"),
        (2, 22, ts("2025-01-02"), "Personalized", "p"), (3, 31, ts("2025-01-10"), "Personalized", "p")],
        "user_id int, tracking_id int, sent_ts timestamp, treatment_type string, period string").withColumn("eligible", F.lit(True))
    orders = spark.createDataFrame([
        (1, 1, ts("2025-01-06"), 10), (1, 2, ts("2025-01-06 01:00:00"), 10), (1, 3, ts("2025-01-20"), 5), (2, 4, ts("2025-01-03"), 7), (3, 5, ts("2025-01-09"), 9)],
        "user_id int, order_id int, order_ts timestamp, order_value int").withColumn("order_value", F.col("order_value").cast("decimal(12,2)"))
    got = sorted((r.user_id, r.tracking_id, float(r.order_value)) for r in campaign.attributed_orders(base, orders).collect())
    assert got == [(1, 12, 5.0), (1, 12, 10.0)]
    r = {x.treatment_type: x for x in campaign.revenue_attribution(base, orders).collect()}
    assert r["Static"].revenue_short == 10.0 and r["Static"].revenue_long == 15.0 and r["Static"].buyers_long == 1 and r["Personalized"].revenue_long == 0.0


def test_click_without_open_counts(spark):
    base = spark.createDataFrame([(1, "Static", "p", 1, 1), (2, "Static", "p", 0, 1), (3, "Static", "p", 1, 0)], "user_id int, treatment_type string, period string, opened int, clicked int")
    r = campaign.click_without_open(base.withColumn("eligible", F.lit(True))).first()
    assert (r.clicks, r.no_open, r.with_open, r.old_ctr, r.corrected_ctr) == (2, 1, 1, 100.0, 50.0)


def test_empty_inputs(spark):
    sends = spark.createDataFrame([], "tracking_id long, user_id long, treatment_id long, sent_ts timestamp, arm_id long, model_id long, score double, source string, treatment_type string, period string")
    inter = spark.createDataFrame([], "tracking_id long, user_id long, treatment_id long, type string, ts timestamp")
    el = spark.createDataFrame([], "user_id long")
    base = campaign.uplift_base(sends, inter, el, "2025-01-01")
    assert base.count() == 0 and campaign.rates(base, ["period"]).count() == 0
    assert campaign.ab_test(base, "a", "b").first().significant == "n/a"


def test_thompson_draws(spark):
    users = spark.range(20000).select(F.col("id").alias("user_id"))
    t = spark.createDataFrame([(1,), (2,), (3,)], "treatment_id long")
    post = spark.createDataFrame([(1, 0.5, 0.1), (2, 0.5, 0.1)], "treatment_id long, mean double, stddev double")
    a = bandit.thompson_assign(users, t, post, 5)
    n = {r.treatment_id: r["count"] for r in a.groupBy("treatment_id").count().collect()}
    assert abs(n[1] / 20000 - 0.5) < 0.02 and n.get(3, 0) < 20
    b = bandit.thompson_assign(users.repartition(5), t, post, 5)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    other = bandit.thompson_assign(users, t, post, 6)
    assert a.join(other, ["user_id", "treatment_id"]).count() < 13000
