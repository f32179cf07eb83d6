import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from slotwise.functions import exprs as X
from slotwise.functions import indexing, pairs, sketches
from slotwise.functions.asof import asof_join
from slotwise.functions.indexing import dense_ids, rank_by_hash, rank_in_order
from slotwise.functions.ranges import dyadic_cover, interval_join
from slotwise.functions.keyed import share_of_group, top_n_per_key, with_group_total


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


@pytest.mark.parametrize("sku,variant,base", [
    ("RA003B", "RA003", "RA003"), ("RA003", "RA003", "RA003"), ("AB12-KIT", "AB12-KIT", "AB12"), ("AB12R-BLK", "AB12R-BLK", "AB12"),
    ("AB-B", "AB-B", "AB"), ("ABB", "ABB", "ABB"), ("550-511-3XX", "550-511-3XX", "550-511-3XX")])
def test_variants(spark, sku, variant, base):
    assert one(spark, X.normalize_variant(F.lit(sku))) == variant
    assert one(spark, X.base_sku(F.lit(sku))) == base


@pytest.mark.parametrize("text,day", [("Friday, January 10, 2025", dt.date(2025, 1, 10)), ("Sunday, March 2, 2025", dt.date(2025, 3, 2)), ("soon", None), (None, None)])
def test_long_dates(spark, text, day):
    assert one(spark, X.parse_long_date(F.lit(text).cast("string"))) == day


@pytest.mark.parametrize("text,first,year", [("Friday, January 10, 2025", 2020, 2025), ("x 1999", 2020, None), ("x 1999", 1995, 1999), ("12020", 1995, None), ("x 1812", 1995, None)])
def test_order_year(spark, text, first, year):
    assert one(spark, X.order_year(F.lit(text), first, 2026)) == year


@pytest.mark.parametrize("kind,out", [("Head Gasket", True), ("Engine Bolt Kit", False), ("Wheel Bolt", True), ("Distributor Cap", False), ("Fuel Cap", True), ("Carburetor", False)])
def test_commodity(spark, kind, out):
    assert one(spark, X.is_commodity(F.lit(kind))) is out


@pytest.mark.parametrize("url,out", [("//a/b", "https://a/b"), ("http://a", "https://a"), ("HTTP://a", "https://a"), ("https://a", "https://a"), ("ftp://a", "ftp://a")])
def test_images(spark, url, out):
    assert one(spark, X.https_image(F.lit(url))) == out


def test_price_rules(spark):
    assert one(spark, X.price_ok(F.lit(None).cast("double"), 50)) is True
    assert one(spark, X.price_ok(F.lit(None).cast("double"), 50, False)) is False
    assert one(spark, X.unknown_category_ok(F.lit("UNKNOWN"), F.lit(2999.0), 50)) is False


def test_wilson_and_posteriors(spark):
    low, high = one(spark, X.wilson(F.lit(10), F.lit(100), False)), one(spark, X.wilson(F.lit(10), F.lit(100), True))
    assert low == pytest.approx(0.05522, abs=1e-4) and high == pytest.approx(0.17437, abs=1e-4)
    assert one(spark, X.wilson(F.lit(0), F.lit(0), True)) is None
    b = X.beta_posterior(F.lit(3), F.lit(10))
    assert one(spark, b["mean"]) == pytest.approx(4 / 12)
    n = X.nig_posterior(F.lit(2), F.lit(10))
    assert one(spark, n["mu"]) == pytest.approx(2 / 11)
    assert one(spark, n["beta"]) == pytest.approx(1 + 0.5 * (2 - 4 / 11) + 0.5 * 10 * 0.04 / 11)
    e = X.nig_posterior(F.lit(2), F.lit(10), exact=True)
    assert one(spark, e["beta"]) == pytest.approx(1 + 0.5 * (2 - 4 / 10) + 0.5 * 10 * 0.04 / 11)
    assert one(spark, X.nig_posterior(F.lit(0), F.lit(0))["mu"]) == 0.0


def test_hash_normal_is_standard_and_stable(spark):
    df = spark.range(40000).select(X.hash_normal("id").alias("z"))
    row = df.agg(F.avg("z").alias("m"), F.stddev("z").alias("s")).first()
    assert abs(row.m) < 0.02 and abs(row.s - 1) < 0.02
    again = spark.range(40000).repartition(7).select(X.hash_normal("id").alias("z"))
    assert sorted(r.z for r in df.collect()) == sorted(r.z for r in again.collect())


def test_salted_id(spark):
    import hashlib
    want = hashlib.sha256(b"s:a@b.c").hexdigest()[:16]
    assert one(spark, X.salted_id(F.lit(" A@b.C "), "s")) == want
    assert one(spark, X.salted_id(F.lit(None).cast("string"), "s")) is None


def test_top_n_plan_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    out = top_n_per_key(df, ["k"], [F.desc("id")], 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert sorted((r.k, r.id) for r in out.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]


def test_group_totals_and_shares(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "k string, v int")
    assert {(r.v, r.share) for r in share_of_group(df, ["k"], "v").where("k is not null").collect()} == {(1, 0.25), (3, 0.75)}
    assert {r.t for r in with_group_total(df, [], t=F.sum("v")).collect()} == {9}


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("bucket", [60, 3600, 10**6])
def test_asof_equals_brute_force(spark, strict, bucket):
    rnd = random.Random(3)
    # one user owns a third of all rows
    def user():
        return 0 if rnd.random() < 0.34 else rnd.randint(1, 9)
    left = [(user(), i, rnd.randint(0, 20000)) for i in range(300)]
    right = [(user(), 1000 + i, rnd.randint(0, 20000)) for i in range(300)]
    ts = F.timestamp_seconds("s")
    ldf = spark.createDataFrame(left, "u int, lid int, s int").select("u", "lid", ts.alias("lts"))
    rdf = spark.createDataFrame(right, "u int, rid int, s int").select("u", "rid", ts.alias("rts"))
    out = {r.lid: r.rid for r in asof_join(ldf, rdf, ["u"], "lts", "rts", "rid", 4000, strict, bucket).collect()}
    want = {}
    for u, lid, t in left:
        c = [(rt, rid) for ru, rid, rt in right if ru == u and (rt < t if strict else rt <= t) and t - rt <= 4000]
        if c:
            want[lid] = max(c)[1]
    assert out == want


def common_groups(rows, least):
    """(key, a, b) -> number of groups of (key, group, item) rows that hold both."""
    groups, out = {}, {}
    for k, g, i in rows:
        if k is not None and g is not None and i is not None:
            groups.setdefault((k, g), set()).add(i)
    for (k, _), s in groups.items():
        for a in s:
            for b in s:
                if a < b:
                    out[k, a, b] = out.get((k, a, b), 0) + 1
    return {k: v for k, v in out.items() if v >= least}


@pytest.mark.parametrize("least", [1, 2, 4])
@pytest.mark.parametrize("heavy", [0, 3, 9, 1000])
def test_pair_counts_of_light_and_heavy_groups(spark, monkeypatch, heavy, least):
    monkeypatch.setattr(pairs, "BLOCK", 4)
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), g, rnd.randint(0, 14)) for g in range(90) for _ in range(rnd.choice([1, 2, 4, 20]))] + [("a", 99, i) for i in range(25)]
    rows += [(None, 1, 1), ("a", None, 1), ("a", 99, None), ("a", 99, 3)]
    df = spark.createDataFrame(rows, "k string, g int, item int")
    got = pairs.pair_counts(df, ["g"], "item", least, within=["k"], heavy=heavy)
    assert got.columns == ["k", "item_a", "item_b", "co_count"]
    assert {(r.k, r.item_a, r.item_b): r.co_count for r in got.collect()} == common_groups(rows, least)
    assert pairs.pair_counts(df.limit(0), ["g"], "item", least, heavy=heavy).collect() == []


def test_one_group_of_a_hundred_thousand_items_makes_no_pairs_of_its_own(spark):
    n = 100_000
    small = spark.range(n).select((F.col("id") % (n // 2)).alias("g"), "id")  # 50,000 groups of two items
    df = small.union(spark.range(n).select(F.lit(-1).alias("g"), "id"))
    counts = pairs.pair_counts(df, ["g"], "id", 2)
    row = counts.agg(F.count(F.lit(1)).alias("n"), F.min("co_count").alias("low"), F.max("co_count").alias("high"), F.sum(F.col("item_b") - F.col("item_a")).alias("gap")).first()
    assert tuple(row) == (n // 2, 2, 2, (n // 2) ** 2)
    members = df.where("g = -1").select(F.col("id").alias("_x"), F.lit(0).cast("long").alias("_g"))
    assert pairs.prefix_members(members, [], 2).isEmpty()


def test_rank_in_order_of_a_hot_key(spark):
    """Three keys, one with nearly all rows, equal to row_number, with the hot key in many partitions."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        key = F.when(F.col("id") < 50, "few").when(F.col("id") == 60, F.lit(None)).otherwise("hot")
        df = spark.range(20_000).select("id", key.alias("k"), (F.col("id") * 7919 % 1000).alias("v"))
        out = rank_in_order(df, ["k"], [F.desc("v"), F.asc("id")], "r", total=F.sum("v"))
        assert out.columns == ["id", "k", "v", "r", "total"]
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for k in ("few", None, "hot"):
        own = sorted((r for r in rows if r.k == k), key=lambda r: (-r.v, r.id))
        assert [r.r for r in own] == list(range(1, len(own) + 1)) and {r.total for r in own} == {sum(r.v for r in own)}
    assert "row_number" not in plan
    assert rank_in_order(df, [], ["id"], "r").where("r != id + 1").isEmpty()
    assert rank_in_order(df.limit(0), ["k"], ["v", "id"], "r").collect() == []


def test_rank_by_hash_is_a_permutation_per_key(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") < 4000, "big").otherwise("small").alias("k"))
    out = rank_by_hash(df, ["k"], ["id"], 7).collect()
    for k, n in (("big", 4000), ("small", 1000)):
        assert sorted(r.pos for r in out if r.k == k) == list(range(n))
    again = {r.id: r.pos for r in rank_by_hash(df.repartition(5), ["k"], ["id"], 7).collect()}
    assert {r.id: r.pos for r in out} == again


def test_rank_by_hash_does_not_depend_on_its_ranges(spark, monkeypatch):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("k"))
    one = {r.id: (r.pos, r.pos_n) for r in rank_by_hash(df, ["k"], ["id"], 3).collect()}
    monkeypatch.setattr(indexing, "ROWS", 50)
    assert {r.id: (r.pos, r.pos_n) for r in rank_by_hash(df, ["k"], ["id"], 3).collect()} == one
    assert {r.id: r.pos for r in rank_by_hash(df, [], ["id"], 3).collect()} != {r.id: r.id for r in df.collect()}
    assert rank_by_hash(df.limit(0), ["k"], ["id"], 3).collect() == []


def test_dense_ids_sorted(spark):
    words = [f"w{i:04d}" for i in range(700)]
    df = spark.createDataFrame([(w,) for w in words * 2] + [(None,)], "w string").repartition(6)
    assert {r.w: r.id for r in dense_ids(df, "w").collect()} == {w: i for i, w in enumerate(words)}


def test_dyadic_blocks_make_up_the_interval(spark):
    rnd = random.Random(2)
    ends = [(a, a + rnd.choice([0, 1, 2, 7, 100, 1000])) for a in [rnd.randint(-1000, 1000) for _ in range(60)]] + [(-(2**40), 2**40), (0, 2**61)]
    df = spark.createDataFrame(ends, "a long, b long").select("a", "b", dyadic_cover(F.col("a"), F.col("b")).alias("c"))
    for r in df.collect():
        spans = sorted((x.node << x.level, ((x.node + 1) << x.level) - 1) for x in r.c)
        assert spans[0][0] == r.a and spans[-1][1] == r.b and all(p[1] + 1 == q[0] for p, q in zip(spans, spans[1:], strict=False))
        assert len(spans) <= 2 * max(1, (r.b - r.a + 1).bit_length())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_equals_all_pairs(spark, how):
    rnd = random.Random(9)
    points = [(i, rnd.choice(["a", "b", None]), rnd.choice([rnd.randint(-50, 50), None])) for i in range(200)]
    spans = [(rnd.choice("ab"), s, s + rnd.randint(-3, 40), f"g{i % 30}") for i, s in enumerate(rnd.randint(-60, 50) for _ in range(60))] + [("a", None, 5, "n"), ("a", 0, None, "n"), ("a", 3, 3, "x"), ("a", 3, 3, "x")]
    p, s = spark.createDataFrame(points, "id int, k string, v int"), spark.createDataFrame(spans, "k string, low int, high int, name string")
    got = interval_join(p, s, ["k"], "v", "low", "high", how)
    assert got.columns == ["id", "k", "v", "low", "high", "name"]
    want = []
    for i, k, v in points:
        hit = [(i, k, v, a, b, n) for kk, a, b, n in spans if kk == k and v is not None and a is not None and b is not None and a <= v <= b]
        want += hit or ([(i, k, v, None, None, None)] if how == "left" else [])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert interval_join(p, s.limit(0), ["k"], "v", "low", "high").collect() == []


def test_a_hundred_thousand_overlapping_intervals_of_one_make(spark):
    """All hold the middle, each point lies in few: the join makes a row a level, not a row an interval."""
    n = 100_000
    spans = spark.range(n).select(F.lit("m").alias("k"), (F.col("id") * 10).alias("low"), (F.col("id") * 10 + 25).alias("high"))
    wide = spark.range(n).select(F.lit("m").alias("k"), (-F.col("id") - 1).alias("low"), (F.col("id") + 1).alias("high"))
    points = spark.range(n).select(F.lit("m").alias("k"), (F.col("id") * 10 + 2).alias("v"))
    got = interval_join(points, spans, ["k"], "v", "low", "high")
    assert got.count() == 3 * n - 3  # the first two points lie in one and two
    far = spark.createDataFrame([("m", n - 1), ("m", n), ("m", n + 1), ("m", -n)], "k string, v long")
    hits = interval_join(far, wide, ["k"], "v", "low", "high").groupBy("v").count()
    assert {r.v: r["count"] for r in hits.collect()} == {n - 1: 2, n: 1, -n: 1}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_window_quantiles_from_stored_daily_sketches(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("d"),
                                    F.exp((F.col("id") * 7919 % 60_000) / 6000.0).alias("v"))
    df = df.union(spark.createDataFrame([("b", dt.date(2024, 1, 1), None)], "k string, d date, v double"))
    stored = sketches.daily_sketches(df, ["k"], F.col("d"), "v").cache()
    assert stored.count() == 20 and stored.agg(F.max(F.length("sketch"))).first()[0] < 16_000
    week = sketches.window_sketches(stored, ["k"], 4)
    rows = week.select("k", "day", sketches.count("sketch").alias("n"), sketches.quantile("sketch", 0.9).alias("q")).collect()
    assert len(rows) == 20
    data = [(r.k, r.d, r.v) for r in df.where("v is not null").collect()]
    for r in rows:
        own = sorted(v for k, d, v in data if k == r.k and 0 <= (r.day - d).days < 4)
        assert r.n == len(own) and abs(sum(v <= r.q for v in own) / len(own) - 0.9) < 3 * sketches.RANK_ERROR
