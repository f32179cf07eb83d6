"""Operators whose form is about scale: bounded search, vectors in place of rows, stages, safe publishing."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.operators import candidates as C
from slotwise.operators import evaluate as E
from slotwise.operators import graph as G
from slotwise.sources import sinks, tables
from slotwise.sources.testdata import Tables


@pytest.mark.parametrize("k,block,chunk", [(3, 7, 11), (1, 1, 5), (10, 4, 1000), (60, 4096, 8192)])
def test_bounded_vector_search_equals_all_pairs(spark, k, block, chunk):
    """Products of very different norms, equal products, zero and opposite vectors."""
    rnd = random.Random(11)
    users = [(u, [rnd.uniform(-1, 1) for _ in range(4)]) for u in range(40)] + [(98, [0.0] * 4), (99, [-1.0, -1.0, -1.0, -1.0])]
    prods = [(p, [rnd.uniform(0, 1) * 2.0 ** -(p % 9) for _ in range(4)]) for p in range(50)] + [(p, [1.0, 0.5, 0.25, 0.0]) for p in (70, 60, 80)] + [(90, [0.0] * 4)]
    u = spark.createDataFrame(users, "user_id long, vec array<double>")
    p = spark.createDataFrame(prods, "product_id long, vec array<double>")
    got = sorted((r.user_id, r.rank, r.product_id) for r in C.top_k_by_vector(u, p, k, block, chunk).collect())
    want = []
    for i, a in users:
        best = sorted((-float(np.dot(np.array(a), np.array(b))), j) for j, b in prods)[:k]
        want += [(i, n + 1, j) for n, (_, j) in enumerate(best)]
    assert got == sorted(want)
    seen = C.vector_visits(u, p, k, block, chunk).first()
    assert 0 < seen.visited <= seen.pairs == len(users) * -(-len(prods) // max(block, k))
    if k == 3:
        assert seen.share < 0.6


def test_bootstrap_shuffles_one_vector_a_task(spark):
    rows = spark.range(5000).select((F.col("id") % 977 / 977).alias("m")).union(spark.createDataFrame([(None,)], "m double"))
    out = E.bootstrap_interval(rows, "m", n=200)
    r = out.first()
    sd = rows.agg(F.stddev_samp("m")).first()[0]
    mean = rows.agg(F.avg("m")).first()[0]
    assert r.low < mean < r.high and 0.7 < (r.high - r.low) / (2 * 1.96 * sd / 5000 ** 0.5) < 1.3
    assert tuple(E.bootstrap_interval(rows.repartition(7), "m", n=200).first())[1:] == pytest.approx((r.low, r.high))  # draws belong to values, not to tasks
    assert "explode(sequence" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert E.bootstrap_interval(rows.limit(0), "m", n=5).first().low is None


def test_propagation_ships_at_most_a_vector_an_edge(spark):
    nodes = spark.createDataFrame([(i, [float(i + 1), 1.0, -1.0]) for i in range(6)], "node_id long, vec array<double>")
    edges = spark.createDataFrame([(i, 0, "a", float(i)) for i in range(6)] + [(0, 1, "a", 0.0), (2, 1, "b", 2.0), (0, 3, "a", 0.0)], "src long, dst long, edge_type string, weight double")
    got = {r.node_id: r.vec for r in G.propagate(nodes, edges, hops=1).collect()}
    vec = {i: np.array([i + 1.0, 1.0, -1.0]) for i in range(6)}
    want = {i: v for i, v in vec.items()}
    want[0] = vec[0] / 2 + sum(i * vec[i] for i in range(6)) / 15
    want[1], want[3] = vec[1] / 2 + vec[2], vec[3] / 2  # a neighbour without weight adds nothing but counts as one
    for i, v in want.items():
        assert got[i] == pytest.approx(list(v / np.linalg.norm(v)))
    plan = G.propagate(nodes, edges, hops=1)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_a_failed_publish_leaves_the_target_readable(spark, tmp_path):
    target = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, target)
    sinks.publish(spark.range(10), target)
    before = sinks.current_version(spark, target)
    # One of four tasks is killed by its row when the others have written theirs.
    bad = spark.range(0, 40, 1, 4).select(F.when(F.col("id") == 39, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        sinks.publish(bad, target)
    assert sinks.current_version(spark, target) == before and sinks.published(spark, target).count() == 10
    back = sinks.publish(spark.range(7), target).collect()
    assert [r.rows for r in back] == [7, 7] and sinks.published(spark, target).count() == 7
    assert spark.read.parquet(before).count() == 10  # the earlier version stays as its copy


def test_an_update_rewrites_changed_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", F.lit("old").alias("tier"), (F.col("id") % 5).alias("part")).write.partitionBy("part").parquet(path)

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}

    before = files()
    changes = spark.createDataFrame([(3, "new", 3), (8, None, 3), (4, "old", 4), (1000, "new", 2)], "id long, tier string, part long")
    assert [r.part for r in sinks.update_partitioned(spark, path, changes, ["id"], "tier", "part").collect()] == [3]
    after = files()
    assert {f for f in before if "part=3" not in f} == {f for f in after if "part=3" not in f} and all(after[f] == before[f] for f in before if f in after)
    assert not any(f in after for f in before if "part=3" in f)
    rows = {r.id: r.tier for r in spark.read.parquet(path).collect()}
    assert rows == {i: "new" if i == 3 else "old" for i in range(100)}


def test_a_federated_table_is_filtered_and_split_at_its_source(spark):
    store = dict(Tables(spark, "/root/testdata/sf0.001").treatment_store)
    url = store.pop("url")
    names = tables.jdbc_table(spark, url, "treatments", by="treatment_id", parts=3, **store)
    assert names.rdd.getNumPartitions() == 3 and names.count() == 20
    live = names.where("status = 'live'").select("name")
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(STATUS), *EqualTo(STATUS,live)]".lower() in plan.lower() and live.count() == 10
    top = tables.jdbc_lookup(spark, url, 'SELECT "status", COUNT(*) AS n FROM treatments GROUP BY "status"', **store)
    assert {tuple(r) for r in top.collect()} == {("live", 10), ("retired", 10)}


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from slotwise.functions import indexing

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = spark.conf

    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(RuntimeError, match="checkpoint.dir"):
            indexing.shared_folder(Session())


def test_treatment_lists_of_any_length(spark, monkeypatch):
    """Cut into many arrays, the list gives the same draws as in one."""
    from slotwise.operators import bandit

    users = spark.range(60).withColumnRenamed("id", "user_id")
    treatments = spark.range(37).withColumnRenamed("id", "treatment_id")
    posterior = treatments.select("treatment_id", (F.col("treatment_id") / 100).alias("mean"), F.lit(0.1).alias("stddev")).where("treatment_id < 30")
    one = sorted(map(tuple, bandit.thompson_assign(users, treatments, posterior, 5).collect()))
    monkeypatch.setattr(bandit, "TREATMENT_BLOCK", 4)
    assert sorted(map(tuple, bandit.thompson_assign(users, treatments, posterior, 5).collect())) == one
    assert len({t for _, t, _ in one}) > 5


def test_the_board_is_one_pass(spark):
    from slotwise.operators import quality

    long = spark.createDataFrame([(1, 1, "A", 10.0, "https://x"), (1, 2, "A", 20.0, "http://x"), (1, 3, "B", 5.0, None), (2, 1, "C1B", 30.0, "https://x"), (2, 2, "D", 30.0, "https://x"), (2, 3, "E", 30.0, "https://x"), (2, 4, "F", 1.0, "https://x")],
                                 "user_id int, slot int, sku string, price double, image_url string")
    catalog = spark.createDataFrame([("A", "x"), ("B", "x"), ("C1B", "y"), ("D", "y"), ("E", "y")], "sku string, category string")
    bought = spark.createDataFrame([(2, "C1"), (1, "C1"), (9, "A")], "user_id int, sku string")
    facts = quality.board_facts(long, bought, catalog, ["user_id"], 6.0, 2, 3)
    assert tuple(facts.first()) == (1, 1, 2, 2, 1, 83.33)
    rows = quality.check_rows(facts, [("bought", "purchased", "CRITICAL", 0, False), ("with_min", "n", "LOW", 0, True)]).collect()
    assert [(r.check, r.value, r.status) for r in rows] == [("purchased", 1.0, "FAIL"), ("n", 1.0, "INFO")]
    none = quality.check_rows(quality.board_facts(long.limit(0), bought, catalog, ["user_id"], 6.0, 2, 3), [("bought", "purchased", "CRITICAL", 0, False)]).first()
    assert (none.value, none.status) == (0.0, "PASS")


def test_quantiles_are_exact_on_many_values(spark):
    """Places of the discrete quantile, where a sketch of 10,000 samples is off."""
    from slotwise.operators import campaign as K

    n = 200_001
    rows = spark.range(n).select((F.col("id") % 2000).alias("user_id"), F.floor(F.col("id") / 2000).alias("treatment_id"), F.pmod(F.xxhash64("id"), F.lit(10**7)).alias("m"))
    sent = F.timestamp_seconds(F.lit(1_700_000_000))
    sends = rows.select("user_id", "treatment_id", sent.alias("sent_ts"))
    acts = rows.select("user_id", "treatment_id", F.lit("VIEWED").alias("type"), F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("m") + 1) * 60).alias("ts"))
    want = sorted(r.m + 1 for r in rows.select("m").collect())[-(-n // 2) - 1]
    assert K.time_to_action(sends, acts).first().median_minutes == want
    times = rows.select(F.timestamp_micros(F.col("m")).alias("ts"))
    train, test = E.time_split(times, "ts", 0.8)
    cut = sorted(r.m for r in rows.select("m").collect())[-(-n * 4 // 5) - 1]
    assert train.count() == rows.where(F.col("m") < cut).count() and test.count() == n - train.count()


def test_distinct_scores_are_rounded_as_sql_rounds(spark):
    import duckdb

    from slotwise.operators import bandit as B

    values = [i / 100000 for i in range(5, 20000, 10)]
    rows = spark.createDataFrame([("d", "a", v) for v in values], "send_date string, arm string, score double")
    want = duckdb.sql("SELECT count(DISTINCT round(i / 100000.0::DOUBLE, 4)) FROM range(5, 20000, 10) t(i)").fetchall()[0][0]
    assert want < len(values) and B.score_drift(rows).first().distinct_scores == want


def test_candidates_are_counted_without_pairs(spark):
    own = spark.createDataFrame([(u, e) for u in range(60) for e in {u % 3, u % 2, 9}] + [(1, 1), (77, 8)], "user_id int, entity_id int")
    fit = spark.createDataFrame([(p % 3, p) for p in range(50)] + [(1, 2), (1, 1), (9, 4)], "entity_id int, product_id int")
    products = spark.createDataFrame([(p, p % 10 == 7) for p in range(48)], "product_id int, is_excluded boolean")
    want = {r.user_id: r["count"] for r in C.entity_candidates(own, fit, products).groupBy("user_id").count().collect()}
    assert {r.user_id: r.candidates for r in C.candidate_totals(own, fit, products).collect()} == want


def _entity_tables(spark, users=30, products=60):
    """Users of one to three entities (one of none), products of one or two, a tenth excluded, twins with equal vectors, bags of a third."""
    rnd = random.Random(3)
    vec = lambda: [float(rnd.randint(-4, 4)) for _ in range(3)]
    own = [(u, e) for u in range(users - 1) for e in rnd.sample(range(4), 1 + u % 3)]
    fit = [(e, p) for p in range(products) for e in rnd.sample(range(4), 1 + p % 2)]
    prods = [(p, f"g{p % 4}", p % 10 == 9, p % 3 if p % 2 else None) for p in range(products)]
    uv, pv = [(u, vec(), u % 3) for u in range(users)], [(p, vec()) for p in range(products // 2)]
    pv += [(p + products // 2, v) for p, v in pv]
    df = lambda rows, kind: spark.createDataFrame(rows, kind)
    frames = (df(own, "user_id long, entity_id int"), df(fit, "entity_id int, product_id long"), df(prods, "product_id long, grp string, is_excluded boolean, bag int"),
              df(uv, "user_id long, vec array<double>, bag int"), df(pv, "product_id long, vec array<double>"))
    of = {p: {e for e, q in fit if q == p} for p in range(products)}
    pairs = {(u, p) for u in range(users) for p in of if not prods[p][2] and of[p] & {e for v, e in own if v == u}}
    dot = {(u, p): sum(a * b for a, b in zip(uv[u][1], pv[p][1])) for u, p in pairs}
    return frames, prods, pairs, dot


@pytest.mark.parametrize("tile", [4])
def test_candidate_scores_in_tiles_equal_all_pairs(spark, tile):
    """Tiles of bounded size give every pair once with its score, and the first of every group without the bags."""
    (own, fit, products, uv, pv), prods, pairs, dot = _entity_tables(spark)
    assert {(r.user_id, r.product_id) for r in C.entity_candidates(own, fit, products).collect()} == pairs
    got = [tuple(r) for r in C.pair_scores(own, fit, products, uv, pv, tile).collect()]
    assert sorted(got) == sorted((u, p, s) for (u, p), s in dot.items())
    want = []
    for u in range(30):
        for g in range(4):
            rows = sorted((-s, p) for (v, p), s in dot.items() if v == u and prods[p][1] == f"g{g}" and prods[p][3] != u % 3)
            want += [(u, f"g{g}", p, -s) for s, p in rows[:2]]
    got = C.best_of_groups(own, fit, products, uv, pv, "grp", 2, "bag", tile)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_candidate_pairs_are_not_shuffled(spark):
    """What J16 and D50 shuffle is rows of the two sides; the old distinct and the join of vectors shuffled every pair."""
    (own, fit, products, uv, pv), *_ = _entity_tables(spark)
    for frame in (C.two_hop(own, fit), C.pair_scores(own, fit, products, uv, pv)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        top = plan[:plan.index("Join") if "Join" in plan and "CoGroup" not in plan else plan.index("CoGroup")]
        assert "Aggregate" not in top and "Join" not in top


def test_fallback_by_bags_equals_fallback_by_pairs(spark):
    """Purchases told per class of users fill the same slots as the same purchases told pair by pair."""
    from slotwise.operators import slots as S
    rnd = random.Random(9)
    df = lambda rows, kind: spark.createDataFrame(rows, kind)
    products = df([(p, f"c{p % 3}", float(rnd.randint(0, 9)), p % 11 == 0) for p in range(80)], "product_id long, category string, popularity double, is_excluded boolean")
    fit = df([(e, p) for p in range(80) for e in rnd.sample(range(4), 1 + p % 2)], "entity_id int, product_id long")
    entities = df([(0, "A"), (1, "A"), (2, "B"), (3, None)], "entity_id int, group_id string")
    users = df([(u,) for u in range(40)], "user_id long")
    owner = df([(u, e) for u in range(36) for e in rnd.sample(range(4), 1 + u % 2)], "user_id long, entity_id int")
    pools = S.popularity_pools(products, fit, entities)
    recs = df([(u, s + 1, p, f"c{p % 3}", 1.0) for u in range(40) for s, p in enumerate(rnd.sample(range(80), u % 5))], "user_id long, slot int, product_id long, category string, score double")
    bags = df([(b, p) for p in range(80) for b in range(5) if rnd.random() < (.95 if b == 4 else .4)], "bag int, product_id long")
    has = df([(u, b) for u in range(38) for b in rnd.sample(range(5), u % 3)], "user_id long, bag int")
    by_pairs = S.popularity_fallback(recs, users, owner, entities, pools, has.join(bags, "bag").select("user_id", "product_id").distinct())
    by_bags = S.popularity_fallback(recs, users, owner, entities, pools, has, bags=bags)
    rows = lambda f: sorted(tuple(r) for r in f.select("user_id", "slot", "product_id", "category", "is_fallback").collect())
    assert rows(by_bags) == rows(by_pairs) and sum(r[4] for r in rows(by_bags)) > 40


def test_baskets_come_from_one_pass_without_a_table_of_rows(spark):
    """The rows are read once and no aggregate is keyed by group and item; repeats, nulls and oversized groups as before."""
    from slotwise.operators import copurchase as CP

    n = spark.range(3000)
    rows = n.select((F.col("id") % 3).alias("order_id"), F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") % 12)).alias("sku"))
    rows = rows.union(spark.sql("SELECT * FROM VALUES (7L, 's1'), (7L, null), (8L, 's1'), (null, 's2'), (null, 's5')"))
    out = CP.copurchase_basket(rows, 2, 10, ("order_id",), 1)
    found = {(r.item_a, r.item_b): r.pair_count for r in out.collect()}
    ones, twos = sorted(f"s{i}" for i in (1, 4, 7, 10)), sorted(f"s{i}" for i in (2, 5, 8, 11))
    assert found == {(a, b): 1 for g in (ones, twos) for i, a in enumerate(g) for b in g[i + 1:]}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and "Aggregate [order_id#" in plan and "LeftSemi" not in plan
