"""Greedy and pruned operators against plain Python models."""

import random

import pytest
from pyspark.sql import functions as F

from slotwise.operators import ranking as R
from slotwise.operators import slots as S


def model_top(cands, excluded, boosts, cap):
    """Every user x product row: exclude, boost, dedup by base, cap per category."""
    rows = [(round(s + boosts.get(sku, 0.0), 2), sku, base, cat) for sku, base, cat, s in cands if sku not in excluded]
    rows.sort(key=lambda r: (-r[0], r[1]))
    seen, count, out = set(), {}, []
    for score, sku, base, cat in rows:
        if base in seen:
            continue
        seen.add(base)
        if count.get(cat, 0) < cap:
            count[cat] = count.get(cat, 0) + 1
            out.append((sku, score))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pruned_ranking_equals_full_ranking(spark, seed):
    rnd = random.Random(seed)
    profiles = ["p0", "p1"]
    cands = {p: [(f"s{b}-{v}", f"b{b}", f"c{rnd.randint(0, 3)}", float(rnd.randint(0, 12))) for b in range(25) for v in range(rnd.randint(1, 3))] for p in profiles}
    users = [(u, rnd.choice(profiles)) for u in range(30)]
    skus = sorted({c[0] for p in profiles for c in cands[p]})
    excluded = {u: set(rnd.sample(skus, rnd.choice([0, 1, 4, 15]))) for u, _ in users}
    boosts = {u: {s: float(rnd.randint(1, 20)) for s in rnd.sample(skus, rnd.choice([0, 0, 2]))} for u, _ in users}
    udf = spark.createDataFrame(users, "user_id int, prof string")
    sdf = spark.createDataFrame([(p, *c, c[0]) for p in profiles for c in cands[p]], "prof string, sku string, base_sku string, category string, final_score double, norm_sku string")
    xdf = spark.createDataFrame([(u, s) for u in excluded for s in excluded[u]], "user_id int, sku string")
    bdf = spark.createDataFrame([(u, s, b) for u in boosts for s, b in boosts[u].items()], "user_id int, sku string, boost double")
    got = {}
    for r in R.diversified_for_users(udf, sdf, ["prof"], 2, xdf, bdf).collect():
        got.setdefault(r.user_id, []).append((r.sku, r.final_score))
    for u, p in users:
        assert sorted(got.get(u, [])) == model_top(cands[p], excluded[u], boosts[u], 2), u


@pytest.mark.parametrize("seed", [4, 5])
def test_first_rows_of_the_pruned_ranking_equal_the_full_ranking(spark, seed):
    """The first three of a user in each pool; far fewer rows are fetched than categories have winners."""
    rnd = random.Random(seed)
    cands = {p: [(f"s{b}-{v}", f"b{b}", f"c{rnd.randint(0, 25)}", float(rnd.randint(0, 12))) for b in range(120) for v in range(rnd.randint(1, 3))] for p in ("p0", "p1")}
    pool = {c[0]: rnd.choice("xy") for p in cands for c in cands[p]}
    users = [(u, rnd.choice(["p0", "p1"])) for u in range(30)]
    skus = sorted(pool)
    excluded = {u: set(rnd.sample(skus, rnd.choice([0, 0, 1, 4, 40]))) for u, _ in users}
    boosts = {u: {s: float(rnd.randint(1, 20)) for s in rnd.sample(skus, rnd.choice([0, 0, 2]))} for u, _ in users}
    udf = spark.createDataFrame(users, "user_id int, prof string")
    sdf = spark.createDataFrame([(p, *c, c[0], pool[c[0]]) for p in cands for c in cands[p]], "prof string, sku string, base_sku string, category string, final_score double, norm_sku string, pool string")
    xdf = spark.createDataFrame([(u, s) for u in excluded for s in excluded[u]], "user_id int, sku string")
    bdf = spark.createDataFrame([(u, s, b) for u in boosts for s, b in boosts[u].items()], "user_id int, sku string, boost double")
    for name in (None, "pool"):
        out = R.diversified_for_users(udf, sdf, ["prof"], 2, xdf, bdf, top=3, pool=name).collect()
        got = {}
        for r in sorted(out, key=lambda r: (-r.final_score, r.sku)):
            rows = got.setdefault((r.user_id, r.pool if name else ""), [])
            if len(rows) < 3:
                rows.append((r.sku, r.final_score))
        for u, prof in users:
            want = sorted(model_top(cands[prof], excluded[u], boosts[u], 2), key=lambda r: (-r[1], r[0]))
            for x in "xy" if name else ("",):
                assert got.get((u, x), []) == [r for r in want if not x or pool[r[0]] == x][:3], (u, x)
        quiet = [u for u, _ in users if not excluded[u] and not boosts[u]]
        assert all(sum(r.user_id == u for r in out) <= 6 for u in quiet)


def test_best_rows_left_equal_all_pairs(spark):
    from slotwise.operators import candidates as C

    rnd = random.Random(8)
    rows = [(p, c, f"s{i}", f"n{i // 2}", float(rnd.randint(0, 9))) for p in ("p0", "p1") for c in ("a", "b", "c", "d") for i in (rnd.sample(range(24), 7))]
    rows = list({(r[0], r[2]): r for r in rows}.values())
    related = [("a", "b"), ("a", "c"), ("b", "a"), ("c", "d")]
    users = [(u, rnd.choice(["p0", "p1"]), rnd.choice("abc")) for u in range(40)]
    gone = {(u, f"n{i}") for u, _, _ in users for i in rnd.sample(range(12), rnd.choice([0, 1, 6, 12]))}
    boosts = {(u, f"s{i}"): float(rnd.randint(-3, 9)) for u, _, _ in users for i in rnd.sample(range(24), rnd.choice([0, 3]))}
    udf = spark.createDataFrame(users, "user_id int, prof string, primary_category string")
    rdf = spark.createDataFrame(rows, "prof string, category string, sku string, norm_sku string, final_score double")
    gdf = spark.createDataFrame(sorted(gone), "user_id int, norm_sku string")
    bdf = spark.createDataFrame([(*k, v) for k, v in boosts.items()], "user_id int, sku string, intent double")
    left = {u: [r for r in rows if r[0] == prof and (u, r[3]) not in gone] for u, prof, _ in users}
    out = C.best_left(udf, rdf, gdf, ["prof"], "norm_sku", high=[F.desc("final_score"), F.asc("sku")], low=[F.asc("sku")])
    got = {r.user_id: (r.n, r.high.sku, r.low.sku) for r in out.collect()}
    assert got == {u: (len(x), min(x, key=lambda r: (-r[4], r[2]))[2], min(r[2] for r in x)) for u, x in left.items() if x}
    out = C.related_best(udf, rdf, spark.createDataFrame(related, "primary_category string, related_category string"), bdf, gdf, ["prof"])
    got = {r.user_id: (r.n, r.best) for r in out.collect()}
    want = {}
    for u, _, c in users:
        x = [r[4] + 25 + boosts.get((u, r[2]), 0.0) for r in left[u] if (c, r[1]) in related]
        if x:
            want[u] = (len(x), max(x))
    assert got == want


def greedy(rows, fit_slots, special_slots, total, cap):
    out, count = [], {}

    def take(r, phase):
        pid, cat = r[0], r[1]
        if any(o[0] == pid for o in out) or count.get(cat, 0) >= cap:
            return False
        count[cat] = count.get(cat, 0) + 1
        out.append((pid, phase))
        return True

    for phase, most, ok in ((1, fit_slots, lambda r: r[3]), (2, special_slots, lambda r: r[4] and not r[3]), (3, total, lambda r: True)):
        n = 0
        for r in rows:
            if n >= most or len(out) >= total:
                break
            if ok(r) and take(r, phase):
                n += 1
    return out


@pytest.mark.parametrize("fit,special,cap", [(4, 0, 2), (2, 2, 2), (2, 1, 1), (0, 3, 2), (3, 1, 4)])
def test_slot_select_equals_greedy(spark, fit, special, cap):
    rnd = random.Random(fit * 10 + special)
    data, want = [], {}
    for u in range(25):
        rows = [(i, f"c{rnd.randint(0, 4)}", float(rnd.randint(0, 1000)) + i / 100, rnd.random() < 0.4, rnd.random() < 0.4) for i in range(rnd.choice([0, 2, 6, 40]))]
        data += [(u, *r) for r in rows]
        want[u] = greedy(sorted(rows, key=lambda r: (-r[2], r[0])), fit, special, 4, cap)
    df = spark.createDataFrame(data, "user_id int, product_id long, category string, score double, is_fitment boolean, is_special boolean")
    got = {}
    for r in S.slot_select(df, fit, special, 4, cap).orderBy("user_id", "slot").collect():
        got.setdefault(r.user_id, []).append((r.product_id, r.phase))
    assert got == {u: w for u, w in want.items() if w}


def test_fallback_equals_walk(spark):
    rnd = random.Random(11)
    cat = {i: f"c{rnd.randint(0, 3)}" for i in range(40)}
    pop = {i: float(rnd.randint(0, 500)) + i / 100 for i in range(40)}
    ent = {i: i % 5 for i in range(36)}  # products 36-39 fit nothing
    group = {0: "A", 1: "A", 2: "B", 3: "B", 4: None}
    excluded_products = {3, 4}
    users = list(range(12))
    own = {u: sorted(rnd.sample(range(5), rnd.choice([0, 1, 2]))) for u in users}
    recs = {u: rnd.sample(range(40), rnd.choice([0, 1, 2, 4])) for u in users}
    bought = {u: set(rnd.sample(range(40), rnd.choice([0, 5, 20]))) - set(recs[u]) for u in users}

    def by_pop(ids):
        return sorted((i for i in set(ids) if i not in excluded_products), key=lambda i: (-pop[i], i))

    want = {}
    for u in users:
        out = list(recs[u])
        count = {}
        for i in out:
            count[cat[i]] = count.get(cat[i], 0) + 1
        groups = sorted({group[e] for e in own[u] if group[e]})
        pools = [by_pop(i for i in ent if ent[i] == e) for e in own[u]]
        pools += [by_pop(i for i in ent if group[ent[i]] == g) for g in groups] + [by_pop(ent)]
        for pool in pools:
            for i in pool:
                if len(out) >= 4:
                    break
                if i in out or i in bought[u] or count.get(cat[i], 0) >= 2:
                    continue
                out.append(i)
                count[cat[i]] = count.get(cat[i], 0) + 1
        want[u] = out
    products = spark.createDataFrame([(i, cat[i], pop[i], i in excluded_products) for i in range(40)], "product_id long, category string, popularity double, is_excluded boolean")
    fitment = spark.createDataFrame([(i, e) for i, e in ent.items()], "product_id long, entity_id int")
    entities = spark.createDataFrame([(e, g) for e, g in group.items()], "entity_id int, group_id string")
    rdf = spark.createDataFrame([(u, k + 1, i, cat[i], 1.0) for u in users for k, i in enumerate(recs[u])], "user_id int, slot int, product_id long, category string, score double")
    pools = S.popularity_pools(products, fitment, entities)
    full = S.popularity_fallback(
        rdf, spark.createDataFrame([(u,) for u in users], "user_id int"), spark.createDataFrame([(u, e) for u in users for e in own[u]], "user_id int, entity_id int"), entities, pools,
        spark.createDataFrame([(u, i) for u in users for i in bought[u]], "user_id int, product_id long"))
    got = {}
    for r in full.orderBy("user_id", "slot").collect():
        got.setdefault(r.user_id, []).append(r.product_id)
    assert got == {u: w for u, w in want.items() if w}
    meta = products.where("product_id <> 5").selectExpr("product_id", "'n' AS name", "'u' AS url", "'i' AS image_url", "2.5D AS price")
    rows = S.provenance(full, meta, 4, "v").collect()
    assert all((r[f"rec{i}_name"], r[f"rec{i}_price"]) == ((None, None) if i > r.rec_count else ("", 0.0) if r[f"rec{i}_product_id"] == 5 else ("n", 2.5)) for r in rows for i in range(1, 5))
    row = next(r for r in rows if r.user_id == 0)
    assert row.rec_count == len(want[0]) and row.fallback_start_idx == (len(recs[0]) if len(recs[0]) < len(want[0]) else row.rec_count)


def pool_rows(spark, fit, uni):
    rows = [(1, f"f{i}", "fitment", 10.0 - i) for i in range(fit)] + [(1, f"u{i}", "universal", 20.0 - i) for i in range(uni)]
    return spark.createDataFrame(rows, "user_id int, sku string, product_type string, final_score double")


@pytest.mark.parametrize("fit,uni,want", [
    (5, 5, ["f0", "f1", "u0", "u1"]), (1, 5, ["f0", "u0", "u1", "u2"]), (0, 5, ["u0", "u1", "u2", "u3"]), (5, 0, ["f0", "f1", "f2", "f3"]), (1, 2, []), (3, 1, ["f0", "f1", "f2", "u0"])])
def test_reserved_slots(spark, fit, uni, want):
    out = R.reserved_slots(pool_rows(spark, fit, uni)).orderBy("rn").collect()
    assert [r.sku for r in out] == want


def test_wide_and_back(spark):
    from slotwise.params import RecParams
    rows = [(1, 1, "a", 10.0, 3.0), (1, 2, "b", 20.0, 2.0), (1, 3, "c", 30.0, 1.0), (2, 1, "a", 10.0, 1.0)]
    df = spark.createDataFrame(rows, "user_id int, rn int, sku string, price double, final_score double").withColumn("image_url", F.lit("https://x")).withColumn("popularity_source", F.lit("make"))
    wide = R.wide_output(df, ["user_id"], RecParams())
    r = wide.collect()
    assert len(r) == 1 and r[0].rec3_sku == "c" and r[0].rec4_sku is None and r[0].rec_count == 3
    assert [(x.slot, x.sku) for x in R.wide_to_long(wide, ["user_id"], floor=15.0).collect()] == [(2, "b"), (3, "c")]


def test_pick_user_per_key(spark):
    rows = [("k", 1, 5.0), ("k", 1, 4.0), ("k", 2, 9.0), ("k", 3, 5.0), ("k", 3, 4.0)]
    df = spark.createDataFrame(rows, "email string, user_id int, final_score double")
    assert {r.user_id for r in R.pick_user_per_key(df, ["email"]).collect()} == {1}


def test_winners_are_exact_to_the_asked_depth(spark):
    """Nearly all first rows of category a lose to a variant in b, so the first cut leaves too few winners and is deepened."""
    rows = [("p", f"a{i}", f"b{i}", "a", 100.0 - i) for i in range(60)] + [("p", f"z{i}", f"b{i}", "b", 200.0 - i) for i in range(55)] + [("p", "solo", "solo", None, 1.0)]
    df = spark.createDataFrame(rows, "prof string, sku string, base_sku string, category string, final_score double")
    out = R.winners_to_depth(df, ["prof"], 3, start=4).collect()
    got = {c: [r.sku for r in sorted(out, key=lambda r: r.depth) if r.category == c and r.depth <= 3] for c in ("a", "b", None)}
    assert got == {"a": ["a55", "a56", "a57"], "b": ["z0", "z1", "z2"], None: ["solo"]}


@pytest.mark.parametrize("seed", [1, 2])
def test_slots_by_primary_category_equal_the_full_ranking(spark, seed):
    """D40 from rows that are stored once per make, against every user x product row."""
    rnd = random.Random(seed)
    cats, models = "abcd", ("x", "y")
    base = [("m", f"s{b}-{v}", f"b{b}", rnd.choice(cats), float(rnd.randint(0, 12)), list(models)) for b in range(40) for v in range(rnd.randint(1, 3))]
    related = [("a", "b"), ("a", "c"), ("b", "a"), ("c", "d")]
    users = [(u, "m", rnd.choice(models), *rnd.choice([("a", True), ("b", True), ("c", True), ("d", True), ("COLD_START", False)])) for u in range(30)]
    skus = sorted(r[1] for r in base)
    gone = {(u[0], s) for u in users for s in rnd.sample(skus, rnd.choice([0, 1, 5, 30]))}
    boosts = {(u[0], s): float(rnd.randint(1, 9)) for u in users if u[4] for s in rnd.sample(skus, rnd.choice([0, 3]))}

    def kind(primary, active, cat):
        if not active:
            return "cold_start", 0, 0
        return ("primary", 0, 50) if cat == primary else ("related", 1, 25) if (primary, cat) in related else None

    score = lambda model, s: s + (1.0 if model == "y" else 0.0)
    want = set()
    for u, _, model, primary, active in users:
        rows = [(k[1], -(score(model, s) + k[2] + boosts.get((u, sku), 0.0)), sku, b, cat, k[0]) for _, sku, b, cat, s, _ in base
                if (u, sku) not in gone and (k := kind(primary, active, cat))]
        seen, count, taken = set(), {}, {}
        for r in sorted(rows):
            if r[3] not in seen:
                seen.add(r[3])
                count[r[4]] = count.get(r[4], 0) + 1
                if count[r[4]] <= 2:
                    taken.setdefault(r[5], []).append(r)
        for name, rs in taken.items():
            want |= {(u, i + (3 if name == "related" else 1), r[2]) for i, r in enumerate(sorted(rs, key=lambda r: (r[1], r[2]))[:4 if name == "cold_start" else 2])}
    scored = spark.createDataFrame(base, "make string, sku string, base_sku string, category string, s double, _m array<string>").withColumns(
        {"norm_sku": F.col("sku"), "models": F.transform("_m", lambda m: F.struct(m.alias("model")))}).drop("_m")
    finish = lambda df: df.withColumn("final_score", F.col("s") + (F.col("model") == "y").cast("double")).drop("s")
    kinds = [("m", model, pc, active, c, *k) for model in models for pc, active in (("a", True), ("b", True), ("c", True), ("d", True), ("COLD_START", False)) for c in cats if (k := kind(pc, active, c))]
    out = R.slotted_for_users(
        spark.createDataFrame(users, "user_id int, make string, model string, primary_category string, active boolean"), scored, ["make", "model"],
        spark.createDataFrame(kinds, "make string, model string, primary_category string, active boolean, category string, slot_type string, slot_priority int, _plus int"), 2,
        spark.createDataFrame(sorted(gone), "user_id int, sku string"), spark.createDataFrame([(*k, v) for k, v in boosts.items()], "user_id int, sku string, boost double"),
        (("slot_priority", True), *R.BY_SCORE), 4, R.Spread("models", ("model",), finish))
    assert {(r.user_id, r.slot, r.sku) for r in R.slot_allocation(out).collect()} == want
