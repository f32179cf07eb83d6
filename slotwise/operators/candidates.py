"""Who may get which product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..functions.indexing import durable, rank_in_order
from ..functions.keyed import shared, top_n_per_key
from ..params import RecParams
from .popularity import event_orders

CATEGORY_MATCH = 50.0
CATEGORY_UNIVERSAL = 25.0


def primary_category(users: DataFrame, staged: DataFrame, catalog: DataFrame) -> DataFrame:
    """Category of the user's last event (UNIVERSAL if unknown); users without events are COLD_START."""
    cat = catalog.groupBy("sku").agg(F.max("category").alias("category"))
    last = staged.groupBy("user_id").agg(
        F.max_by("sku", F.struct("event_ts", "sku")).alias("sku"), F.max("event_ts").alias("last_ts"))
    last = last.join(cat, "sku", "left").select(
        "user_id", F.coalesce(F.nullif(F.trim("category"), F.lit("")), F.lit("UNIVERSAL")).alias("primary_category"),
        "last_ts", F.lit(True).alias("active"))
    cold = users.select("user_id").join(last.select("user_id"), "user_id", "left_anti").select(
        "user_id", F.lit("COLD_START").alias("primary_category"), F.lit(None).cast("timestamp").alias("last_ts"),
        F.lit(False).alias("active"))
    return last.unionByName(cold)


def category_score(category, primary):
    """Points for matching the user's category."""
    return (F.when(X.col(category) == X.col(primary), CATEGORY_MATCH)
            .when(X.col(category) == "UNIVERSAL", CATEGORY_UNIVERSAL).otherwise(0.0))


def purchase_exclusion(staged: DataFrame, imported: DataFrame, users: DataFrame, p: RecParams) -> DataFrame:
    """Distinct (user_id, sku) bought in the exclusion window, by events or imported orders, variant-normalised."""
    first, last = F.lit(p.excl_start).cast("date"), F.lit(p.excl_end).cast("date")
    seen = event_orders(staged.where(F.to_date("event_ts").between(first, last))).distinct()
    feed = imported.where(F.col("order_date").between(first, last))
    feed = feed.select("email", X.normalize_variant("sku").alias("sku")).distinct()
    bought = feed.join(users.select("user_id", "email"), "email").select("user_id", "sku")
    return seen.where("user_id is not null").unionByName(bought).distinct()


def with_second_vehicle(users: DataFrame, second: DataFrame) -> DataFrame:
    """Primary vehicle plus the second one, if any, and a flag."""
    return users.join(second, "user_id", "left").withColumn("has_second", F.col("second_make").isNotNull())


def fitment_candidates(users: DataFrame, eligible: DataFrame, on: dict[str, str]) -> DataFrame:
    """Parts that fit the user's vehicle; ``on`` maps user columns to part columns."""
    parts = eligible
    for mine, theirs in on.items():
        parts = parts.withColumnRenamed(theirs, mine)
    return users.join(parts, list(on))


def explode_pool(rows: DataFrame, pool: DataFrame, n: int) -> DataFrame:
    """Every row paired with a pool of at most n products.

    The pool is reduced to one bounded array (a scalar subquery) and exploded, so neither
    side is shuffled and no cartesian join is planned.
    """
    top = pool.orderBy("pool_rank").limit(n)
    arr = top.agg(F.sort_array(F.collect_list(F.struct("pool_rank", *[c for c in pool.columns if c != "pool_rank"])))).scalar()
    return rows.withColumn("_p", F.explode(arr)).select(*rows.columns, "_p.*")


def segment_popular_profiles(profiles: DataFrame, segments: DataFrame, products: DataFrame, fitment_scored: DataFrame,
                             segment, profile) -> DataFrame:
    """D31 at profile level: products popular in the segment that are not among its fitment candidates."""
    rows = profiles.join(segments, list(segment)).join(products, "sku")
    return rows.join(fitment_scored.select(*profile, "sku"), [*profile, "sku"], "left_anti")


def related_categories(primary: DataFrame, category_pairs: DataFrame) -> DataFrame:
    """Categories that share baskets with the user's category.

    The either-side condition becomes a union of both directions and one equi-join.
    """
    both = category_pairs.select(F.col("item_a").alias("primary_category"), F.col("item_b").alias("related_category")) \
        .unionByName(category_pairs.select(F.col("item_b").alias("primary_category"), F.col("item_a").alias("related_category")))
    return primary.where(F.col("active") & (F.col("primary_category") != "UNIVERSAL")).select(
        "user_id", "primary_category").join(both.distinct(), "primary_category")


def first_untaken(taken: DataFrame, keys, pos: str) -> DataFrame:
    """Per key the first position of a list 1, 2, ... that is not taken. ``taken``: keys and ``pos``, distinct."""
    w = Window.partitionBy(*keys).orderBy(pos)
    # the nth taken position is at least n, and equal to n as long as the list has no gap
    return taken.withColumn("_n", F.row_number().over(w)).groupBy(*keys).agg((F.count_if(F.col(pos) == F.col("_n")) + 1).alias(pos))


def best_left(users: DataFrame, rows: DataFrame, gone: DataFrame, profile, on: str, **orders) -> DataFrame:
    """D31/D33 per user: how many rows of the profile are left without the ``gone`` ones (``n``), and the first of them in each order.

    Profile rows are ranked once per profile. A user only brings the rows that are gone, and the first row left is the first gap
    in their positions, so the work follows profile rows plus purchases, not users x products. Users without a row left drop out.
    ``gone``: (user_id, ``on``); each order gives a struct column of its name.
    """
    profile = list(profile)
    payload = F.struct(*[c for c in rows.columns if c not in profile])
    rows = durable(rows)
    for name, order in orders.items():
        rows = durable(rank_in_order(rows, profile, order, f"_{name}"))
    places = [f"_{name}" for name in orders]
    hit = gone.select("user_id", on).distinct().join(users.select("user_id", *profile), "user_id").join(
        rows.select(*profile, on, *places), [*profile, on])
    hit = durable(hit.select("user_id", *places))
    out = users.select("user_id", *profile).join(rows.groupBy(*profile).agg(F.count(F.lit(1)).alias("n")), profile)
    out = out.join(hit.groupBy("user_id").agg(F.count(F.lit(1)).alias("_gone")), "user_id", "left")
    out = out.withColumn("n", F.col("n") - F.coalesce("_gone", F.lit(0))).where("n > 0").drop("_gone")
    for name, place in zip(orders, places):
        out = out.join(first_untaken(hit, ["user_id"], place), "user_id", "left").withColumn(place, F.coalesce(place, F.lit(1)))
        out = out.join(rows.select(*profile, place, payload.alias(name)), [*profile, place]).drop(place)
    return out


def related_best(users: DataFrame, rows: DataFrame, related: DataFrame, boosts: DataFrame, gone: DataFrame, profile) -> DataFrame:
    """D32 per user: rows of the profile in related categories that are not ``gone`` (``n``) and the best of their scores.

    ``users``: user_id, profile, primary_category; ``rows``: profile, category, sku, norm_sku, final_score; ``related``: (primary_category,
    related_category); ``boosts``: (user_id, sku, intent) adds to a score; ``gone``: (user_id, norm_sku). Rows are ranked once per
    (profile, category), categories once per (profile, primary category) by their first row. A user brings the rows touched by
    a purchase or a boost. The best is one of these, or the first untouched row of a category they are in, or the
    first row of the first category without any.
    """
    profile = list(profile)
    group = [*profile, "primary_category"]
    rows = durable(rows.withColumnRenamed("category", "related_category"))
    rows = durable(rank_in_order(rows, [*profile, "related_category"], [F.desc("final_score"), F.asc("sku")], "_r"))
    cats = rows.groupBy(*profile, "related_category").agg(F.count(F.lit(1)).alias("_rows"), F.max("final_score").alias("_top"))
    users = durable(users.select("user_id", *group))
    lists = users.select(*group).distinct().join(related, "primary_category").join(cats, [*profile, "related_category"])
    lists = durable(rank_in_order(lists, group, [F.desc("_top"), F.asc("related_category")], "_c", n=F.sum("_rows")))
    people = users
    cols = ["user_id", *group, "related_category", "sku", "final_score", "_r"]
    out_rows = gone.select("user_id", "norm_sku").distinct().join(people, "user_id").join(rows, [*profile, "norm_sku"]).select(
        *cols, F.lit(True).alias("_gone"), F.lit(None).cast("double").alias("_plus"))
    up_rows = boosts.select("user_id", "sku", "intent").join(people, "user_id").join(rows, [*profile, "sku"]).select(
        *cols, F.lit(False).alias("_gone"), F.col("intent").alias("_plus"))
    hit = out_rows.unionByName(up_rows).groupBy(*cols).agg(F.max("_gone").alias("_gone"), F.max("_plus").alias("_plus"))
    hit = durable(hit.join(lists.select(*group, "related_category", "_c"), [*group, "related_category"]))
    own = hit.groupBy("user_id").agg(F.count_if("_gone").alias("_out"), F.max(F.when(~F.col("_gone"), F.col("final_score") + F.lit(25) + F.col("_plus"))).alias("_own"))
    gap = first_untaken(hit.select("user_id", *profile, "related_category", "_r"), ["user_id", *profile, "related_category"], "_r")
    gap = gap.join(rows.select(*profile, "related_category", "_r", "final_score"), [*profile, "related_category", "_r"]).groupBy("user_id").agg(
        (F.max("final_score") + 25).alias("_gap"))
    clear = first_untaken(hit.select("user_id", "_c").distinct(), ["user_id"], "_c")
    out = people.join(lists.groupBy(*group).agg(F.max("n").alias("n")), group).join(own, "user_id", "left").join(gap, "user_id", "left")
    out = out.join(clear, "user_id", "left").withColumn("_c", F.coalesce("_c", F.lit(1))).join(
        lists.select(*group, "_c", (F.col("_top") + 25).alias("_first")), [*group, "_c"], "left")
    out = out.withColumn("n", F.col("n") - F.coalesce("_out", F.lit(0))).where("n > 0")
    return out.select("user_id", "n", F.round(F.greatest("_own", "_gap", "_first"), 2).alias("best"))


def entity_candidates(ownership: DataFrame, fitment: DataFrame, products: DataFrame) -> DataFrame:
    """Products of all owned entities without the excluded ones, as (user, product)."""
    ok = products.where(~F.col("is_excluded")).select("product_id")
    return two_hop(ownership, fitment.join(ok, "product_id", "left_semi"))


def owned_sets(ownership: DataFrame) -> DataFrame:
    """user_id, ``_set``: the sorted entities of every user. Users of one set have the same products."""
    return ownership.groupBy("user_id").agg(F.sort_array(F.collect_set("entity_id")).alias("_set"))


def set_products(sets: DataFrame, fitment: DataFrame) -> DataFrame:
    """Distinct (``_set``, product) of every distinct set of entities."""
    fit = fitment.select("entity_id", "product_id").distinct()
    return sets.select("_set").distinct().withColumn("entity_id", F.explode("_set")).join(fit, "entity_id").select("_set", "product_id").distinct()


def tiles(users: DataFrame, products: DataFrame, on: str, tile: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a many-to-many join on ``on``, cut into blocks ``_i`` of users and ``_j`` of products of about ``tile`` rows.

    Every row goes to each block of the other side, so a key that holds all users becomes many tiles of bounded size, and
    what is shuffled is rows x blocks, never pairs.
    """
    blocks = lambda df, out: df.groupBy(on).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias(out))
    sizes = blocks(users, "_us").join(blocks(products, "_ps"), on)
    place = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = users.join(sizes, on).withColumn("_i", place("user_id", "_us")).withColumn("_j", every("_ps"))
    right = products.join(sizes, on).withColumn("_j", place("product_id", "_ps")).withColumn("_i", every("_us"))
    return left.drop("_us", "_ps"), right.drop("_us", "_ps")


def candidate_totals(ownership: DataFrame, fitment: DataFrame, products: DataFrame) -> DataFrame:
    """Number of ``entity_candidates`` per user (only users with any). Users of one set of entities have the same products,
    so products are counted once per distinct set and no (user, product) rows are made."""
    ok = products.where(~F.col("is_excluded")).select("product_id")
    owned = owned_sets(ownership)
    per = set_products(owned, fitment.join(ok, "product_id", "left_semi")).groupBy("_set").agg(F.count(F.lit(1)).alias("candidates"))
    return owned.join(per, "_set").select("user_id", "candidates")


def unfitted_users(users: DataFrame, candidates: DataFrame) -> DataFrame:
    """Users without entity products; their candidates are all products that are not excluded.

    That set is never written out per user: ``top_k_by_vector`` scores it block by block.
    """
    return users.join(candidates.select("user_id").distinct(), "user_id", "left_anti")


def two_hop(ownership: DataFrame, fitment: DataFrame) -> DataFrame:
    """Distinct (user, product) reached over any owned entity.

    Products are made distinct once per set of entities, and users meet them tile by tile: a pair is made once and not shuffled.
    """
    owned = owned_sets(ownership)
    left, right = tiles(owned, set_products(owned, fitment), "_set", 4096)
    return left.join(right, ["_set", "_i", "_j"]).select("user_id", "product_id")


def target_users(users: DataFrame, ids: DataFrame | None = None, consent: bool = False) -> DataFrame:
    """Restrict to given ids and/or to users with email consent."""
    if ids is not None:
        users = users.join(ids.select("user_id").distinct(), "user_id", "left_semi")
    return users.where("has_consent") if consent else users


def embedding_score(candidates: DataFrame, user_vecs: DataFrame, product_vecs: DataFrame) -> DataFrame:
    """Inner product of user and product vector for given candidate pairs.

    Rows travel as (user, product) keys; each vector joins on its own key, so AQE may
    broadcast the product side when its measured size allows.
    """
    rows = candidates.join(user_vecs.select("user_id", F.col("vec").alias("_u")), "user_id")
    rows = rows.join(product_vecs.select("product_id", F.col("vec").alias("_v")), "product_id")
    return rows.withColumn("score", X.dot("_u", "_v")).drop("_u", "_v")


def _inner_products(left, right):
    """Slices (first row, matrix) of the inner products of two stacks of vectors, each sum in the order of the components as ``X.dot`` adds up."""
    import numpy as np

    for low in range(0, len(left), 64):
        part = left[low:low + 64]
        s, term = np.zeros((len(part), len(right))), np.empty((len(part), len(right)))
        for a, b in zip(part.T, right.T, strict=True):
            s += np.multiply.outer(a, b, out=term)
        yield low, s


def _best_of_rows(s, k: int):
    """Rows and columns of the k largest of each row, best first; ties go to the smaller column."""
    import numpy as np

    if s.shape[1] > k:  # the kth best and all that tie with it
        row, at = np.nonzero(s >= np.partition(s, -k, axis=1)[:, -k:-k + 1 or None])
    else:
        row, at = (x.ravel() for x in np.indices(s.shape))
    order = np.lexsort((at, -s[row, at], row))
    row, at = row[order], at[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], at[keep]


def _score_tiles(users: DataFrame, products: DataFrame, fields, piece, tile: int, sort: str) -> DataFrame:
    """Rows of ``piece(user rows, product rows, first user row, matrix of scores)`` from all tiles of users and products of one set."""
    import numpy as np
    import pandas as pd

    schema = T.StructType(fields)

    def score(left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({f.name: pd.Series([], dtype=object) for f in fields})
        right = right.sort_values(sort, ignore_index=True)
        u, v = (np.stack(d["vec"].to_numpy()).astype("float64") for d in (left, right))
        return pd.concat([piece(left, right, low, s) for low, s in _inner_products(u, v)], ignore_index=True)

    left, right = tiles(users, products, "_set", tile)
    right = right.withColumnsRenamed({"_set": "_rs", "_i": "_ri", "_j": "_rj"})
    return left.groupBy("_set", "_i", "_j").cogroup(right.groupBy("_rs", "_ri", "_rj")).applyInPandas(score, schema)


def pair_scores(ownership: DataFrame, fitment: DataFrame, products: DataFrame, user_vecs: DataFrame, product_vecs: DataFrame, tile: int = 1024) -> DataFrame:
    """D50 over D51: inner product of user and product vector for all ``entity_candidates``.

    The pairs are the output. They are made and scored inside tiles of users and products of one set of entities, so that vectors
    travel once a tile and no pair is shuffled.
    """
    import numpy as np
    import pandas as pd

    users, rows = _candidate_sides(ownership, fitment, products, user_vecs, product_vecs)
    fields = [T.StructField("user_id", users.schema["user_id"].dataType), T.StructField("product_id", rows.schema["product_id"].dataType), T.StructField("score", T.DoubleType())]

    def piece(left, right, low, s):
        return pd.DataFrame({"user_id": np.repeat(left["user_id"].to_numpy()[low:low + len(s)], s.shape[1]), "product_id": np.tile(right["product_id"].to_numpy(), len(s)), "score": s.ravel()})

    return _score_tiles(users, rows, fields, piece, tile, "product_id")


def _candidate_sides(ownership, fitment, products, user_vecs, product_vecs, *, bag: str | None = None, group: str | None = None):
    """(user_id, _set, vec [, bag]) and (_set, product_id, vec [, bag, group]) of ``entity_candidates``."""
    ok = products.where(~F.col("is_excluded")).select("product_id", *([group] if group else []), *([F.col(bag).alias("_bag")] if bag else []))
    owned = owned_sets(ownership)
    rows = set_products(owned, fitment).join(ok, "product_id").join(product_vecs.select("product_id", "vec"), "product_id")
    return owned.join(user_vecs.select("user_id", "vec", *([F.col(bag).alias("_bag")] if bag else [])), "user_id"), rows


def best_of_groups(ownership: DataFrame, fitment: DataFrame, products: DataFrame, user_vecs: DataFrame, product_vecs: DataFrame, group: str, k: int,
                   bag: str | None = None, tile: int = 2048) -> DataFrame:
    """The k best scored ``entity_candidates`` of every user in each ``group`` of products, ties to the smaller product.

    Scoring every pair is the job; each tile gives back k rows per user and group, so that shuffles hold these and no pairs.
    With ``bag``, a column of ``products`` and ``user_vecs``, pairs of equal values are left out (what was bought, told per class of users).
    """
    import numpy as np
    import pandas as pd

    users, rows = _candidate_sides(ownership, fitment, products, user_vecs, product_vecs, bag=bag, group=group)
    fields = [T.StructField("user_id", users.schema["user_id"].dataType), T.StructField(group, rows.schema[group].dataType),
              T.StructField("product_id", rows.schema["product_id"].dataType), T.StructField("score", T.DoubleType())]

    def piece(left, right, low, s):
        if bag:
            own, theirs = left["_bag"].to_numpy()[low:low + len(s)], right["_bag"].to_numpy()
            s[(own[:, None] == theirs[None, :]) & pd.notna(theirs)] = -np.inf  # a null equals nothing
        out = []
        for value, at in right.groupby(group, sort=False, dropna=False).indices.items():
            row, col = _best_of_rows(s[:, at], k)
            score = s[row, at[col]]
            row, col, score = (x[score > -np.inf] for x in (row, col, score))
            out.append(pd.DataFrame({"user_id": left["user_id"].to_numpy()[low + row], group: pd.Series([value] * len(row), dtype=object), "product_id": right["product_id"].to_numpy()[at[col]], "score": score}))
        return pd.concat(out, ignore_index=True)

    best = _score_tiles(users, rows, fields, piece, tile, "product_id")
    return top_n_per_key(best, ["user_id", group], [F.desc("score"), F.asc("product_id")], k).drop("rn")


def norm_blocks(product_vecs: DataFrame, block: int) -> tuple[DataFrame, Column]:
    """Products with ``_b``, their block by falling norm, and the largest norm of every block as one array (a scalar)."""
    rows = product_vecs.select("product_id", "vec", F.sqrt(X.dot("vec", "vec")).alias("_norm"))
    rows = rank_in_order(rows, [], [F.desc("_norm"), F.asc("product_id")], "_at")
    rows = rows.withColumn("_b", F.floor((F.col("_at") - 1) / block).cast("int")).drop("_at")
    tops = rows.groupBy("_b").agg(F.max("_norm").alias("_norm"))
    return rows.drop("_norm"), tops.agg(F.sort_array(F.collect_list("_norm"), False)).scalar()


def _score_blocks(users: DataFrame, prods: DataFrame, k: int) -> DataFrame:
    """The k best products of every user of a (chunk, block) pair. ``users``: user_id, vec, _c, _b; ``prods``: product_id, vec, _b."""
    import numpy as np
    import pandas as pd

    schema = T.StructType([T.StructField("user_id", users.schema["user_id"].dataType), T.StructField("product_id", prods.schema["product_id"].dataType),
                           T.StructField("score", T.DoubleType())])

    def score(left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({"user_id": [], "product_id": [], "score": []})
        right = right.sort_values("product_id")
        ids = right["product_id"].to_numpy()
        s = np.stack(left["vec"].to_numpy()).astype("float64") @ np.stack(right["vec"].to_numpy()).astype("float64").T
        row, at = _best_of_rows(s, k)
        return pd.DataFrame({"user_id": left["user_id"].to_numpy()[row], "product_id": ids[at], "score": s[row, at]})

    asked = users.select(F.col("_c").alias("_chunk"), F.col("_b").alias("_block")).distinct()
    right = prods.withColumnRenamed("_b", "_block").join(asked, "_block")
    return users.groupBy("_b", "_c").cogroup(right.groupBy("_block", "_chunk")).applyInPandas(score, schema)


def top_k_by_vector(user_vecs: DataFrame, product_vecs: DataFrame, k: int, block: int = 4096, chunk: int = 8192) -> DataFrame:
    """D50/T04 without an entity limit: the k best products of every user, exactly.

    Products are cut into blocks by falling norm. No product of a block scores more than the user's norm times the block's largest,
    so the first block gives every user k scores, and then a user only visits the blocks, a prefix of the list, whose bound
    reaches the kth of these. A (chunk of users, block) pair is one cogroup of bounded size that multiplies its two pieces and
    emits k rows a user; no user x product table is ever written.
    """
    users, prods, reach = _vector_reach(user_vecs, product_vecs, k, max(block, k), chunk)
    more = users.where(reach > 1).withColumn("_b", F.explode(F.sequence(F.lit(1), reach - 1)))
    best = users.select("user_id", F.explode("_first").alias("e")).select("user_id", "e.product_id", "e.score")
    best = best.unionByName(_score_blocks(more.select("user_id", "vec", "_c", "_b"), prods, k))
    return top_n_per_key(best, ["user_id"], [F.desc("score"), F.asc("product_id")], k, "rank")


def _vector_reach(user_vecs: DataFrame, product_vecs: DataFrame, k: int, block: int, chunk: int):
    """Users with their k best of the first block (``_first``), the blocks, and how many blocks a user has to visit."""
    prods, tops = norm_blocks(product_vecs, block)
    chunks = user_vecs.agg(F.greatest(F.ceil(F.count(F.lit(1)) / chunk), F.lit(1)).cast("int")).scalar()
    users = user_vecs.select("user_id", "vec", F.pmod(F.xxhash64("user_id"), chunks).cast("int").alias("_c"))
    first = _score_blocks(users.withColumn("_b", F.lit(0)), prods.where("_b = 0"), k)
    first = first.groupBy("user_id").agg(F.collect_list(F.struct("product_id", "score")).alias("_first"))  # k rows a user
    users = shared(users.join(first, "user_id"))
    floor = F.when(F.size("_first") >= k, F.array_min(F.transform("_first", lambda e: e["score"])))
    # A bound is rounded up, so that no product is lost to it; a floor that is not positive bounds nothing.
    bound = F.sqrt(X.dot("vec", "vec")) * F.lit(1 + 1e-9)
    reach = F.when(floor > 0, F.size(F.filter("_tops", lambda n: n * bound >= floor))).otherwise(F.size("_tops"))
    return users.withColumn("_tops", tops).withColumn("_reach", reach).drop("_tops"), prods, F.col("_reach")


def vector_visits(user_vecs: DataFrame, product_vecs: DataFrame, k: int, block: int = 4096, chunk: int = 8192) -> DataFrame:
    """T04, one row: (user, block) pairs that ``top_k_by_vector`` scores, all there are, and the share."""
    users, _, reach = _vector_reach(user_vecs, product_vecs, k, max(block, k), chunk)
    out = users.agg(F.sum(F.greatest(reach, F.lit(1))).cast("long").alias("visited"), F.count(F.lit(1)).alias("_users"))
    blocks = F.ceil(product_vecs.agg(F.count(F.lit(1))).scalar() / max(block, k))
    return out.withColumn("pairs", (F.col("_users") * blocks).cast("long")).select("visited", "pairs", X.safe_div("visited", "pairs").alias("share"))


def merge_entity_scores(scores: DataFrame) -> DataFrame:
    """Best score of a product over the user's entities."""
    return scores.groupBy("user_id", "product_id").agg(F.max("score").alias("score"))
