"""Q08-Q29: checks of a wide recommendation table and its inputs.

``wide``: key columns, rec{i}_sku, rec{i}_price, rec{i}_score, rec{i}_image_url,
rec{i}_popularity_source, rec_count. ``long``: one row per filled slot.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.keyed import metric_rows

SEVERITY = ("CRITICAL", "HIGH", "MEDIUM", "LOW")


class OutputRejected(ValueError):
    """Raised by ``require_output`` with all failed checks."""


def _n() -> Column:
    return F.count(F.lit(1))


def _sum(parts):
    return reduce(lambda a, b: a + b, parts)


def long_form(wide: DataFrame, key, slots: int = 4) -> DataFrame:
    """One row per filled slot with all slot columns."""
    names = ("sku", "price", "score", "image_url", "popularity_source")
    items = F.array(*[F.struct(F.lit(i).alias("slot"), *[F.col(f"rec{i}_{n}").alias(n) for n in names]) for i in range(1, slots + 1)])
    return wide.select(*key, F.inline(items)).where("sku is not null")


def row_threshold(df: DataFrame, least: int, label: str = "table") -> DataFrame:
    """Q08: row count with OK or WARNING."""
    return df.agg(_n().alias("n")).select(F.lit(label).alias("check"), "n", F.when(F.col("n") >= least, "OK").otherwise("WARNING").alias("status"))


def duplicate_slots(wide: DataFrame, slots: int = 4) -> DataFrame:
    """Q09: rows that hold a sku in two slots; a NULL slot equals nothing."""
    same = [F.coalesce(F.col(f"rec{a}_sku") == F.col(f"rec{b}_sku"), F.lit(False)) for a, b in combinations(range(1, slots + 1), 2)]
    return wide.agg(F.count_if(reduce(lambda x, y: x | y, same)).alias("violations"), _n().alias("users"))


def forbidden_skus(long: DataFrame, catalog: DataFrame) -> DataFrame:
    """Q10: recommended rows with refurbished or service skus."""
    bad = catalog.where(X.is_refurbished("tags")).select("sku").distinct().withColumn("_r", F.lit(True))
    return long.join(bad, "sku", "left").agg(F.count("_r").alias("refurbished"), F.count_if(X.is_service_sku("sku")).alias("service"))


def price_floor(long: DataFrame, floor: float) -> DataFrame:
    """Q11: prices below the floor and their range."""
    return long.agg(F.count_if(F.col("price") < floor).alias("below"), F.min("price").alias("min_price"), F.max("price").alias("max_price"),
                    F.round(F.avg("price"), 2).alias("avg_price"))


def price_per_slot(long: DataFrame, floor: float) -> DataFrame:
    """Q12: prices below the floor and non-https images, per slot."""
    return long.groupBy("slot").agg(_n().alias("recs"), F.count_if(F.col("price") < floor).alias("below"),
                                    F.count_if(~X.image_ok("image_url")).alias("bad_images"))


def https_ratio(long: DataFrame) -> DataFrame:
    """Q12: share of images served over https."""
    return long.agg(_n().alias("images"), F.count_if(X.image_ok("image_url")).alias("https")).withColumn("pct", X.pct("https", "images"))


def _ordered(slots: int, upto: Column | None = None) -> Column:
    """Scores never rise from slot to slot; NULL slots are ignored, ``upto`` limits the slots compared."""
    conds = []
    for i in range(1, slots):
        a, b = F.col(f"rec{i}_score"), F.col(f"rec{i + 1}_score")
        ok = a.isNull() | b.isNull() | (a >= b)
        conds.append(ok if upto is None else ok | (F.lit(i + 1) > upto))
    return reduce(lambda x, y: x & y, conds)


def score_order(wide: DataFrame, slots: int = 4) -> DataFrame:
    """Q13: rows whose scores do not rise; fallback rows only up to their first fallback slot."""
    upto = F.when(F.col("is_fallback"), F.col("fallback_start_idx")).otherwise(slots) if "is_fallback" in wide.columns else None
    return wide.agg(_n().alias("users"), F.count_if(_ordered(slots, upto)).alias("ordered")).withColumn("pct", X.pct("ordered", "users"))


def diversity(long: DataFrame, catalog: DataFrame, key, cap: int = 2) -> DataFrame:
    """Q14: most rows of one category per user and number of violations."""
    cat = catalog.groupBy("sku").agg(F.max("category").alias("category"))
    per = long.join(cat, "sku", "left").groupBy(*key, "category").agg(_n().alias("n"))
    return per.agg(F.max("n").alias("max_same"), F.count_if(F.col("n") > cap).alias("violations"))


def count_distribution(wide: DataFrame, slots: int = 4, least: int = 3) -> DataFrame:
    """Q15: users by number of recs."""
    n = F.col("rec_count")
    return wide.agg(F.count_if(n == least).alias("with_min"), F.count_if(n == slots).alias("with_all"),
                    F.count_if(~n.isin(least, slots)).alias("unexpected"), F.round(F.avg(n), 2).alias("avg_count"))


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Q15: rows and share per value (tier, source, type, slot type)."""
    c = df.groupBy(F.col(column).alias("value")).agg(_n().alias("n"))
    return c.withColumn("pct", F.round(F.col("n") / df.agg(_n()).scalar() * 100, 2))


def category_coverage(long: DataFrame, catalog: DataFrame, least: int) -> DataFrame:
    """Q16: distinct categories recommended against a threshold."""
    cat = catalog.groupBy("sku").agg(F.max("category").alias("category"))
    row = long.select("sku").distinct().join(cat, "sku", "left").agg(F.count_distinct("category").alias("categories"))
    return row.withColumn("status", F.when(F.col("categories") >= least, "OK").otherwise("WARNING"))


def fitment_match(long: DataFrame, fitment: DataFrame, key, on: dict[str, str]) -> DataFrame:
    """Q17: recommended rows and users whose sku does not fit the vehicle."""
    fit = fitment.select(*[F.col(theirs).alias(mine) for mine, theirs in on.items()]).distinct().withColumn("_f", F.lit(True))
    bad = F.col("_f").isNull()
    row = long.join(fit, list(on), "left").agg(_n().alias("recs"), F.count_if(bad).alias("mismatch_rows"),
                                               F.count_distinct(F.when(bad, F.struct(*key))).alias("mismatch_users"))
    return row.withColumn("status", F.when(F.col("mismatch_rows") == 0, "OK").otherwise("ERROR"))


def generation_coverage(users: DataFrame, eligible: DataFrame, on: dict[str, str]) -> DataFrame:
    """Q18: users whose vehicle has eligible parts, and the rest."""
    v = eligible.select(*[F.col(theirs).alias(mine) for mine, theirs in on.items()]).distinct().withColumn("_e", F.lit(True))
    row = users.join(v, list(on), "left").agg(_n().alias("users"), F.count("_e").alias("included"))
    return row.withColumn("excluded", F.col("users") - F.col("included")).withColumns({
        "included_pct": X.pct("included", "users"), "excluded_pct": X.pct("excluded", "users")})


def exclusion_audit(long: DataFrame, exclusion: DataFrame) -> DataFrame:
    """Q19: recommended rows the user already bought, by an exclusion rebuilt from the sources."""
    rows = long.withColumn("norm_sku", X.normalize_variant("sku"))
    bad = exclusion.select("user_id", F.col("sku").alias("norm_sku"))
    return rows.join(bad, ["user_id", "norm_sku"], "left_semi").agg(_n().alias("violations"), F.count_distinct("user_id").alias("users"))


def source_consistency(long: DataFrame, segments: DataFrame, makes: DataFrame, globals_: DataFrame, segment=("seg_make", "seg_model")) -> DataFrame:
    """Q20: popularity labels without a matching table row, and rows without any source."""
    rows = long.withColumn("_k", X.normalize_variant("sku"))
    rows = rows.join(segments.select(*segment, F.col("sku").alias("_k"), F.lit(1).alias("_s")), [*segment, "_k"], "left")
    rows = rows.join(makes.select(segment[0], F.col("sku").alias("_k"), F.lit(1).alias("_m")), [segment[0], "_k"], "left")
    rows = rows.join(globals_.select(F.col("sku").alias("_k"), F.lit(1).alias("_g")), "_k", "left")
    src = F.col("popularity_source")
    wrong = ((src == "segment") & F.col("_s").isNull()) | ((src == "make") & F.col("_m").isNull()) | ((src == "global") & F.col("_g").isNull())
    return rows.agg(_n().alias("recs"), F.count_if(src.isin("none", "")).alias("no_source"), F.count_if(wrong).alias("mismatches"))


def coverage(wide: DataFrame, base: DataFrame, key) -> DataFrame:
    """Q21: recommended keys as a share of the base universe."""
    row = base.select(*key).distinct().join(wide.select(*key).distinct().withColumn("_w", F.lit(True)), list(key), "left").agg(
        _n().alias("base"), F.count("_w").alias("covered"))
    return row.withColumn("pct", X.pct("covered", "base"))


def board_facts(long: DataFrame, exclusion: DataFrame, catalog: DataFrame, key, floor: float, cap: int, least: int) -> DataFrame:
    """Q22: what the checks of a board ask of the recommendations, as one row from one pass over them.

    Every row is flagged by equi-joins (bought, category) and added up per (user, category), per user and overall, combined
    map-side each time. A sku has one category, so distinct skus add up over categories.
    """
    key = list(key)
    cat = catalog.groupBy("sku").agg(F.max("category").alias("_category"))
    bought = exclusion.select("user_id", F.col("sku").alias("_norm")).distinct().withColumn("_bought", F.lit(True))
    rows = long.withColumn("_norm", X.normalize_variant("sku")).join(bought, ["user_id", "_norm"], "left").join(cat, "sku", "left")
    per = rows.groupBy(*key, "_category").agg(
        _n().alias("n"), F.count_distinct("sku").alias("skus"), F.count("_bought").alias("bought"), F.count_if(F.col("price") < floor).alias("below"),
        F.count("image_url").alias("images"), F.count_if(F.col("image_url").startswith("https://")).alias("https"))
    users = per.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("n", "skus", "bought", "below", "images", "https")], F.count_if(F.col("n") > cap).alias("over"))
    return users.agg(
        F.count_if(F.col("n") > F.col("skus")).alias("duplicates"), F.sum("bought").alias("bought"), F.sum("below").alias("below"), F.sum("over").alias("over"),
        F.count_if(F.col("n") == least).alias("with_min"), X.pct(F.sum("https"), F.sum("images")).alias("https_pct"))


def check_rows(facts: DataFrame, checks) -> DataFrame:
    """Board rows from a one-row frame. ``checks``: (column, name, severity, expected, is for information)."""
    def row(column, name, severity, expected, info):
        v = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
        status = F.lit("INFO") if info else F.when(v == expected, "PASS").otherwise("FAIL")
        return F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"), v.alias("value"), F.lit(float(expected)).alias("expected"), status.alias("status"))

    return facts.select(F.inline(F.array(*[row(*c) for c in checks])))


def check_row(found: DataFrame, column: str, name: str, severity: str, expected: float = 0.0, info: bool = False) -> DataFrame:
    """One check of a board from a one-row result."""
    v = F.col(column).cast("double")
    status = F.lit("INFO") if info else F.when(v == expected, "PASS").otherwise("FAIL")
    return found.select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), v.alias("value"),
                        F.lit(float(expected)).alias("expected"), status.alias("status"))


def check_board(rows: list[DataFrame], failures_first: bool = False) -> DataFrame:
    """Unioned checks in severity order, or failures first."""
    board = reduce(DataFrame.unionByName, rows)
    sev = reduce(lambda c, x: c.when(F.col("severity") == x[1], x[0]), enumerate(SEVERITY[1:], 1), F.when(F.col("severity") == SEVERITY[0], 0))
    st = F.when(F.col("status") == "FAIL", 0).when(F.col("status") == "PASS", 1).otherwise(2)
    board = board.withColumns({"severity_rank": sev, "status_rank": st})
    order = ["status_rank", "severity_rank", "check"] if failures_first else ["severity_rank", "status_rank", "check"]
    return board.orderBy(*order)


def failing_samples(found: DataFrame, board: DataFrame, check: str, n: int = 20) -> DataFrame:
    """Q22: sample rows of a check, empty unless the board says it failed."""
    failed = board.where((F.col("check") == check) & (F.col("status") == "FAIL")).agg(_n()).scalar()
    return found.where(failed > 0).limit(n)


def health_board(wide: DataFrame, floor: float, slots: int = 4) -> DataFrame:
    """Headline metrics with their expectation, one pass over the wide table."""
    same = [F.coalesce(F.col(f"rec{a}_sku") == F.col(f"rec{b}_sku"), F.lit(False)) for a, b in combinations(range(1, slots + 1), 2)]
    low = reduce(lambda x, y: x | y, [F.coalesce(F.col(f"rec{i}_price") < floor, F.lit(False)) for i in range(1, slots + 1)])
    row = wide.agg(_n().alias("users"), F.count_if(reduce(lambda x, y: x | y, same)).alias("duplicate_skus"), F.count_if(low).alias("below_floor"),
                   F.count_if(~_ordered(slots)).alias("order_violations"), F.count_if(F.col("rec1_sku").isNull()).alias("missing_slot1"))
    names = {"users": ">0", "duplicate_skus": "0", "below_floor": "0", "order_violations": "0", "missing_slot1": "0"}
    exp = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return metric_rows(row, list(names)).withColumn("expected", exp[F.col("metric")])


def output_findings(wide: DataFrame, target: int, min_users: int, min_coverage: float, floor: float, slots: int = 4) -> DataFrame:
    """Q24: one row with every failure count of an engine output table."""
    uniq = F.count_distinct("user_id")
    low = _sum([F.count_if(F.col(f"rec{i}_price") < floor) for i in range(1, slots + 1)]) if f"rec1_price" in wide.columns else F.lit(0)
    upto = F.when(F.col("is_fallback"), F.col("fallback_start_idx")).otherwise(slots) if "is_fallback" in wide.columns else None
    row = wide.agg(_n().alias("users"), (_n() - uniq).alias("duplicate_users"), F.count_if(F.col("rec1_product_id").isNull()).alias("missing_slot1"),
                   low.alias("below_floor"), F.count_if(~_ordered(slots, upto)).alias("order_violations"))
    return row.withColumns({"too_few_users": F.col("users") < min_users, "low_coverage": F.col("users") < F.lit(min_coverage * target)})


def require_output(wide: DataFrame, target: int, min_users: int = 1, min_coverage: float = 0.0, floor: float = 0.0, slots: int = 4) -> None:
    """Q24: raise with all failed checks of the output."""
    missing = [f"rec{i}_{c}" for i in range(1, slots + 1) for c in ("product_id", "score") if f"rec{i}_{c}" not in wide.columns]
    if missing:
        raise OutputRejected("missing columns: " + ", ".join(missing))
    row = output_findings(wide, target, min_users, min_coverage, floor, slots).first().asDict()
    failed = [k for k, v in row.items() if k != "users" and v]
    if failed:
        raise OutputRejected("; ".join(f"{k}={row[k]}" for k in failed))


def null_fourth_slot(wide: DataFrame) -> DataFrame:
    """Q25: an empty fourth slot is allowed only for users with three recs."""
    empty = F.col("rec4_sku").isNull()
    return wide.agg(F.count_if(empty).alias("empty"), F.count_if(empty & (F.col("rec_count") != 3)).alias("unexpected"),
                    F.count_if(~empty & (F.col("rec_count") != 4)).alias("inconsistent"))


def score_summary(long: DataFrame, limits=(20.0, 40.0)) -> DataFrame:
    """Q26: median, 95th percentile, zero, negative and very high scores."""
    s = F.col("score")
    return long.agg(F.percentile_approx(s, 0.5, 10000).alias("median"), F.percentile_approx(s, 0.95, 10000).alias("p95"),
                    F.count_if(s == 0).alias("zero"), F.count_if(s < 0).alias("negative"),
                    F.count_if(s > limits[0]).alias("above_low"), F.count_if(s > limits[1]).alias("above_high"))


def dominance(wide: DataFrame, segment: Column, sku: str, slots: int = 4) -> DataFrame:
    """Q27: share of the users of one segment that are shown one product."""
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"rec{i}_sku") == sku, F.lit(False)) for i in range(1, slots + 1)])
    row = wide.where(segment).agg(_n().alias("users"), F.count_if(hit).alias("shown"))
    return row.withColumn("pct", X.pct("shown", "users"))


def conflicting_attribute(catalog: DataFrame, key: str, attribute: str) -> DataFrame:
    """Q28: keys with more than one value of an attribute."""
    return catalog.groupBy(key).agg(F.count_distinct(attribute).alias("values")).where("values > 1")
