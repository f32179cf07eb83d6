"""The published recommendations: every step of the pipeline composed, on the vehicle key (year, make, model)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.indexing import durable
from ..functions.keyed import is_member
from ..operators import eligibility as E
from ..operators import popularity as P
from ..operators import ranking as R
from ..params import TEST_PARAMS as p
from . import recs
from .registry import once, query
from .sql_views import norm

VEHICLE = ("seg_year", "seg_make", "seg_model")
YEARS, MODELS = (2000, 2009), ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
VALUES = ("sku", "price", "final_score", "image_url", "product_type", "popularity_source")


@once
def people(t):
    """Users with their vehicle; fifty mail addresses, so that users of one vehicle share one."""
    return t.users.withColumn("mail", F.concat(F.lit("m"), (F.col("user_id") % 50).cast("string")))


@once
def fitment(t):
    """A seventh of a make's parts fits a given year and model; of the last year hardly any, so the gate has work."""
    number = F.regexp_extract("sku", "[0-9]+", 0).cast("int")
    rows = t.fitment.select(F.col("make").alias("seg_make"), "sku", number.alias("h"), F.explode(F.sequence(F.lit(YEARS[0]), F.lit(YEARS[1]))).alias("seg_year"))
    rows = rows.withColumn("seg_model", F.explode(F.array(*[F.lit(m) for m in MODELS])))
    fits = ((F.col("h") + F.col("seg_year") * 3 + F.length("seg_model")) % 7 == 0) & ((F.col("seg_year") != YEARS[1]) | (F.col("h") % 97 == 0))
    return rows.where(fits).select(*VEHICLE, "sku")


@once
def parts(t):
    """Parts of each make with their scores and the vehicles they fit, as one array: vehicles that some user drives and that pass the gate."""
    rows = E.parts_of_vehicles(fitment(t), recs.products(t), VEHICLE, "seg_make", people(t), p)
    return durable(R.base_columns(P.lookup_tiers(rows, *recs.tiers(t), p)))


def finish(rows):
    rows = R.require_signal(P.choose_tier(rows, p), p)
    return rows.withColumns({"final_score": R.score_popularity(), "product_type": F.lit("fitment")})


@once
def published(t):
    spread = R.Spread("vehicles", ("seg_year", "seg_model"), finish)
    rows = R.diversified_for_users(people(t), parts(t), VEHICLE, p.max_per_category, recs.exclusion(t), top=p.slots, spread=spread)
    top = R.top_n_min(rows, p.slots, p.min_recs).join(people(t).select("user_id", "mail"), "user_id")
    one = R.pick_user_per_key(top, ["mail", *VEHICLE])
    wide = R.wide_output(one, ["mail", *VEHICLE], p, VALUES).withColumnRenamed("rec_count", "fitment_count")
    buyers = t.staged.where("event_name = 'PLACED ORDER'").join(people(t).select("user_id", "mail"), "user_id").select("mail")
    return is_member(wide, buyers, ["mail"], "_o").withColumn("engagement_tier", F.when(F.col("_o"), "hot").otherwise("cold")).drop("_o")


COLUMNS = "mail seg_year:l seg_make seg_model " + " ".join(
    f"rec{i}_sku rec{i}_price:d2 rec{i}_score:d2 rec{i}_image_url rec{i}_product_type rec{i}_popularity_source" for i in range(1, 5)) + " engagement_tier fitment_count:l version"
WIDE = ", ".join(f"max(CASE WHEN rn = {i} THEN {v} END) AS rec{i}_{v.replace('final_score', 'score')}" for i in range(1, 5) for v in VALUES)
STEPS = f"""ppl AS (SELECT *, 'm' || (user_id % 50) AS mail FROM v_users),
fit AS (SELECT y.y AS seg_year, f.make AS seg_make, m.m AS seg_model, f.sku FROM (SELECT *, CAST(regexp_extract(sku, '[0-9]+') AS INTEGER) AS h FROM v_fitment) f
  CROSS JOIN (SELECT unnest(range(2000, 2010)) AS y) y CROSS JOIN (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) AS m) m
  WHERE (f.h + y.y * 3 + length(m.m)) % 7 = 0 AND (y.y <> 2009 OR f.h % 97 = 0)),
sold AS (SELECT f.*, q.category, q.price, q.image_url FROM fit f JOIN v_products q ON q.sku = f.sku),
elig AS (SELECT s.*, {norm('s.sku')} AS k FROM sold s JOIN (SELECT seg_year, seg_make, seg_model FROM sold GROUP BY ALL HAVING count(*) >= 4) g USING (seg_year, seg_make, seg_model)),
seg_n AS (SELECT seg_make, seg_model, sum(total_segment_orders) AS n FROM v_seg GROUP BY ALL), make_n AS (SELECT seg_make, sum(total_make_orders) AS n FROM v_make GROUP BY ALL),
tiered AS (SELECT e.*, CASE WHEN s.sku IS NOT NULL AND sn.n >= 5 THEN 'segment' WHEN m.sku IS NOT NULL AND mn.n >= 20 THEN 'make' WHEN g.sku IS NOT NULL THEN 'global' ELSE 'none' END AS popularity_source,
  s.segment_score, m.make_score, g.global_score FROM elig e
  LEFT JOIN v_seg s ON s.seg_make = e.seg_make AND s.seg_model = e.seg_model AND s.sku = e.k LEFT JOIN v_make m ON m.seg_make = e.seg_make AND m.sku = e.k LEFT JOIN v_glob g ON g.sku = e.k
  LEFT JOIN seg_n sn ON sn.seg_make = e.seg_make AND sn.seg_model = e.seg_model LEFT JOIN make_n mn ON mn.seg_make = e.seg_make),
cand AS (SELECT u.user_id, u.mail, t.*, round(CASE popularity_source WHEN 'segment' THEN segment_score WHEN 'make' THEN make_score WHEN 'global' THEN global_score ELSE 0 END, 2) AS final_score, 'fitment' AS product_type
  FROM ppl u JOIN tiered t ON t.seg_year = u.seg_year AND t.seg_make = u.seg_make AND t.seg_model = u.seg_model
  WHERE NOT EXISTS (SELECT 1 FROM v_excl x WHERE x.user_id = u.user_id AND x.sku = t.k)),
dedup AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY final_score DESC, sku) = 1),
div AS (SELECT * FROM dedup QUALIFY row_number() OVER (PARTITION BY user_id, category ORDER BY final_score DESC, sku) <= 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY final_score DESC, sku) AS rn FROM div),
kept AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM ranked WHERE rn <= 4),
users4 AS (SELECT mail, seg_year, seg_make, seg_model, user_id, count(*) AS n, round(sum(final_score), 6) AS total, max(final_score) AS best FROM kept WHERE n >= 3 GROUP BY ALL),
picked AS (SELECT * FROM users4 QUALIFY row_number() OVER (PARTITION BY mail, seg_year, seg_make, seg_model ORDER BY n DESC, total DESC, best DESC, user_id) = 1),
hot AS (SELECT DISTINCT u.mail FROM v_staged s JOIN ppl u ON u.user_id = s.user_id WHERE s.event_name = 'PLACED ORDER')"""


@query("D43 D05 D15 D27 D36 D37 D38 D42 D44", COLUMNS, f"""
SELECT k.mail, k.seg_year, k.seg_make, k.seg_model, {WIDE}, CASE WHEN max(h.mail) IS NOT NULL THEN 'hot' ELSE 'cold' END AS engagement_tier, count(*) AS fitment_count, 'v1' AS version
FROM kept k JOIN picked c ON c.user_id = k.user_id LEFT JOIN hot h ON h.mail = k.mail GROUP BY ALL""", STEPS, name="d43_published")
def published_recommendations(t):
    """Fitment with its gate, exclusion, three tiers, variants, category cap, top 3 to 4, one user per mail and vehicle, wide row."""
    return published(t)
