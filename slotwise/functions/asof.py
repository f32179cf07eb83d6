"""As-of join: each left row gets the latest right row before it, within a tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str, tie: str,
              within_seconds: int, strict: bool = True, bucket_seconds: int = 3600,
              how: str = "inner") -> DataFrame:
    """Attach the most recent preceding right row (greatest ``tie`` on equal times).

    No key is ever sorted as a whole. Rows meet inside (key, time bucket) windows; what has
    to cross a bucket border is one aggregated row per (key, bucket), so the second window
    per key is bounded by the number of buckets in the data, not by its rows. Cost is
    linear in the rows: there is no range join that multiplies sends by orders.
    Right columns must not clash with left columns, apart from the keys.
    """
    on = list(on)
    extra = [c for c in right.columns if c not in on]
    payload = F.struct(*[F.col(c) for c in [right_ts, tie] + [c for c in extra if c not in (right_ts, tie)]])

    def bucket(ts):
        return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (bucket_seconds * 1_000_000))

    lrows = left.select(
        *on, F.col(left_ts).alias("_ts"), bucket(left_ts).alias("_bk"),
        F.lit(0 if strict else 1).alias("_ord"), F.struct(*left.columns).alias("_l"),
    )
    rrows = right.where(F.col(right_ts).isNotNull()).select(
        *on, F.col(right_ts).alias("_ts"), bucket(right_ts).alias("_bk"),
        F.lit(1 if strict else 0).alias("_ord"), payload.alias("_r"),
    )
    both = lrows.unionByName(rrows, allowMissingColumns=True)

    last_in_bucket = both.groupBy(*on, "_bk").agg(F.max("_r").alias("_last"))
    before = Window.partitionBy(*on).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last_in_bucket.select(*on, "_bk", F.last("_last", ignorenulls=True).over(before).alias("_carry"))

    inside = (
        Window.partitionBy(*on, "_bk").orderBy("_ts", "_ord", F.col("_r")[tie])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    hit = both.withColumn("_in", F.last("_r", ignorenulls=True).over(inside)).where(F.col("_l").isNotNull())
    hit = hit.select(*on, "_bk", "_l", "_ts", "_in").join(carried, on + ["_bk"], "left")
    best = F.coalesce("_in", "_carry")
    gap = F.unix_micros(F.col("_ts").cast("timestamp")) - F.unix_micros(best[right_ts].cast("timestamp"))
    best = F.when(gap <= within_seconds * 1_000_000, best)
    out = hit.withColumn("_best", best).select("_l.*", *[F.col("_best")[c].alias(c) for c in extra])
    return out.where(F.col(right_ts).isNotNull()) if how == "inner" else out
