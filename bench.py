"""Benchmark: wall-clock of headline queries, one JSON line.

Each query is built and run with no shared frame or cached block left from another. The
flagship runs once over the small tables first, so that class loading and JIT compilation of
the JVM are not charged to whichever query comes first.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from slotwise.plans import QUERIES
from slotwise.plans.registry import forget

HEADLINE = [
    "d43_published", "d43_wide_output", "d12_segment_popularity", "d14_global_popularity", "d15_popularity_3tier", "d17_generation_popularity",
    "d19_copurchase_basket", "d20_copurchase_orders", "d27_purchase_exclusion", "d39_reserved_slots", "d41_tier_priority_ranking",
    "g04_interaction_edges", "g06_copurchase_pmi", "s05_latest_attributes", "s07_stage_events", "c16_uplift_base",
    "c24_revenue_attribution", "c19_paired_comparison", "c01_funnel", "b04_thompson_assign", "b15_posterior_check",
    "e01_ranking_metrics", "e22_rolling_backtest", "t04_top_k_by_vector", "q22_check_board",
]


def main():
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(max(int(cpus) if cpus.isdigit() else 8, 4)))
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    small = os.path.join(os.path.dirname(path.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in ("d43_wide_output", "c24_revenue_attribution"):
            QUERIES[name].run(spark, small).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        forget(spark)
        start = time.perf_counter()
        QUERIES[name].run(spark, path).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(path.rstrip("/"))}))


if __name__ == "__main__":
    main()
