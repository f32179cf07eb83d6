"""Registered queries against their SQL on DuckDB (sf0.001).

By default one query per operator family and the composed ones; SLOTWISE_ALL=1 runs every query.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from slotwise.plans import QUERIES

PATH = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()
DEFAULT = """d43_wide_output d05_eligible_parts d15_popularity_3tier d17_generation_popularity d19_copurchase_basket d21_copurchase_conditional
d22_copurchase_recommend d23_category_copurchase d25_primary_category d34_final_score d36_dedup_variant d39_reserved_slots d41_tier_priority_ranking
d46_slot_select_single_pool d48_popularity_pools g01_user_nodes g02_product_nodes g04_interaction_edges g06_copurchase_pmi g11_stratified_split g12_dense_sku_ids
e01_ranking_metrics e09_metrics_by_tier e22_rolling_backtest e29_click_auc e30_signal_rates e32_run_diff c01_funnel c13_time_to_action c16_uplift_base
c24_revenue_attribution c29_fatigue c33_revenue_24h c35_scorecard b03_nig_posterior b09_click_direction b13_training_audit b14_concentration q01_contract_findings
q20_source_consistency q22_check_board s05_latest_attributes s07_stage_events s09_import_orders k02_publish_with_copy k06_update_stored_tier a06_quantiles_of_stored_sketches s11_federated_names p05_commodity_exclusion k04_json_report t04_top_k_by_vector
j11_time_window_join w04_group_totals a06_quantiles d43_published d07_vehicle_parts_list d23_category_copurchase_skus d27_purchase_exclusion
d29_fitment_candidates d30_universal_candidates d46_slot_select d47_popularity_fallback d53_fallback_provenance b04_thompson_assign b05_selection_share e10_bootstrap_interval
e22_rolling_versions e26_variant_pure_segment e26_variant_universal e26_variant_lower_price_floor g15_negative_samples g18_propagate_embeddings g19_factorize""".split()
NAMES = [n for n, q in QUERIES.items() if q.sql] if os.environ.get("SLOTWISE_ALL") else DEFAULT


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{PATH}/{t}.parquet'")
    return con


def canon(rows):
    return sorted(tuple(f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, PATH)
    cur = duck.execute(entry.oracle_sql()[name])
    assert [d[0] for d in cur.description] == df.columns
    assert canon([tuple(r) for r in df.collect()]) == canon(cur.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries()) and all(q.sql for q in QUERIES.values())
