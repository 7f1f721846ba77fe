"""Every registered query runs on sf0.001; oracle-backed ones match DuckDB there."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF

FAST = ["d1_claim_metrics_15d", "d2_service_metrics_15d", "d3_exam_metrics_15d", "c7_join_latest_period",
        "e2_history_rank", "a8_merge_upsert", "a9_merge_first_write_wins", "m2_optimise_thresholds_daily",
        "k5_classification_metrics", "l7_drift_ks", "j2_woe_numeric", "n1_run_increment", "n2_build_training_table",
        "i1_date_features", "d11_monthly_metrics", "c1_join_latest_row", "c9_lookup_fill", "c10_mark_membership",
        "g1_combine_predictions", "m3_sweep_green_net", "m4_reversal_sensitivity", "k1_stratified_split_counts",
        "a10_conform_to_contract", "b19_neutralise_all_null_dates", "a2_load_training",
        "b10_project_rename", "c6_full_outer_combine", "n1_metrics_upsert", "n1_wide_table", "n2_training_table",
        "i2_tfidf_features", "i3_label_encode", "a3_load_by_ids", "a4_load_for_scoring_relaxed", "a1_read_table_by_name",
        "b4_standardise_category_keep", "a11_report_set", "a8_versioned_upsert"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "CANT_LIC_U15D" in df.columns


def test_every_query_has_builder_and_sql_keys_subset():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("orders", "lineitem", "customer", "supplier", "part", "events", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    order_s = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted((tuple(_norm(r[i]) for i in order_s) for r in df.collect()), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in order_d) for r in res.fetchall()), key=repr)
    assert a == b
