"""The correctness gate in miniature: registered queries vs their DuckDB
oracle on the smallest fixture (model-free queries only)."""

import math
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from churnframe.sources.tables import TABLES

FAST = ["stream_log_summary", "raw_scan", "staging_clean", "dim_customer_first_wins", "dim_contract", "dim_services",
        "fact_snapshot", "training_view", "load_report", "dq_orphans", "surrogate_keys",
        "dim_customer_merge", "coerce_numeric", "coerce_int_default", "tenure_band_variants",
        "churn_by_contract", "churn_by_tenure_band", "revenue_at_risk", "churn_by_addon_count",
        "churn_mean_by_band_complete", "label_share_by_contract", "null_counts_top",
        "describe_numeric", "describe_categorical", "box_stats_avg_spend", "tenure_histogram",
        "impute_median_fit", "impute_mode_fit", "pr_curve", "roc_auc", "best_threshold_085",
        "classification_report", "stratified_split", "class_weights", "decision_policy",
        "monitoring_summary", "validate_requests", "engineered_features", "one_hot_long",
        "feature_names", "shap_summary_density", "boost_first_tree"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, sf, duck, name):
    sdf = queries()[name](spark, sf)
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    si = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    oi = sorted(range(len(ocols)), key=lambda i: ocols[i])
    got = Counter(tuple(_norm(r[i]) for i in si) for r in sdf.collect())
    exp = Counter(tuple(_norm(r[i]) for i in oi) for r in res.fetchall())
    assert got == exp


def test_every_query_has_oracle_or_is_model_based():
    from churnframe.plans.catalog import ORACLE, QUERIES
    no_oracle = set(QUERIES) - set(ORACLE)
    assert no_oracle <= {"score_batch", "model_comparison", "shap_global", "shap_dependence",
                         "shap_local", "shap_interaction", "shap_summary", "stream_scoring_log", "stream_monitoring_summary"}


SQL_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


@pytest.mark.parametrize("name", ["describe_categorical", "box_stats_avg_spend", "pr_curve",
                                  "roc_auc", "engineered_features", "column_info",
                                  "stream_log_summary", "one_hot_long"])
def test_column_types_match_oracle(spark, sf, duck, name):
    got = dict(queries()[name](spark, sf).dtypes)
    exp = {r[0]: r[1] for r in duck.execute("DESCRIBE " + oracle_sql()[name]).fetchall()}
    assert {c: SQL_TYPE.get(t, t) for c, t in got.items()} == exp
