"""Registered queries against their DuckDB oracle on the smallest tables."""

import pytest

from conftest import SF_SMALL

FAST = ["first_order_cohort", "model_frame", "one_review_per_order", "item_agg", "payment_agg",
        "temporal_split", "global_rank", "stratified_folds", "dataset_summary", "quality_report",
        "describe_numeric", "iqr_outliers", "box_stats", "histogram", "corr_matrix", "categorical_profile",
        "welch_ttest", "compute_metrics", "pr_curve", "roc_curve", "calibration_curve", "confusion_report",
        "impute_median", "one_hot", "ordinal_encode", "target_encode", "tfidf_vocabulary", "tfidf",
        "metric_range_gate", "model_ranking"]


def test_registry_contract():
    import __spark_entry__ as e
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 90


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    from tools.oracle_check import compare
    res = compare(spark, SF_SMALL, [name], verbose=False)
    assert res[name][0] in ("OK", "rows_only"), res[name]


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert len(df.columns) == 46
    assert df.count() > 0
