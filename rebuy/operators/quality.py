"""Data-quality gates (Q1–Q7). Every check is an aggregate over the whole
table returning rows ``(check, passed, detail)``; nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns of a metric table and of a best-model summary.
METRIC_COLUMNS = ["model", "split", "pr_auc", "roc_auc", "precision_at_k", "lift_at_k",
                  "f1", "precision", "recall", "brier", "threshold"]
BEST_MODEL_COLUMNS = ["overall_validation_best_model", "overall_test_best_model", "recommended_model",
                      "recommendation_reason", "recommended_model_test_metrics", "n_total_models_evaluated"]
SPLITS = ("train", "val", "test")


def _row(df: DataFrame, name: str, passed: Column, detail: Column) -> DataFrame:
    return df.agg(F.lit(name).alias("check"), passed.cast("int").alias("passed"),
                  detail.cast("double").alias("detail"))


def _rows(wide: DataFrame, checks: list[tuple]) -> DataFrame:
    """One-row aggregate -> a row per (check, passed, detail); a NULL verdict fails."""
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check"), F.coalesce(ok, F.lit(False)).cast("int").alias("passed"),
                 detail.cast("double").alias("detail")) for n, ok, detail in checks])))


# Q1
def union_metrics(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Q2
def split_disjoint(df: DataFrame, key: str = "order_id", split: str = "split") -> DataFrame:
    """Keys appearing in more than one split (one shuffle on the key)."""
    per_key = df.groupBy(key).agg(F.countDistinct(split).alias("_k"))
    bad = F.count(F.when(F.col("_k") > 1, 1))
    return _row(per_key, "splits_disjoint", bad == 0, bad)


# Q3
def unique_keys(df: DataFrame, key: str = "order_id", split: str = "split") -> DataFrame:
    """Keys found more than once in a split (one shuffle, one aggregate)."""
    per_key = df.groupBy(split, key).agg(F.count(F.lit(1)).alias("_n"))
    bad = per_key.agg(*[F.count(F.when((F.col("_n") > 1) & (F.col(split) == s), 1)).alias(s) for s in SPLITS])
    return _rows(bad, [(f"unique_{key}_{s}", F.col(s) == 0, F.col(s)) for s in SPLITS])


# Q4
def temporal_order(df: DataFrame, time_col: str = "score_time", split: str = "split") -> DataFrame:
    """Splits follow each other in time: max(train) <= min(val), max(val) <=
    min(test). A split without rows or times fails."""
    t = F.col(time_col)
    s = F.col(split)
    agg = df.agg(*[F.max(F.when(s == x, t)).alias(f"max_{x}") for x in SPLITS],
                 *[F.min(F.when(s == x, t)).alias(f"min_{x}") for x in SPLITS])
    return _rows(agg, [("train_before_val", F.col("max_train") <= F.col("min_val"), F.lit(None)),
                       ("val_before_test", F.col("max_val") <= F.col("min_test"), F.lit(None))])


# Q5
def metric_range_gate(metrics: DataFrame, n_models: int = 6) -> DataFrame:
    """Each [0,1] metric in range (NULL fails), lift >= 0, model count. One
    aggregate over the metric table, turned into rows."""
    unit = ["pr_auc", "roc_auc", "precision_at_k", "f1", "precision", "recall", "brier"]
    aggs = [F.count(F.when(~F.coalesce(F.col(c).between(0, 1), F.lit(False)), 1)).alias(c) for c in unit]
    aggs += [F.count(F.when(~F.coalesce(F.col("lift_at_k") >= 0, F.lit(False)), 1)).alias("lift"),
             F.countDistinct("model").alias("models")]
    wide = metrics.agg(*aggs)
    rows = [(f"{c}_in_unit_range", F.col(c) == 0, F.col(c)) for c in unit]
    return _rows(wide, rows + [("lift_non_negative", F.col("lift") == 0, F.col("lift")),
                               ("model_count", F.col("models") == n_models, F.col("models"))])


# Q6
def summary_gate(summary: DataFrame, frame: DataFrame, n_columns: int = 46,
                 n_baseline_features: int = 20) -> DataFrame:
    """The stored summary row agrees with the data it describes."""
    fresh = frame.agg(F.count(F.lit(1)).alias("_n")).scalar()
    stored = ["n_processed_columns", "n_model_input_features_baseline", "n_modeling_rows"]
    got = summary.agg(*[F.first(c if c in summary.columns else F.lit(None)).alias(c) for c in stored],
                      fresh.alias("_n"))
    return _rows(got, [
        ("summary_has_columns", F.lit(stored[0] in summary.columns), F.lit(None)),
        ("summary_has_baseline_count", F.lit(stored[1] in summary.columns), F.lit(None)),
        ("summary_columns_match", F.col(stored[0]) == n_columns, F.col(stored[0])),
        ("summary_baseline_match", F.col(stored[1]) == n_baseline_features, F.col(stored[1])),
        ("summary_rows_match", F.col(stored[2]) == F.col("_n"), F.col("_n"))])


def metric_schema_gate(metrics: DataFrame) -> DataFrame:
    """The metric table has every column of ``METRIC_COLUMNS``; the detail
    is the number of missing ones."""
    missing = [c for c in METRIC_COLUMNS if c not in metrics.columns]
    return _row(metrics, "metric_columns_present", F.lit(not missing), F.lit(len(missing)))


def best_model_gate(best: DataFrame) -> DataFrame:
    """The best-model summary has every column of ``BEST_MODEL_COLUMNS`` and a
    recommendation; the detail is the number of missing columns."""
    missing = [c for c in BEST_MODEL_COLUMNS if c not in best.columns]
    named = F.count("recommended_model" if "recommended_model" in best.columns else F.lit(None)) > 0
    return _row(best, "best_model_fields_present", named & F.lit(not missing), F.lit(len(missing)))


def schema_checks(splits: dict[str, DataFrame], n_columns: int = 46) -> DataFrame:
    """Splits share one schema, with the expected column count."""
    frames = list(splits.values())
    same = all(f.schema == frames[0].schema for f in frames)
    base = frames[0]
    return union_metrics(
        _row(base, "splits_share_schema", F.lit(same), F.lit(None)),
        _row(base, f"splits_have_{n_columns}_columns", F.lit(len(base.columns) == n_columns),
             F.lit(len(base.columns))),
    )


# Q7
def quality_report(split_frame: DataFrame, split: str = "split", key: str = "order_id",
                   time_col: str = "score_time", metrics: DataFrame | None = None,
                   summary: DataFrame | None = None, n_columns: int = 46,
                   written: dict[str, DataFrame] | None = None, n_models: int = 6,
                   best_model: DataFrame | None = None) -> DataFrame:
    """All gates as rows (check, passed, detail). ``written``: the splits as
    read back one by one from where they were stored; the schema gate then
    compares the stored schemas with each other."""
    parts = written or {s: split_frame.filter(F.col(split) == s).drop(split) for s in SPLITS}
    rows = [schema_checks(parts, n_columns), unique_keys(split_frame, key, split),
            split_disjoint(split_frame, key, split), temporal_order(split_frame, time_col, split)]
    if metrics is not None:
        rows += [metric_schema_gate(metrics), metric_range_gate(metrics, n_models)]
    if summary is not None:
        rows.append(summary_gate(summary, split_frame))
    if best_model is not None:
        rows.append(best_model_gate(best_model))
    return union_metrics(*rows)
