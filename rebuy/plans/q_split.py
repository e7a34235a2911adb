"""Registered queries: order/split/sample (D1–D7), gates (Q2–Q7), split
and report round trips (A2–A5), group statistics (G4–G8)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import aggregates as G
from ..operators import ordering as D
from ..operators import quality as Q
from ..sources import io as IO
from ..sources.retail import v_orders
from ..session import shared_path
from .q_frame import _frame
from .registry import build_sql, materialized, register, views
from .sqlparts import MF_DOUBLES, model_frame_ctes

TARGET = "target_repeat_within_180d"
F1, F2 = 0.70, 0.15


def split_ctes():
    return model_frame_ctes() + [
        ("rk", "SELECT *, row_number() OVER (ORDER BY score_time, order_id) AS rn, count(*) OVER () AS n_all FROM mf"),
        ("sp", f"""SELECT * EXCLUDE (rn, n_all), CASE
  WHEN rn <= floor(n_all * CAST({F1!r} AS DOUBLE)) THEN 'train'
  WHEN rn <= floor(n_all * CAST({F1 + F2!r} AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM rk"""),
    ]


_S = split_ctes()


def _splits(spark, sf):
    return materialized(spark, sf, "splits", lambda: D.temporal_split(_frame(spark, sf), "score_time", F1, F2))


# D1–D7 ----------------------------------------------------------------------
@register("global_rank", build_sql(_S, "SELECT order_id, score_time, rn AS rank FROM rk"))
def q_global_rank(spark, sf):
    return D.global_rank(_frame(spark, sf), ["score_time", "order_id"]).select("order_id", "score_time", "rank")


@register("temporal_split", build_sql(_S, "SELECT order_id, score_time, split FROM sp"))
def q_temporal_split(spark, sf):
    return _splits(spark, sf).select("order_id", "score_time", "split")


@register("seeded_sample", build_sql(views("orders"), """SELECT order_id, customer_id FROM v_orders
ORDER BY (order_id * 48271 + 42) % 2147483647, order_id LIMIT 5000"""))
def q_seeded_sample(spark, sf):
    """5000 orders by seeded hash (the sampling is the feature)."""
    return D.seeded_sample(v_orders(spark, sf), 5000, 42, "order_id", kind="lcg").select("order_id", "customer_id")


@register("stratified_folds", build_sql(_S, f"""SELECT order_id, {TARGET},
  CAST((row_number() OVER (PARTITION BY {TARGET} ORDER BY (order_id * 48271 + 42) % 2147483647, order_id) - 1) % 3
       AS INTEGER) AS fold
FROM mf"""))
def q_folds(spark, sf):
    return D.stratified_folds(_frame(spark, sf), TARGET, 3, 42, "order_id", kind="lcg").select(
        "order_id", TARGET, "fold")


@register("top_k", build_sql(_S, "SELECT order_id, total_price FROM mf ORDER BY total_price DESC NULLS LAST, "
                                 "order_id LIMIT 10", ["total_price"]), doubles=["total_price"])
def q_top_k(spark, sf):
    """Ten largest orders by value (a top-k report)."""
    return D.top_k(_frame(spark, sf), "total_price", 10, tiebreak=["order_id"]).select("order_id", "total_price")


_CS_D = ["share", "cum_share"]


@register("cumulative_share", build_sql(_S, """SELECT *, min(CASE WHEN cum_share >= 0.9 THEN idx END) OVER () AS first_at_90,
  min(CASE WHEN cum_share >= 0.95 THEN idx END) OVER () AS first_at_95 FROM (
  SELECT product_category_main, n, share,
    sum(share) OVER (ORDER BY n DESC, product_category_main ROWS UNBOUNDED PRECEDING) AS cum_share,
    row_number() OVER (ORDER BY n DESC, product_category_main) AS idx
  FROM (SELECT *, n / sum(n) OVER () AS share FROM (
    SELECT product_category_main, count(*) AS n FROM mf WHERE product_category_main IS NOT NULL GROUP BY 1)))""",
                                        _CS_D), doubles=_CS_D)
def q_cumulative_share(spark, sf):
    cats = (_frame(spark, sf).filter(F.col("product_category_main").isNotNull())
            .groupBy("product_category_main").agg(F.count(F.lit(1)).alias("n")))
    return D.cumulative_share(cats, "n", [("n", False), "product_category_main"])


@register("step_delta", build_sql(_S, f"""SELECT purchase_month, rate, delta,
  CAST(purchase_month = first_value(purchase_month) OVER (ORDER BY delta DESC NULLS LAST, purchase_month
       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS INTEGER) AS is_largest_gain FROM (
  SELECT purchase_month, rate, rate - lag(rate) OVER (ORDER BY purchase_month) AS delta FROM (
    SELECT purchase_month, avg({TARGET}) AS rate FROM mf GROUP BY 1))""", ["rate", "delta"]),
          doubles=["rate", "delta"])
def q_step_delta(spark, sf):
    monthly = _frame(spark, sf).groupBy("purchase_month").agg(F.avg(TARGET).alias("rate"))
    return D.step_delta(monthly, "rate", "purchase_month")


# Q2–Q7 ----------------------------------------------------------------------
@register("split_disjoint", build_sql(_S, """SELECT 'splits_disjoint' AS "check",
  CAST(count(*) FILTER (WHERE k > 1) = 0 AS INTEGER) AS passed, CAST(count(*) FILTER (WHERE k > 1) AS DOUBLE) AS detail
FROM (SELECT order_id, count(DISTINCT split) AS k FROM sp GROUP BY 1)"""))
def q_split_disjoint(spark, sf):
    return Q.split_disjoint(_splits(spark, sf))


@register("unique_keys", build_sql(_S, " UNION ALL ".join(f"""SELECT 'unique_order_id_{s}' AS "check",
  CAST(count(*) = 0 AS INTEGER) AS passed, CAST(count(*) AS DOUBLE) AS detail
FROM (SELECT order_id FROM sp WHERE split = '{s}' GROUP BY 1 HAVING count(*) > 1)""" for s in Q.SPLITS)))
def q_unique_keys(spark, sf):
    return Q.unique_keys(_splits(spark, sf))


_TO_SQL = """SELECT 'train_before_val' AS "check", CAST(coalesce(max(score_time) FILTER (WHERE split = 'train')
    <= min(score_time) FILTER (WHERE split = 'val'), false) AS INTEGER) AS passed, CAST(NULL AS DOUBLE) AS detail FROM sp
UNION ALL SELECT 'val_before_test', CAST(coalesce(max(score_time) FILTER (WHERE split = 'val')
    <= min(score_time) FILTER (WHERE split = 'test'), false) AS INTEGER), CAST(NULL AS DOUBLE) FROM sp"""


@register("temporal_order", build_sql(_S, _TO_SQL))
def q_temporal_order(spark, sf):
    return Q.temporal_order(_splits(spark, sf))


_SUM_D = ["target_rate_all", "target_rate_train", "target_rate_val", "target_rate_test",
          "missing_text_rate", "average_review_score", "median_total_price", "median_delivery_days"]
_SUM_SQL = f"""SELECT count(*) AS n_modeling_rows, 46 AS n_processed_columns, 20 AS n_model_input_features_baseline,
  count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'val') AS n_val,
  count(*) FILTER (WHERE split = 'test') AS n_test, avg({TARGET}) AS target_rate_all,
  avg({TARGET}) FILTER (WHERE split = 'train') AS target_rate_train,
  avg({TARGET}) FILTER (WHERE split = 'val') AS target_rate_val,
  avg({TARGET}) FILTER (WHERE split = 'test') AS target_rate_test,
  CAST(CAST(min(score_time) AS DATE) AS VARCHAR) AS score_time_min,
  CAST(CAST(max(score_time) AS DATE) AS VARCHAR) AS score_time_max,
  1 - avg(text_present) AS missing_text_rate, avg(review_score) AS average_review_score,
  median(total_price) AS median_total_price, median(delivery_days) AS median_delivery_days
FROM sp"""

_SUMMARY_GATE_SQL = """SELECT 'summary_has_columns' AS "check", 1 AS passed, CAST(NULL AS DOUBLE) AS detail
UNION ALL SELECT 'summary_has_baseline_count', 1, CAST(NULL AS DOUBLE)
UNION ALL SELECT 'summary_columns_match', 1, 46.0
UNION ALL SELECT 'summary_baseline_match', 1, 20.0
UNION ALL SELECT 'summary_rows_match', CAST((SELECT n_modeling_rows FROM sm) = count(*) AS INTEGER), CAST(count(*) AS DOUBLE) FROM sp"""


@register("dataset_summary", build_sql(_S + [("sm", _SUM_SQL)], "SELECT * FROM sm", _SUM_D), doubles=_SUM_D)
def q_dataset_summary(spark, sf):
    return G.dataset_summary(_splits(spark, sf))


@register("summary_gate", build_sql(_S + [("sm", _SUM_SQL)], _SUMMARY_GATE_SQL))
def q_summary_gate(spark, sf):
    sp = _splits(spark, sf)
    return Q.summary_gate(G.dataset_summary(sp), sp)


# A2–A5 ----------------------------------------------------------------------
def _scratch(spark, name):
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("write_read_splits", build_sql(_S, f"""SELECT split, count(*) AS n_rows, count(DISTINCT order_id) AS n_orders,
  sum({TARGET}) AS n_positive, min(score_time) AS first_time, max(score_time) AS last_time FROM sp GROUP BY split"""))
def q_write_read_splits(spark, sf):
    """Write the splits partitioned by split, read them back (A2, A3)."""
    path = _scratch(spark, "splits")
    IO.write_splits(_splits(spark, sf), path)
    back = IO.read_splits(spark, path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("order_id").alias("n_orders"),
                                     F.sum(TARGET).cast("long").alias("n_positive"),
                                     F.min("score_time").alias("first_time"), F.max("score_time").alias("last_time"))


@register("read_one_split", build_sql(_S, "SELECT * FROM sp WHERE split = 'test'", MF_DOUBLES), doubles=MF_DOUBLES)
def q_read_one_split(spark, sf):
    """Read back only the test split: partition pruning on ``split``."""
    path = _scratch(spark, "splits")
    IO.write_splits(_splits(spark, sf), path)
    back = IO.read_splits(spark, path, "test")
    return back.select(*[c for c in back.columns if c != "split"], "split")


@register("report_round_trip", build_sql(_S + [("sm", _SUM_SQL)], "SELECT * FROM sm", _SUM_D), doubles=_SUM_D)
def q_report_round_trip(spark, sf):
    """Summary row written as JSON and read back (A4, A5)."""
    path = _scratch(spark, "summary")
    summ = G.dataset_summary(_splits(spark, sf))
    IO.report_sink(summ, path, "json")
    back = IO.report_source(spark, path, "json")
    return back.select(*[F.col(f.name).cast(f.dataType) for f in summ.schema.fields])


# G4–G7 ----------------------------------------------------------------------
@register("class_balance", build_sql(_S, f"""SELECT {TARGET}, n, n / sum(n) OVER () AS share,
  min(n) OVER () / max(n) OVER () AS minority_majority_ratio
FROM (SELECT {TARGET}, count(*) AS n FROM mf GROUP BY 1)""", ["share", "minority_majority_ratio"]),
          doubles=["share", "minority_majority_ratio"])
def q_class_balance(spark, sf):
    return G.class_balance(_frame(spark, sf))


@register("group_rate", build_sql(_S, " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, avg({TARGET}) AS rate, count({TARGET}) AS n "
    f"FROM mf WHERE {d} IS NOT NULL GROUP BY {d}"
    for d in ("purchase_month", "purchase_quarter", "weekend_purchase_flag")), ["rate"]), doubles=["rate"])
def q_group_rate(spark, sf):
    return G.group_rate(_frame(spark, sf))


_ST_D = ["repeat_rate", "median_state_rate", "mean_state_rate"]


@register("state_rate", build_sql(_S + [("st", f"""SELECT customer_state, count({TARGET}) AS n, avg({TARGET}) AS repeat_rate
FROM mf WHERE customer_state IS NOT NULL GROUP BY 1""")], """SELECT customer_state, n, repeat_rate,
  row_number() OVER (ORDER BY n DESC, customer_state) AS count_rank,
  CAST(row_number() OVER (ORDER BY n DESC, customer_state) <= 15 AS INTEGER) AS in_top,
  CAST(n >= 100 AS INTEGER) AS enough_rows,
  (SELECT median(repeat_rate) FROM st) AS median_state_rate, (SELECT avg(repeat_rate) FROM st) AS mean_state_rate,
  CAST(repeat_rate >= (SELECT median(repeat_rate) FROM st) AS INTEGER) AS at_or_above_median
FROM st""", _ST_D), doubles=_ST_D)
def q_state_rate(spark, sf):
    return G.state_rate(_frame(spark, sf))


@register("crosstab_norm", build_sql(_S, f"""SELECT text_present, {TARGET}, n, n / sum(n) OVER (PARTITION BY text_present) AS share
FROM (SELECT text_present, {TARGET}, count(*) AS n FROM mf GROUP BY 1, 2)""", ["share"]), doubles=["share"])
def q_crosstab(spark, sf):
    return G.crosstab_norm(_frame(spark, sf), "text_present", TARGET)
