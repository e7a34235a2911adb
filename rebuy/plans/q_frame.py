"""Registered queries: sources, cohort, model frame and its column
functions (A1, B1–B16, G1–G3, C1–C11)."""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import assemble as A
from ..operators import cohort as C
from ..session import materialize, remove, shared_path
from ..sources import io as IO
from ..sources.retail import retail_tables, with_messages
from .registry import build_sql, materialized, register, views
from .sqlparts import DELIVERED_COLS, MF_DOUBLES, REVIEW_COLS, cohort_ctes, model_frame_ctes

RETAIL = ["orders", "customers", "sellers", "category_translation", "products",
          "order_items", "order_payments", "order_reviews"]


def _tables(spark, sf):
    return retail_tables(spark, sf)


def _cohort(spark, sf):
    return C.first_order_cohort(_tables(spark, sf))


def _frame_plan(spark, sf):
    """Reviews travel as references; only the cohort's messages are read."""
    t = retail_tables(spark, sf, refs=True)
    return A.model_frame(t, C.first_order_cohort(t), lambda df: with_messages(df, spark, sf))


def _frame(spark, sf):
    """The model frame, checkpointed once per session and data folder: the
    analytics queries start from this written table instead of re-planning
    the cohort (short lineage, no recomputation after a lost executor)."""
    return materialized(spark, sf, "model_frame", lambda: _frame_plan(spark, sf))


# A1 -------------------------------------------------------------------------
@register("load_tables", build_sql(views(*RETAIL), " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys FROM v_{n}"
    for n, k in [("orders", "order_id"), ("customers", "customer_id"), ("sellers", "seller_id"),
                 ("category_translation", "product_category_name"), ("products", "product_id"),
                 ("order_items", "order_id"), ("order_payments", "order_id"),
                 ("order_reviews", "review_id")])))
def q_load_tables(spark, sf):
    """Row and key counts of every retail table (one aggregate per scan)."""
    keys = {"orders": "order_id", "customers": "customer_id", "sellers": "seller_id",
            "category_translation": "product_category_name", "products": "product_id",
            "order_items": "order_id", "order_payments": "order_id", "order_reviews": "review_id"}
    t = _tables(spark, sf)
    parts = [t[n].agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                      F.countDistinct(k).alias("n_keys")) for n, k in keys.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


_CSV = {"orders": ("order_id", "order_purchase_timestamp"), "customers": ("customer_id", "customer_state"),
        "sellers": ("seller_id", "seller_state"), "products": ("product_id", "product_category_name"),
        "category_translation": ("product_category_name", "product_category_name_english"),
        "order_items": ("order_id", "seller_id"), "order_payments": ("order_id", "payment_type"),
        "order_reviews": ("review_id", "review_comment_message")}


@register("load_tables_csv", build_sql(views(*RETAIL), " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys, count(nullif(CAST({c} AS VARCHAR), '')) AS n_values,
  CAST(sum(length(CAST({c} AS VARCHAR))) AS BIGINT) AS n_chars FROM v_{n}""" for n, (k, c) in _CSV.items())))
def q_load_tables_csv(spark, sf):
    """Every retail table written as CSV and read back by the raw-table
    source: rows, keys, and the values and characters of one column. An
    empty field is NULL. Texts take many times the room of the Parquet tables
    they come from, so files are compressed, and a table's files go when it
    has been read."""
    t = _tables(spark, sf)
    parts = []
    for n, (k, c) in _CSV.items():
        path = shared_path(spark, f"raw-{uuid.uuid4().hex}/{n}")
        IO.write_csv(t[n], path, "gzip")
        back = IO.load_tables(spark, {n: path}, {n: t[n].schema}, multiline=("order_reviews",))[n]
        parts.append(materialize(back.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct(k).alias("n_keys"),
                                          F.count(c).alias("n_values"), F.sum(F.length(F.col(c).cast("string"))).alias("n_chars")), "raw-counts"))
        remove(spark, os.path.dirname(path))
    return reduce(lambda a, b: a.unionByName(b), parts)


# B1–B11 ---------------------------------------------------------------------
_B = cohort_ctes()


@register("delivered_orders", build_sql(views("orders"), """SELECT * FROM v_orders
WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL
  AND order_delivered_customer_date IS NOT NULL"""))
def q_delivered(spark, sf):
    return C.delivered_orders(_tables(spark, sf)["orders"])


@register("orders_customers", build_sql(_B, "SELECT * FROM d"))
def q_orders_customers(spark, sf):
    t = _tables(spark, sf)
    return C.orders_customers(C.delivered_orders(t["orders"]), t["customers"])


@register("one_review_per_order", build_sql(_B, "SELECT * FROM r1"))
def q_one_review(spark, sf):
    return C.one_review_per_order(_tables(spark, sf)["order_reviews"])


@register("orders_reviews", build_sql(_B, f"SELECT {', '.join(DELIVERED_COLS)}, customer_unique_id, "
                                          f"{', '.join(REVIEW_COLS)} FROM dr"))
def q_orders_reviews(spark, sf):
    t = _tables(spark, sf)
    d = C.orders_customers(C.delivered_orders(t["orders"]), t["customers"])
    return C.orders_reviews(d, t["order_reviews"])


@register("score_time", build_sql(_B, "SELECT order_id, customer_unique_id, order_delivered_customer_date, "
                                      "review_creation_date, score_time FROM dr"))
def q_score_time(spark, sf):
    t = _tables(spark, sf)
    d = C.orders_customers(C.delivered_orders(t["orders"]), t["customers"])
    d = C.score_time(C.orders_reviews(d, t["order_reviews"]))
    return d.select("order_id", "customer_unique_id", "order_delivered_customer_date",
                    "review_creation_date", "score_time")


def _first(spark, sf):
    t = _tables(spark, sf)
    d = C.orders_customers(C.delivered_orders(t["orders"]), t["customers"])
    return t, C.score_time(C.orders_reviews(d, t["order_reviews"]))


@register("first_order_per_customer", build_sql(_B, "SELECT * FROM f1"))
def q_first_order(spark, sf):
    _, d = _first(spark, sf)
    return C.first_order_per_customer(d)


@register("dataset_end", build_sql(_B, "SELECT max(order_purchase_timestamp) AS dataset_end FROM d"))
def q_dataset_end(spark, sf):
    _, d = _first(spark, sf)
    return d.agg(F.max("order_purchase_timestamp").alias("dataset_end"))


@register("eligible_filter", build_sql(_B, "SELECT * FROM el"))
def q_eligible(spark, sf):
    t, d = _first(spark, sf)
    return C.eligible_filter(C.first_order_per_customer(d), C.dataset_end(C.delivered_orders(t["orders"])))


@register("next_purchase_after", build_sql(_B, """SELECT el.customer_unique_id, el.score_time,
  nx.next_purchase_after_score FROM el LEFT JOIN nx ON el.customer_unique_id = nx.customer_unique_id"""))
def q_next_purchase(spark, sf):
    t, d = _first(spark, sf)
    e = C.eligible_filter(C.first_order_per_customer(d), C.dataset_end(C.delivered_orders(t["orders"])))
    return C.next_purchase_after(e, d).select("customer_unique_id", "score_time", "next_purchase_after_score")


@register("repeat_label", build_sql(_B, """SELECT target_repeat_within_180d, count(*) AS n_customers
FROM cohort GROUP BY 1"""))
def q_repeat_label(spark, sf):
    """What share of first-time customers buys again within 180 days?"""
    return _cohort(spark, sf).groupBy("target_repeat_within_180d").agg(F.count(F.lit(1)).alias("n_customers"))


@register("first_order_cohort", build_sql(_B, "SELECT * FROM cohort"))
def q_cohort(spark, sf):
    return _cohort(spark, sf)


# B12–B16, G1–G3 -------------------------------------------------------------
_M = model_frame_ctes()


@register("cohort_semi_join", build_sql(_M, "SELECT * FROM v_order_items WHERE order_id IN (SELECT order_id FROM cohort)"))
def q_semi(spark, sf):
    t = _tables(spark, sf)
    return A.cohort_semi_join(t["order_items"], C.first_order_cohort(t))


@register("category_translate", build_sql(views("products", "category_translation"), """SELECT p.*,
  t.product_category_name_english AS product_category_name_en
FROM v_products p LEFT JOIN v_category_translation t ON p.product_category_name = t.product_category_name"""))
def q_translate(spark, sf):
    t = _tables(spark, sf)
    return A.category_translate(t["products"], t["category_translation"])


@register("item_enrich", build_sql(_M, """SELECT order_id, order_item_id, product_id, seller_id,
  product_category_name_en, seller_state, package_volume_cm3 FROM items""", ["package_volume_cm3"]),
          doubles=["package_volume_cm3"])
def q_item_enrich(spark, sf):
    t = _tables(spark, sf)
    items = A.cohort_semi_join(t["order_items"], C.first_order_cohort(t))
    products = A.category_translate(t["products"], t["category_translation"])
    return A.item_enrich(items, products, t["sellers"]).select(
        "order_id", "order_item_id", "product_id", "seller_id", "product_category_name_en",
        "seller_state", "package_volume_cm3")


def _items(spark, sf):
    t = _tables(spark, sf)
    cohort = C.first_order_cohort(t)
    products = A.category_translate(t["products"], t["category_translation"])
    return t, cohort, A.item_enrich(A.cohort_semi_join(t["order_items"], cohort), products, t["sellers"])


_IA_D = ["total_price", "total_freight", "product_weight_g_mean", "package_volume_cm3_mean",
         "product_photos_qty_mean", "product_description_lenght_mean"]


@register("item_agg", build_sql(_M, """SELECT ia.*, cm.product_category_main, sm.seller_state_mode
FROM ia JOIN cat_mode cm ON ia.order_id = cm.order_id JOIN sel_mode sm ON ia.order_id = sm.order_id""",
                                _IA_D), doubles=_IA_D)
def q_item_agg(spark, sf):
    _, _, items = _items(spark, sf)
    return A.item_agg(items)


@register("payment_agg", build_sql(_M, """SELECT pa.*, pm.payment_type_mode
FROM pa JOIN pay_mode pm ON pa.order_id = pm.order_id""", ["payment_value_total"]),
          doubles=["payment_value_total"])
def q_payment_agg(spark, sf):
    t = _tables(spark, sf)
    return A.payment_agg(A.cohort_semi_join(t["order_payments"], C.first_order_cohort(t)))


@register("mode_or_unknown", build_sql(_M, """SELECT cm.order_id, cm.product_category_main, sm.seller_state_mode
FROM cat_mode cm JOIN sel_mode sm ON cm.order_id = sm.order_id"""))
def q_mode(spark, sf):
    _, _, items = _items(spark, sf)
    return items.groupBy("order_id").agg(
        A.mode_or_unknown("product_category_name_en").alias("product_category_main"),
        A.mode_or_unknown("seller_state").alias("seller_state_mode"))


_J_D = _IA_D + ["payment_value_total"]


@register("order_feature_join", build_sql(_M, """SELECT customer_unique_id, order_id, total_price, total_freight,
  item_count, seller_count, product_count, product_weight_g_mean, package_volume_cm3_mean,
  product_photos_qty_mean, product_description_lenght_mean, product_category_main, seller_state_mode,
  payment_value_total, payment_installments_max, payment_records, payment_type_nunique, payment_type_mode
FROM j""", _J_D), doubles=_J_D)
def q_feature_join(spark, sf):
    t, cohort, items = _items(spark, sf)
    pays = A.cohort_semi_join(t["order_payments"], cohort)
    j = A.order_feature_join(cohort, A.item_agg(items), A.payment_agg(pays))
    return j.drop(*[c for c in cohort.columns if c not in ("customer_unique_id", "order_id")])


@register("model_frame", build_sql(_M, "SELECT * FROM mf", MF_DOUBLES), doubles=MF_DOUBLES)
def q_model_frame(spark, sf):
    """The 46-column model frame built from the raw tables and written to
    the checkpoint folder; later analytics in the session read that copy."""
    return _frame(spark, sf)


# Column functions, shown on the model frame --------------------------
def _cols(name, cols, doubles=()):
    @register(name, build_sql(_M, f"SELECT order_id, {', '.join(cols)} FROM mf", list(doubles)),
              doubles=list(doubles))
    def q(spark, sf):
        return _frame(spark, sf).select("order_id", *cols)
    return q


_cols("text_sentinel", ["review_text", "text_present"])
_cols("text_lengths", ["text_char_len", "text_word_count"])
_cols("punct_counts", ["exclamation_count", "question_count"])
_cols("durations", ["approval_lag_hours", "delivery_days", "delivery_delay_days"],
      ["approval_lag_hours", "delivery_days", "delivery_delay_days"])
_cols("clip", ["delivery_delay_days_clipped"], ["delivery_delay_days_clipped"])
_cols("late_flag", ["late_delivery_flag"])
_cols("safe_ratio", ["freight_ratio"], ["freight_ratio"])
_cols("payment_gap", ["payment_gap"], ["payment_gap"])
_cols("same_state", ["same_state_seller_customer"])
_cols("calendar", ["purchase_month", "purchase_quarter", "weekend_purchase_flag"])
_cols("log1p_clipped", [f"log1p_{c}" for c in S.LOG_COLUMNS], [f"log1p_{c}" for c in S.LOG_COLUMNS])
