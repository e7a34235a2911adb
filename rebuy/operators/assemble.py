"""Order-level feature table (B12–B16) and the per-order aggregates it
joins (G1–G3).

Plan shape: items and payments are semi-joined to the cohort's orders
before anything else (runtime filters reach the scans), the two lookups
(products, sellers) are equi-joins the optimiser may broadcast when AQE
measures them small, and each source is aggregated once by ``order_id``;
the cohort and all aggregates are then hash-partitioned on ``order_id`` so
the chained left joins reuse one partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

# Fixed value: label for "no value at all" in a group (pandas mode helper).
UNKNOWN = "unknown"


# G3
def mode_or_unknown(c, unknown: str = UNKNOWN) -> Column:
    """Most frequent non-null value, smallest on ties; ``unknown`` if none."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.mode(col.cast("string"), True), F.lit(unknown))


# B12
def cohort_semi_join(df: DataFrame, cohort: DataFrame, key: str = "order_id") -> DataFrame:
    return df.join(cohort.select(key), key, "left_semi")


# B13
def category_translate(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Attach the English category name (NULL when untranslated). The
    translation (one row per category) is broadcast: by a shuffle, a category
    would be a task."""
    t = translation.select(
        F.col("product_category_name").alias("_cat_pt"),
        F.col("product_category_name_english").alias("product_category_name_en"))
    return products.join(F.broadcast(t), products.product_category_name == t._cat_pt, "left").drop("_cat_pt")


# B14
def item_enrich(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items with product attributes, seller state and package volume (null
    dimensions count as 0)."""
    out = (items.join(products, "product_id", "left")
                .join(sellers.select("seller_id", "seller_state"), "seller_id", "left"))
    dims = [F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            for c in ("product_length_cm", "product_height_cm", "product_width_cm")]
    return out.withColumn("package_volume_cm3", dims[0] * dims[1] * dims[2])


MONEY = "decimal(38,6)"


def money_sum(c: str) -> Column:
    """Exact sum of a money column (micro-units), 0 for a group of NULLs:
    the result does not depend on how rows are partitioned."""
    return F.coalesce(F.sum(F.col(c).cast(MONEY)).cast("double"), F.lit(0.0))


# G1
def item_agg(items: DataFrame) -> DataFrame:
    return (items.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        money_sum("price").alias("total_price"),
        money_sum("freight_value").alias("total_freight"),
        F.count("order_item_id").alias("item_count"),
        F.countDistinct("seller_id").alias("seller_count"),
        F.countDistinct("product_id").alias("product_count"),
        F.avg("product_weight_g").alias("product_weight_g_mean"),
        F.avg("package_volume_cm3").alias("package_volume_cm3_mean"),
        F.avg("product_photos_qty").alias("product_photos_qty_mean"),
        F.avg("product_description_lenght").alias("product_description_lenght_mean"),
        mode_or_unknown("product_category_name_en").alias("product_category_main"),
        mode_or_unknown("seller_state").alias("seller_state_mode"),
    ))


# G2
def payment_agg(payments: DataFrame) -> DataFrame:
    return (payments.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        money_sum("payment_value").alias("payment_value_total"),
        F.max("payment_installments").alias("payment_installments_max"),
        F.count("payment_sequential").alias("payment_records"),
        F.countDistinct("payment_type").alias("payment_type_nunique"),
        mode_or_unknown("payment_type").alias("payment_type_mode"),
    ))


# B15
def order_feature_join(cohort: DataFrame, *aggs: DataFrame) -> DataFrame:
    out = cohort
    for a in aggs:
        out = out.join(a, "order_id", "left")
    return out


# The output schema, the 43 numeric inputs of the network models
# and the 39 of the hybrid (the last 14 and 10 of them are engineered).
MODEL_FRAME_COLUMNS = [
    "customer_unique_id", "order_id", "score_time", "target_repeat_within_180d", "review_score", "review_text",
    "text_present", "text_char_len", "text_word_count", "exclamation_count", "question_count",
    "total_price", "total_freight", "payment_value_total", "payment_installments_max", "payment_records",
    "payment_type_nunique", "payment_type_mode", "item_count", "seller_count", "product_count",
    "product_category_main", "seller_state_mode", "customer_state", "same_state_seller_customer",
    "approval_lag_hours", "delivery_days", "delivery_delay_days", "delivery_delay_days_clipped", "late_delivery_flag",
    "freight_ratio", "payment_gap", "product_weight_g_mean", "package_volume_cm3_mean", "product_photos_qty_mean",
    "product_description_lenght_mean", "purchase_month", "purchase_quarter", "weekend_purchase_flag",
    "log1p_total_price", "log1p_total_freight", "log1p_payment_value_total", "log1p_product_weight_g_mean",
    "log1p_package_volume_cm3_mean", "log1p_approval_lag_hours", "log1p_delivery_days",
]
DL_NUMERIC = [
    "review_score", "text_present", "text_char_len", "text_word_count", "exclamation_count", "question_count",
    "log1p_total_price", "log1p_total_freight", "log1p_payment_value_total", "payment_installments_max",
    "payment_records", "payment_type_nunique", "item_count", "seller_count", "product_count",
    "same_state_seller_customer", "log1p_approval_lag_hours", "delivery_days", "delivery_delay_days_clipped",
    "late_delivery_flag", "freight_ratio", "payment_gap", "log1p_product_weight_g_mean",
    "log1p_package_volume_cm3_mean", "product_photos_qty_mean", "product_description_lenght_mean",
    "purchase_month", "purchase_quarter", "weekend_purchase_flag",
    "price_per_item", "freight_pct", "payment_overhead", "delivery_efficiency", "emotional_intensity",
    "word_density", "volume_weight_ratio", "desc_per_photo", "multi_seller", "multi_product", "multi_payment",
    "score_x_delivery", "text_x_score", "price_x_late",
]
HYBRID_NUMERIC = [
    "review_score", "text_present", "text_char_len", "text_word_count", "exclamation_count", "question_count",
    "log1p_total_price", "log1p_total_freight", "log1p_payment_value_total", "payment_installments_max",
    "payment_records", "payment_type_nunique", "item_count", "seller_count", "product_count",
    "same_state_seller_customer", "log1p_approval_lag_hours", "delivery_days", "delivery_delay_days_clipped",
    "late_delivery_flag", "freight_ratio", "payment_gap", "log1p_product_weight_g_mean",
    "log1p_package_volume_cm3_mean", "product_photos_qty_mean", "product_description_lenght_mean",
    "purchase_month", "purchase_quarter", "weekend_purchase_flag",
    "price_per_item", "freight_pct", "payment_overhead", "delivery_efficiency", "emotional_intensity",
    "word_density", "volume_weight_ratio", "score_x_delivery", "text_x_score", "price_x_late",
]


def derive_row_features(df: DataFrame) -> DataFrame:
    """C1–C11 on the joined frame (one projection)."""
    text = S.review_text("review_comment_message")
    clean = S.clean_text(text)
    month, quarter, weekend = S.calendar("order_purchase_timestamp")
    purchase = F.col("order_purchase_timestamp")
    out = df.withColumns({
        "review_text": text,
        "text_present": S.text_present(text),
        "text_char_len": S.char_len(clean),
        "text_word_count": S.word_count(clean),
        "exclamation_count": S.count_char(clean, "!"),
        "question_count": S.count_char(clean, "?"),
        "approval_lag_hours": S.hours_between(purchase, "order_approved_at"),
        "delivery_days": S.days_between(purchase, "order_delivered_customer_date"),
        "delivery_delay_days": S.days_between("order_estimated_delivery_date", "order_delivered_customer_date"),
        "freight_ratio": S.safe_ratio("total_freight", "total_price"),
        "payment_gap": S.payment_gap("payment_value_total", "total_price", "total_freight"),
        "same_state_seller_customer": S.equal_flag("seller_state_mode", "customer_state"),
        "purchase_month": month,
        "purchase_quarter": quarter,
        "weekend_purchase_flag": weekend,
    })
    out = out.withColumns({
        "delivery_delay_days_clipped": S.clip("delivery_delay_days", -30, 30),
        "late_delivery_flag": S.positive_flag("delivery_delay_days"),
    })
    return out.withColumns({f"log1p_{c}": S.log1p_clipped(c) for c in S.LOG_COLUMNS})


# B16
def model_frame(tables: dict, cohort: DataFrame, messages: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The 46-column order-level table, one row per cohort member. The
    cohort is read three times (frame, item and payment semi-joins), so it
    is written once first. ``messages`` puts the review texts into a cohort
    that holds references to them, after the last join by order."""
    from ..session import materialize
    cohort = materialize(cohort)
    products = category_translate(tables["products"], tables["category_translation"])
    items = cohort_semi_join(tables["order_items"], cohort)
    items = item_enrich(items, products, tables["sellers"])
    payments = cohort_semi_join(tables["order_payments"], cohort)
    joined = order_feature_join(cohort, item_agg(items), payment_agg(payments))
    joined = messages(joined) if messages else joined
    return derive_row_features(joined).select(*MODEL_FRAME_COLUMNS)


def build_model_frame(tables: dict, window_days: int = 180) -> DataFrame:
    from .cohort import first_order_cohort
    return model_frame(tables, first_order_cohort(tables, window_days))


# Column groups of the model frame used by the analytics operators.
NUMERIC_COLUMNS = [
    "review_score", "text_present", "text_char_len", "text_word_count", "exclamation_count", "question_count",
    "total_price", "total_freight", "payment_value_total", "payment_installments_max", "payment_records",
    "payment_type_nunique", "item_count", "seller_count", "product_count", "same_state_seller_customer",
    "approval_lag_hours", "delivery_days", "delivery_delay_days", "delivery_delay_days_clipped",
    "late_delivery_flag", "freight_ratio", "payment_gap", "product_weight_g_mean", "package_volume_cm3_mean",
    "product_photos_qty_mean", "product_description_lenght_mean", "purchase_month", "purchase_quarter",
    "weekend_purchase_flag", "log1p_total_price", "log1p_total_freight", "log1p_payment_value_total",
    "log1p_product_weight_g_mean", "log1p_package_volume_cm3_mean", "log1p_approval_lag_hours",
    "log1p_delivery_days",
]
STRING_COLUMNS = ["payment_type_mode", "product_category_main", "seller_state_mode", "customer_state"]
CORR_COLUMNS = [
    "review_score", "text_present", "text_char_len", "text_word_count", "exclamation_count", "question_count",
    "log1p_total_price", "log1p_total_freight", "log1p_payment_value_total", "payment_installments_max",
    "payment_records", "payment_type_nunique", "item_count", "seller_count", "product_count",
    "same_state_seller_customer", "approval_lag_hours", "delivery_days", "delivery_delay_days_clipped",
    "late_delivery_flag", "freight_ratio", "log1p_product_weight_g_mean", "log1p_package_volume_cm3_mean",
    "product_photos_qty_mean", "product_description_lenght_mean", "purchase_month", "purchase_quarter",
    "weekend_purchase_flag", "target_repeat_within_180d",
]
OUTLIER_COLUMNS = ["total_price", "total_freight", "payment_value_total", "delivery_days",
                   "approval_lag_hours", "product_weight_g_mean", "package_volume_cm3_mean"]
