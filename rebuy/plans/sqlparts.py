"""Oracle SQL building blocks (DuckDB dialect) for the cohort and model
frame. They restate the operators' semantics independently: window
``row_number`` + ``arg_min FILTER`` for first-non-null, explicit count/rank
for modes, epoch arithmetic for durations.
"""

from __future__ import annotations

from .registry import views

REVIEW_COLS = ["review_id", "review_score", "review_comment_message",
               "review_creation_date", "review_answer_timestamp"]
DELIVERED_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
                  "order_approved_at", "order_delivered_customer_date",
                  "order_estimated_delivery_date", "customer_state"]


def _argmin(cols, rank="rn"):
    return ",\n  ".join(f"arg_min({c}, {rank}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in cols)


def cohort_ctes(window_days: int = 180):
    first_cols = DELIVERED_COLS + REVIEW_COLS + ["score_time"]
    return views("orders", "customers", "order_reviews") + [
        ("d", """SELECT o.*, c.customer_unique_id, c.customer_state
FROM v_orders o LEFT JOIN v_customers c ON o.customer_id = c.customer_id
WHERE o.order_status = 'delivered' AND o.order_purchase_timestamp IS NOT NULL
  AND o.order_delivered_customer_date IS NOT NULL"""),
        ("rr", """SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY review_creation_date NULLS LAST,
  review_answer_timestamp NULLS LAST, review_id) AS rn
FROM v_order_reviews WHERE order_id IS NOT NULL"""),
        ("r1", f"SELECT order_id,\n  {_argmin(REVIEW_COLS)}\nFROM rr GROUP BY order_id"),
        ("dr", f"""SELECT d.*, {', '.join('r1.' + c for c in REVIEW_COLS)},
  coalesce(greatest(d.order_delivered_customer_date, r1.review_creation_date), d.order_delivered_customer_date) AS score_time
FROM d LEFT JOIN r1 ON d.order_id = r1.order_id"""),
        ("fr", """SELECT *, row_number() OVER (PARTITION BY customer_unique_id
  ORDER BY order_purchase_timestamp, order_id) AS rn
FROM dr WHERE customer_unique_id IS NOT NULL"""),
        ("f1", f"SELECT customer_unique_id,\n  {_argmin(first_cols)}\nFROM fr GROUP BY customer_unique_id"),
        ("el", f"""SELECT *, score_time + INTERVAL {window_days} DAY AS eligible_end_time FROM f1
WHERE score_time + INTERVAL {window_days} DAY <= (SELECT max(order_purchase_timestamp) FROM d)"""),
        ("nx", """SELECT el.customer_unique_id, min(dr.order_purchase_timestamp) AS next_purchase_after_score
FROM el JOIN dr ON el.customer_unique_id = dr.customer_unique_id
  AND dr.order_purchase_timestamp > el.score_time
GROUP BY el.customer_unique_id"""),
        ("cohort", f"""SELECT el.*, nx.next_purchase_after_score,
  CAST(coalesce(nx.next_purchase_after_score <= el.score_time + INTERVAL {window_days} DAY, false) AS INTEGER)
    AS target_repeat_within_{window_days}d
FROM el LEFT JOIN nx ON el.customer_unique_id = nx.customer_unique_id"""),
    ]


def _mode_cte(name, src, col, out):
    """Most frequent non-null value per order, smallest on ties, 'unknown'
    when the order has rows but no value."""
    return (name, f"""SELECT o.order_id, coalesce(m.v, 'unknown') AS {out}
FROM (SELECT DISTINCT order_id FROM {src} WHERE order_id IS NOT NULL) o
LEFT JOIN (
  SELECT order_id, min(v) AS v FROM (
    SELECT order_id, v, rank() OVER (PARTITION BY order_id ORDER BY n DESC) AS rk
    FROM (SELECT order_id, CAST({col} AS VARCHAR) AS v, count(*) AS n FROM {src}
          WHERE {col} IS NOT NULL AND order_id IS NOT NULL GROUP BY 1, 2)
  ) WHERE rk = 1 GROUP BY order_id
) m ON o.order_id = m.order_id""")


LOG_COLS = ["total_price", "total_freight", "payment_value_total", "product_weight_g_mean",
            "package_volume_cm3_mean", "approval_lag_hours", "delivery_days"]

MF_DOUBLES = ["total_price", "total_freight", "payment_value_total", "approval_lag_hours",
              "delivery_days", "delivery_delay_days", "delivery_delay_days_clipped", "freight_ratio",
              "payment_gap", "product_weight_g_mean", "package_volume_cm3_mean",
              "product_photos_qty_mean", "product_description_lenght_mean"] + [f"log1p_{c}" for c in LOG_COLS]


def model_frame_ctes(window_days: int = 180):
    sentinel = "'__NO_REVIEW_TEXT__'"
    logs = ",\n  ".join(f"CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest({c}, 0)) END AS log1p_{c}" for c in LOG_COLS)
    return cohort_ctes(window_days) + views("order_items", "order_payments", "products",
                                            "category_translation", "sellers") + [
        ("items", """SELECT i.*, p.product_weight_g, p.product_photos_qty, p.product_description_lenght,
  t.product_category_name_english AS product_category_name_en, s.seller_state,
  CAST(coalesce(p.product_length_cm, 0) AS DOUBLE) * coalesce(p.product_height_cm, 0) * coalesce(p.product_width_cm, 0)
    AS package_volume_cm3
FROM v_order_items i
LEFT JOIN v_products p ON i.product_id = p.product_id
LEFT JOIN v_category_translation t ON p.product_category_name = t.product_category_name
LEFT JOIN v_sellers s ON i.seller_id = s.seller_id
WHERE i.order_id IN (SELECT order_id FROM cohort)"""),
        ("pays", "SELECT * FROM v_order_payments WHERE order_id IN (SELECT order_id FROM cohort)"),
        ("ia", """SELECT order_id, coalesce(CAST(sum(CAST(price AS DECIMAL(38,6))) AS DOUBLE), 0) AS total_price,
  coalesce(CAST(sum(CAST(freight_value AS DECIMAL(38,6))) AS DOUBLE), 0) AS total_freight,
  count(order_item_id) AS item_count, count(DISTINCT seller_id) AS seller_count,
  count(DISTINCT product_id) AS product_count, avg(product_weight_g) AS product_weight_g_mean,
  avg(package_volume_cm3) AS package_volume_cm3_mean, avg(product_photos_qty) AS product_photos_qty_mean,
  avg(product_description_lenght) AS product_description_lenght_mean
FROM items WHERE order_id IS NOT NULL GROUP BY order_id"""),
        _mode_cte("cat_mode", "items", "product_category_name_en", "product_category_main"),
        _mode_cte("sel_mode", "items", "seller_state", "seller_state_mode"),
        ("pa", """SELECT order_id, coalesce(CAST(sum(CAST(payment_value AS DECIMAL(38,6))) AS DOUBLE), 0) AS payment_value_total,
  max(payment_installments) AS payment_installments_max, count(payment_sequential) AS payment_records,
  count(DISTINCT payment_type) AS payment_type_nunique
FROM pays WHERE order_id IS NOT NULL GROUP BY order_id"""),
        _mode_cte("pay_mode", "pays", "payment_type", "payment_type_mode"),
        ("j", f"""SELECT c.*, ia.total_price, ia.total_freight, ia.item_count, ia.seller_count, ia.product_count,
  ia.product_weight_g_mean, ia.package_volume_cm3_mean, ia.product_photos_qty_mean,
  ia.product_description_lenght_mean, cm.product_category_main, sm.seller_state_mode,
  pa.payment_value_total, pa.payment_installments_max, pa.payment_records, pa.payment_type_nunique,
  pm.payment_type_mode,
  coalesce(nullif(c.review_comment_message, ''), {sentinel}) AS review_text
FROM cohort c
LEFT JOIN ia ON c.order_id = ia.order_id
LEFT JOIN cat_mode cm ON c.order_id = cm.order_id
LEFT JOIN sel_mode sm ON c.order_id = sm.order_id
LEFT JOIN pa ON c.order_id = pa.order_id
LEFT JOIN pay_mode pm ON c.order_id = pm.order_id"""),
        ("k", f"""SELECT *,
  CASE WHEN review_text = {sentinel} THEN '' ELSE review_text END AS clean_text,
  (epoch_us(order_approved_at) - epoch_us(order_purchase_timestamp)) / 3.6e9 AS approval_lag_hours,
  (epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 8.64e10 AS delivery_days,
  (epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date)) / 8.64e10 AS delivery_delay_days,
  CASE WHEN total_price <> 0 THEN total_freight / total_price END AS freight_ratio,
  payment_value_total - (total_price + total_freight) AS payment_gap
FROM j"""),
        ("mf", f"""SELECT customer_unique_id, order_id, score_time, target_repeat_within_{window_days}d, review_score,
  review_text, CAST(review_text <> {sentinel} AS INTEGER) AS text_present,
  CAST(length(clean_text) AS INTEGER) AS text_char_len,
  CAST(len(list_filter(string_split_regex(clean_text, '\\s+'), lambda x: x <> '')) AS INTEGER) AS text_word_count,
  CAST(length(clean_text) - length(replace(clean_text, '!', '')) AS INTEGER) AS exclamation_count,
  CAST(length(clean_text) - length(replace(clean_text, '?', '')) AS INTEGER) AS question_count,
  total_price, total_freight, payment_value_total, payment_installments_max, payment_records,
  payment_type_nunique, payment_type_mode, item_count, seller_count, product_count,
  product_category_main, seller_state_mode, customer_state,
  CAST(coalesce(seller_state_mode = customer_state, false) AS INTEGER) AS same_state_seller_customer,
  approval_lag_hours, delivery_days, delivery_delay_days,
  CASE WHEN delivery_delay_days IS NOT NULL THEN least(greatest(delivery_delay_days, -30), 30) END AS delivery_delay_days_clipped,
  CAST(coalesce(delivery_delay_days > 0, false) AS INTEGER) AS late_delivery_flag,
  freight_ratio, payment_gap, product_weight_g_mean, package_volume_cm3_mean, product_photos_qty_mean,
  product_description_lenght_mean,
  CAST(month(order_purchase_timestamp) AS INTEGER) AS purchase_month,
  CAST(quarter(order_purchase_timestamp) AS INTEGER) AS purchase_quarter,
  CAST(isodow(order_purchase_timestamp) IN (6, 7) AS INTEGER) AS weekend_purchase_flag,
  {logs}
FROM k"""),
    ]
