"""First-order cohort with a censored "buys again within N days" label.

B1 delivered_orders        B6 first_order_per_customer
B2 orders_customers        B7 dataset_end
B3 one_review_per_order    B8 eligible_filter
B4 orders_reviews          B9 next_purchase_after
B5 score_time              B10 repeat_label
                           B11 first_order_cohort (all of the above)

Plan shape at scale: two hash aggregates (per order, per person) with
partial aggregation before the exchange, one equi-join on the person key
with a ``>`` residual (hot persons are split by AQE skew-join; the other
side holds one row per person), and a scalar subquery for the dataset end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REVIEW_COLUMNS = [
    "review_id", "order_id", "review_score", "review_comment_title",
    "review_comment_message", "review_creation_date", "review_answer_timestamp",
]


def first_non_null(col: str, order: Column) -> Column:
    """Value of ``col`` on the first row (by ``order``) where it is not null.

    ``min_by`` skips rows whose ordering is null, so nulling the ordering
    where the value is null gives the per-column "first non-null" of a
    pandas ``groupby().first()``: one result row may mix source rows.
    """
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), order)).alias(col)


def _nulls_last(*cols: str) -> list[Column]:
    out = []
    for c in cols:
        out += [F.col(c).isNull(), F.col(c)]
    return out


# B1
def delivered_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(
        (F.col("order_status") == "delivered")
        & F.col("order_purchase_timestamp").isNotNull()
        & F.col("order_delivered_customer_date").isNotNull()
    )


# B2
def orders_customers(delivered: DataFrame, customers: DataFrame) -> DataFrame:
    cust = customers.select("customer_id", "customer_unique_id", "customer_state")
    return delivered.join(cust, "customer_id", "left")


# B3
def one_review_per_order(reviews: DataFrame) -> DataFrame:
    """Earliest review per order by (creation, answer), nulls last, review_id
    as the final tie-break; every column is its first non-null value."""
    cols = [c for c in REVIEW_COLUMNS if c in reviews.columns and c != "order_id"]
    order = F.struct(*_nulls_last("review_creation_date", "review_answer_timestamp"),
                     F.col("review_id"))
    return (reviews.filter(F.col("order_id").isNotNull())
                   .groupBy("order_id")
                   .agg(*[first_non_null(c, order) for c in cols]))


# B4
def orders_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    return orders.join(one_review_per_order(reviews), "order_id", "left")


# B5
def score_time(df: DataFrame) -> DataFrame:
    """Latest of delivery and review creation, skipping nulls."""
    delivered = F.col("order_delivered_customer_date")
    review = F.col("review_creation_date") if "review_creation_date" in df.columns else F.lit(None)
    return df.withColumn("score_time", F.coalesce(F.greatest(delivered, review), delivered))


# B6
def first_order_per_customer(df: DataFrame, person: str = "customer_unique_id") -> DataFrame:
    """First order per person by (purchase time, order_id); per-column first
    non-null values; rows without a person key are dropped."""
    order = F.struct(F.col("order_purchase_timestamp"), F.col("order_id"))
    cols = [c for c in df.columns if c != person]
    return (df.filter(F.col(person).isNotNull())
              .groupBy(person)
              .agg(*[first_non_null(c, order) for c in cols]))


# B7
def dataset_end(delivered: DataFrame) -> Column:
    """Latest purchase among delivered orders, as a scalar subquery column."""
    return delivered.agg(F.max("order_purchase_timestamp")).scalar()


# B8
def eligible_filter(first: DataFrame, end: Column, window_days: int = 180) -> DataFrame:
    """Right-censoring: keep people whose whole label window is observed."""
    out = first.withColumn("eligible_end_time",
                           F.col("score_time") + F.make_dt_interval(F.lit(window_days)))
    return out.filter(F.col("eligible_end_time") <= end)


# B9
def next_purchase_after(first: DataFrame, purchases: DataFrame,
                        person: str = "customer_unique_id") -> DataFrame:
    """Earliest purchase strictly after the score time of the first order.

    An equi-join on the person key with ``>`` as a residual predicate, then a
    min per person (partial aggregation collapses hot persons map-side).
    """
    p = purchases.filter(F.col(person).isNotNull()).select(
        F.col(person).alias("_p"), F.col("order_purchase_timestamp").alias("_ts"))
    s = first.select(F.col(person).alias("_p"), F.col("score_time").alias("_st"))
    nxt = (s.join(p, "_p").filter(F.col("_ts") > F.col("_st"))
             .groupBy("_p").agg(F.min("_ts").alias("next_purchase_after_score"))
             .withColumnRenamed("_p", person))
    return first.join(nxt, person, "left")


# B10
def repeat_label(df: DataFrame, window_days: int = 180,
                 name: str = "target_repeat_within_180d") -> DataFrame:
    limit = F.col("score_time") + F.make_dt_interval(F.lit(window_days))
    nxt = F.col("next_purchase_after_score")
    return df.withColumn(name, F.coalesce(nxt.isNotNull() & (nxt <= limit), F.lit(False)).cast("int"))


# B11
def first_order_cohort(tables: dict, window_days: int = 180, materialize_first: bool = True) -> DataFrame:
    """One row per person: the first delivered order, its review, score time
    and the forward-looking label."""
    delivered = delivered_orders(tables["orders"])
    dc = orders_customers(delivered, tables["customers"])
    d = score_time(orders_reviews(dc, tables["order_reviews"]))
    first = first_order_per_customer(d)
    first = eligible_filter(first, dataset_end(delivered), window_days)
    if materialize_first:
        # one row per person, read twice by the next-purchase join
        from ..session import materialize
        first = materialize(first)
    first = next_purchase_after(first, dc)  # purchases need no review columns
    name = f"target_repeat_within_{window_days}d"
    return repeat_label(first, window_days, name)
