"""Group statistics over the model frame (G4–G8). One aggregate per scan;
results are small (one row per class / group / state)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import global_rank

TARGET = "target_repeat_within_180d"


# G4
def class_balance(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Count and share per class, plus minority/majority ratio."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    ratio = counts.agg((F.min("n") / F.max("n"))).scalar()
    return counts.select(label, "n", (F.col("n") / total).alias("share"),
                         ratio.alias("minority_majority_ratio"))


def _long(df: DataFrame, dims: list[str], extra: list[str]) -> DataFrame:
    """One row per (input row, dimension): (dimension, value, *extra)."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
                      for d in dims])
    return df.select(F.explode(pairs).alias("_p"), *extra).select("_p.dimension", "_p.value", *extra)


# G5
def group_rate(df: DataFrame, dims=("purchase_month", "purchase_quarter", "weekend_purchase_flag"),
               target: str = TARGET) -> DataFrame:
    """Mean target and count per value of each dimension, all dimensions in
    one scan and one shuffle (long form: dimension, value)."""
    long = _long(df.filter(F.col(target).isNotNull()), list(dims), [target])
    return (long.filter(F.col("value").isNotNull())
                .groupBy("dimension", "value")
                .agg(F.avg(target).alias("rate"), F.count(target).alias("n")))


# G6
def state_rate(df: DataFrame, state: str = "customer_state", target: str = TARGET,
               top: int = 15, min_count: int = 100) -> DataFrame:
    """Per state: count, repeat rate, rank by count (top ``top`` flagged),
    whether it has at least ``min_count`` rows, and its rate against the
    median and mean of all state rates."""
    stats = (df.filter(F.col(state).isNotNull())
               .groupBy(state).agg(F.count(target).alias("n"), F.avg(target).alias("repeat_rate")))
    ranked = global_rank(stats, [("n", False), state], name="count_rank")
    med = stats.agg(F.median("repeat_rate")).scalar()
    mean = stats.agg(F.avg("repeat_rate")).scalar()
    return ranked.select(
        state, "n", "repeat_rate", "count_rank",
        (F.col("count_rank") <= top).cast("int").alias("in_top"),
        (F.col("n") >= min_count).cast("int").alias("enough_rows"),
        med.alias("median_state_rate"), mean.alias("mean_state_rate"),
        (F.col("repeat_rate") >= med).cast("int").alias("at_or_above_median"),
    )


# G7
def crosstab_norm(df: DataFrame, row: str, col: str) -> DataFrame:
    """Two-way table in long form, each row's shares summing to 1."""
    cells = (df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
               .groupBy(row, col).agg(F.count(F.lit(1)).alias("n")))
    totals = cells.groupBy(row).agg(F.sum("n").alias("_row_n"))
    return (cells.join(totals, row)
                 .select(row, col, "n", (F.col("n") / F.col("_row_n")).alias("share")))


# G8
def dataset_summary(df: DataFrame, split: str = "split", target: str = TARGET) -> DataFrame:
    """The dataset summary as one row: counts, target rates per split,
    score-time range, missing-text rate, means and exact medians."""
    from .profile import melt, quantile_columns
    s = F.col(split)
    y = F.col(target)
    meds = quantile_columns(melt(df, ["total_price", "delivery_days"]), ["feature"], {"median": 0.5})

    def med(c):
        return meds.filter(F.col("feature") == c).select("median").scalar()
    return df.agg(
        F.count(F.lit(1)).alias("n_modeling_rows"),
        F.lit(len(df.columns) - 1).alias("n_processed_columns"),
        F.lit(20).alias("n_model_input_features_baseline"),
        F.count(F.when(s == "train", 1)).alias("n_train"),
        F.count(F.when(s == "val", 1)).alias("n_val"),
        F.count(F.when(s == "test", 1)).alias("n_test"),
        F.avg(y).alias("target_rate_all"),
        F.avg(F.when(s == "train", y)).alias("target_rate_train"),
        F.avg(F.when(s == "val", y)).alias("target_rate_val"),
        F.avg(F.when(s == "test", y)).alias("target_rate_test"),
        F.to_date(F.min("score_time")).cast("string").alias("score_time_min"),
        F.to_date(F.max("score_time")).cast("string").alias("score_time_max"),
        (1 - F.avg("text_present")).alias("missing_text_rate"),
        F.avg("review_score").alias("average_review_score"),
        med("total_price").alias("median_total_price"),
        med("delivery_days").alias("median_delivery_days"),
    )
