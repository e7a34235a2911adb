"""Column functions (C1–C19): built-in expressions only, so everything
stays inside whole-stage codegen. Each takes and returns ``Column``s or is
a ``DataFrame -> DataFrame`` transform that adds columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: placeholder for an order without review text.
NO_TEXT = "__NO_REVIEW_TEXT__"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# C1
def review_text(message) -> Column:
    """NULL or empty message -> the placeholder."""
    return F.coalesce(F.nullif(_c(message), F.lit("")), F.lit(NO_TEXT))


def text_present(text) -> Column:
    return (_c(text) != F.lit(NO_TEXT)).cast("int")


def clean_text(text) -> Column:
    return F.when(_c(text) == F.lit(NO_TEXT), F.lit("")).otherwise(_c(text))


# C2
def char_len(text) -> Column:
    return F.coalesce(F.length(_c(text)), F.lit(0)).cast("int")


def word_count(text) -> Column:
    """Whitespace-separated words; '' has none."""
    parts = F.split(F.coalesce(_c(text), F.lit("")), r"(?U)\s+")
    return F.size(F.filter(parts, lambda w: w != F.lit(""))).cast("int")


# C3
def count_char(text, ch: str) -> Column:
    return F.coalesce(F.regexp_count(_c(text), F.lit("\\" + ch if ch in "?*+.()[]{}|^$\\" else ch)),
                      F.lit(0)).cast("int")


# C4
def hours_between(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(3.6e9)


def days_between(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(8.64e10)


# C5
def clip(c, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a value; NULL stays NULL (greatest/least alone would skip it)."""
    x = _c(c)
    y = x
    if lower is not None:
        y = F.greatest(y, F.lit(float(lower)))
    if upper is not None:
        y = F.least(y, F.lit(float(upper)))
    return F.when(x.isNotNull(), y)


# C6
def positive_flag(c) -> Column:
    """1 when c > 0, else 0 (NULL -> 0)."""
    return F.coalesce(_c(c) > 0, F.lit(False)).cast("int")


# C7
def safe_ratio(num, den) -> Column:
    """num / den with 0 -> NULL and ±inf -> NULL."""
    r = F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))
    return F.when(~F.isnan(r) & (F.abs(r) != F.lit(float("inf"))), r)


# C8
def payment_gap(paid, price, freight) -> Column:
    return _c(paid) - (_c(price) + _c(freight))


# C9
def equal_flag(a, b) -> Column:
    return F.coalesce(_c(a) == _c(b), F.lit(False)).cast("int")


# C10
def calendar(ts) -> list[Column]:
    t = _c(ts)
    return [F.month(t).cast("int"), F.quarter(t).cast("int"),
            F.weekday(t).isin(5, 6).cast("int")]


# C11
def log1p_clipped(c) -> Column:
    x = _c(c)
    return F.when(x.isNotNull(), F.log1p(F.greatest(x.cast("double"), F.lit(0.0))))


LOG_COLUMNS = ["total_price", "total_freight", "payment_value_total", "product_weight_g_mean",
               "package_volume_cm3_mean", "approval_lag_hours", "delivery_days"]


# C12 – C17 (engineered features). The 1e-8 guard, the x100
# of the freight share, the 0.01 floor on the freight ratio, the floor 1 on
# counts and sizes.
EPS = 1e-8


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


# C12
def money_ratios() -> dict[str, Column]:
    return {
        "price_per_item": _div(F.col("total_price"), clip("item_count", lower=1)),
        "freight_pct": _div(F.col("total_freight"), F.col("total_price") + F.lit(EPS)) * 100,
        "payment_overhead": F.col("payment_value_total") - F.col("total_price") - F.col("total_freight"),
    }


# C13
def delivery_efficiency() -> dict[str, Column]:
    return {"delivery_efficiency": _div(F.col("delivery_days"), clip("freight_ratio", lower=0.01))}


# C14
def text_engagement() -> dict[str, Column]:
    return {
        "emotional_intensity": F.col("exclamation_count") + F.col("question_count"),
        "word_density": _div(F.col("text_word_count"), clip("text_char_len", lower=1)),
    }


# C15
def product_complexity() -> dict[str, Column]:
    return {
        "volume_weight_ratio": _div(F.col("package_volume_cm3_mean"), clip("product_weight_g_mean", lower=1)),
        "desc_per_photo": _div(F.col("product_description_lenght_mean"), clip("product_photos_qty_mean", lower=1)),
    }


# C16
def multi_flags() -> dict[str, Column]:
    def gt1(c):
        return F.coalesce(F.col(c) > 1, F.lit(False)).cast("int")
    return {"multi_seller": gt1("seller_count"), "multi_product": gt1("product_count"),
            "multi_payment": gt1("payment_type_nunique")}


# C17
def interactions() -> dict[str, Column]:
    return {
        "score_x_delivery": F.col("review_score") * _div(F.lit(1.0), clip("delivery_days", lower=1)),
        "text_x_score": F.col("text_present") * F.col("review_score"),
        "price_x_late": F.col("log1p_total_price") * F.col("late_delivery_flag"),
    }


ENGINEERED = ["price_per_item", "freight_pct", "payment_overhead", "delivery_efficiency",
              "emotional_intensity", "word_density", "volume_weight_ratio", "desc_per_photo",
              "multi_seller", "multi_product", "multi_payment",
              "score_x_delivery", "text_x_score", "price_x_late"]


# C18
def engineer_features(df: DataFrame) -> DataFrame:
    """The 14 engineered columns in one projection."""
    cols = {}
    for part in (money_ratios(), delivery_efficiency(), text_engagement(),
                 product_complexity(), multi_flags(), interactions()):
        cols.update(part)
    return df.withColumns(cols)


# C19
def sanitize(df: DataFrame, cols: list[str], strategy: str = "zero") -> DataFrame:
    """±inf / NaN -> NULL, then NULL -> 0 (``strategy='zero'``) or kept
    (``strategy='null'``) for a later imputer."""
    out = {}
    for c in cols:
        x = F.col(c).cast("double")
        bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
        y = F.when(bad, F.lit(None).cast("double")).otherwise(x)
        out[c] = F.coalesce(y, F.lit(0.0)) if strategy == "zero" else y
    return df.withColumns(out)
