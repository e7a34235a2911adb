"""Registered queries: engineered features (C12–C19) and profiling
(P1–P11) over the train split of the model frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import assemble as A
from ..operators import profile as P
from .q_split import _splits, split_ctes
from .registry import build_sql, register

TARGET = "target_repeat_within_180d"


def _train(spark, sf):
    return _splits(spark, sf).filter(F.col("split") == "train").drop("split")


def _eng(spark, sf):
    return S.engineer_features(_train(spark, sf))


def _g1(c):
    return f"CASE WHEN {c} IS NOT NULL THEN greatest({c}, 1) END"


ENG_SQL = {
    "price_per_item": f"total_price / {_g1('item_count')}",
    "freight_pct": "total_freight / (total_price + 1e-8) * 100",
    "payment_overhead": "payment_value_total - total_price - total_freight",
    "delivery_efficiency": "delivery_days / CASE WHEN freight_ratio IS NOT NULL THEN greatest(freight_ratio, 0.01) END",
    "emotional_intensity": "exclamation_count + question_count",
    "word_density": f"CAST(text_word_count AS DOUBLE) / {_g1('text_char_len')}",
    "volume_weight_ratio": f"package_volume_cm3_mean / {_g1('product_weight_g_mean')}",
    "desc_per_photo": f"product_description_lenght_mean / {_g1('product_photos_qty_mean')}",
    "multi_seller": "CAST(coalesce(seller_count > 1, false) AS INTEGER)",
    "multi_product": "CAST(coalesce(product_count > 1, false) AS INTEGER)",
    "multi_payment": "CAST(coalesce(payment_type_nunique > 1, false) AS INTEGER)",
    "score_x_delivery": f"review_score * (1.0 / {_g1('delivery_days')})",
    "text_x_score": "text_present * review_score",
    "price_x_late": "log1p_total_price * late_delivery_flag",
}
ENG_DOUBLES = ["price_per_item", "freight_pct", "payment_overhead", "delivery_efficiency", "word_density",
               "volume_weight_ratio", "desc_per_photo", "score_x_delivery", "price_x_late"]


def profile_ctes():
    eng = ",\n  ".join(f"{v} AS {k}" for k, v in ENG_SQL.items())
    return split_ctes() + [
        ("tr", "SELECT * EXCLUDE (split) FROM sp WHERE split = 'train'"),
        ("eng", f"SELECT *,\n  {eng}\nFROM tr"),
    ]


_P = profile_ctes()


# C12–C18 --------------------------------------------------------------------
def _eng_query(name, cols):
    d = [c for c in cols if c in ENG_DOUBLES]

    @register(name, build_sql(_P, f"SELECT order_id, {', '.join(cols)} FROM eng", d), doubles=d)
    def q(spark, sf):
        return _eng(spark, sf).select("order_id", *cols)
    return q


_eng_query("money_ratios", ["price_per_item", "freight_pct", "payment_overhead"])
_eng_query("delivery_efficiency", ["delivery_efficiency"])
_eng_query("text_engagement", ["emotional_intensity", "word_density"])
_eng_query("product_complexity", ["volume_weight_ratio", "desc_per_photo"])
_eng_query("multi_flags", ["multi_seller", "multi_product", "multi_payment"])
_eng_query("interactions", ["score_x_delivery", "text_x_score", "price_x_late"])
_eng_query("engineer_features", S.ENGINEERED)

# 43 numeric model inputs, ±inf/NaN/NULL -> 0
DL_NUMERIC = A.DL_NUMERIC


@register("sanitize", build_sql(_P, "SELECT order_id, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in DL_NUMERIC) + " FROM eng", DL_NUMERIC), doubles=DL_NUMERIC)
def q_sanitize(spark, sf):
    return S.sanitize(_eng(spark, sf), DL_NUMERIC, "zero").select("order_id", *DL_NUMERIC)


# P1–P11 ---------------------------------------------------------------------
NUM = A.NUMERIC_COLUMNS
_D1 = ["mean", "std", "skewness", "kurtosis", "min", "max"]


@register("describe_numeric", build_sql(_P, "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std,
  CASE WHEN count({c}) < 3 THEN NULL WHEN var_pop({c}) = 0 THEN 0 ELSE skewness({c}) END AS skewness,
  CASE WHEN count({c}) < 4 THEN NULL WHEN var_pop({c}) = 0 THEN 0 ELSE kurtosis({c}) END AS kurtosis,
  CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, count(*) - count({c}) AS nulls FROM tr"""
    for c in NUM), _D1), doubles=_D1)
def q_describe(spark, sf):
    return P.describe_numeric(_train(spark, sf), NUM)


@register("missing_report", build_sql(_P, "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
    f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS missing_pct FROM tr"
    for c in A.MODEL_FRAME_COLUMNS) + ") WHERE missing_count > 0", ["missing_pct"]), doubles=["missing_pct"])
def q_missing(spark, sf):
    return P.missing_report(_train(spark, sf), A.MODEL_FRAME_COLUMNS)


def _fence_sql(c):
    return f"""SELECT '{c}' AS feature, q1, med, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence,
  q3 + 1.5 * (q3 - q1) AS upper_fence,
  (SELECT count(*) FROM tr WHERE {c} IS NOT NULL AND ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))) AS n_outliers,
  (SELECT count({c}) FROM tr) AS n,
  (SELECT min({c}) FROM tr WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
  (SELECT max({c}) FROM tr WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_high
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 FROM tr)"""


_FENCES = "\nUNION ALL ".join(_fence_sql(c) for c in A.OUTLIER_COLUMNS)
_IQR_D = ["q1", "q3", "iqr", "lower_fence", "upper_fence", "outlier_pct"]
_BOX_D = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@register("iqr_outliers", build_sql(_P + [("fz", _FENCES)], """SELECT feature, q1, q3, iqr, lower_fence, upper_fence,
  n_outliers, n_outliers * 100.0 / n AS outlier_pct FROM fz""", _IQR_D), doubles=_IQR_D)
def q_iqr(spark, sf):
    return P.iqr_outliers(_train(spark, sf), A.OUTLIER_COLUMNS)


@register("box_stats", build_sql(_P + [("fz", _FENCES)], """SELECT feature, q1, med AS median, q3,
  CAST(whisker_low AS DOUBLE) AS whisker_low, CAST(whisker_high AS DOUBLE) AS whisker_high, n_outliers FROM fz""",
                                 _BOX_D), doubles=_BOX_D)
def q_box(spark, sf):
    return P.box_stats(_train(spark, sf), A.OUTLIER_COLUMNS)


_H_D = ["bin_left", "bin_right", "density"]


@register("histogram", build_sql(_P + [
    ("hd", f"SELECT {TARGET} AS g, CAST(delivery_days AS DOUBLE) AS x FROM tr WHERE delivery_days IS NOT NULL AND {TARGET} IS NOT NULL"),
    ("hr", """SELECT g, count(*) AS n, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
  CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM hd GROUP BY g"""),
    ("hc", """SELECT hd.g, CAST(least(floor((x - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin, count(*) AS cnt
FROM hd JOIN hr ON hd.g = hr.g GROUP BY 1, 2""")],
    f"""SELECT hr.g AS {TARGET}, CAST(b.bin AS INTEGER) AS bin, lo + b.bin * (hi - lo) / 30 AS bin_left,
  lo + (b.bin + 1) * (hi - lo) / 30 AS bin_right, coalesce(hc.cnt, 0) AS count,
  coalesce(hc.cnt, 0) / (n * (hi - lo) / 30) AS density
FROM hr CROSS JOIN range(30) b(bin) LEFT JOIN hc ON hc.g = hr.g AND hc.bin = b.bin""", _H_D), doubles=_H_D)
def q_histogram(spark, sf):
    return P.histogram(_train(spark, sf), "delivery_days", 30, by=TARGET, density=True)


@register("class_kde", build_sql(_P + [
    ("kd", f"SELECT {TARGET} AS g, CAST(delivery_days AS DOUBLE) AS x FROM tr WHERE delivery_days IS NOT NULL AND {TARGET} IS NOT NULL"),
    ("ks", "SELECT g, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h, min(x) AS mn, max(x) AS mx FROM kd GROUP BY g"),
    ("kg", "SELECT g, n, h, p.point, mn + p.point * (mx - mn) / 99 AS grid_x FROM ks CROSS JOIN range(100) p(point)")],
    f"""SELECT kg.g AS {TARGET}, CAST(kg.point AS INTEGER) AS point, kg.grid_x,
  sum(exp(-0.5 * ((kg.grid_x - kd.x) / kg.h) * ((kg.grid_x - kd.x) / kg.h)) / (kg.h * sqrt(2 * pi()))) / min(kg.n) AS density
FROM kg JOIN kd ON kg.g = kd.g GROUP BY 1, 2, 3""", ["grid_x", "density"]), doubles=["grid_x", "density"])
def q_kde(spark, sf):
    return P.class_kde(_train(spark, sf), "delivery_days", TARGET, 100).withColumn("point", F.col("point").cast("int"))


CLASS_COLS = ["review_score", "delivery_days", "log1p_total_price", "freight_ratio", "text_char_len"]


@register("class_stats", build_sql(_P, "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, {TARGET}, avg({c}) AS mean, count({c}) AS n, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median
FROM tr WHERE {c} IS NOT NULL AND {TARGET} IS NOT NULL GROUP BY {TARGET}""" for c in CLASS_COLS), ["mean", "median"]),
          doubles=["mean", "median"])
def q_class_stats(spark, sf):
    return P.class_stats(_train(spark, sf), CLASS_COLS, TARGET)


def _corr_sql():
    cols = A.CORR_COLUMNS
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            r = f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {r} AS r FROM tr")
            parts.append(f"SELECT '{b}', '{a}', {r} FROM tr")
        parts.append(f"SELECT '{a}', '{a}', CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END FROM tr")
    return "\nUNION ALL ".join(parts)


@register("corr_matrix", build_sql(_P, _corr_sql(), ["r"]), doubles=["r"])
def q_corr(spark, sf):
    return P.corr_matrix(_train(spark, sf), A.CORR_COLUMNS)


_TC_NUM = [c for c in NUM if c != TARGET]


@register("target_corr", build_sql(_P + [("tc", "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, CASE WHEN isnan(abs(corr(CAST({c} AS DOUBLE), CAST({TARGET} AS DOUBLE)))) THEN NULL "
    f"ELSE abs(corr(CAST({c} AS DOUBLE), CAST({TARGET} AS DOUBLE))) END AS abs_corr FROM tr" for c in _TC_NUM))],
    """SELECT feature, abs_corr, row_number() OVER (ORDER BY abs_corr DESC NULLS LAST, feature) AS rank,
  CAST(coalesce(abs_corr > 0.5, false) AS INTEGER) AS leakage_alarm FROM tc""", ["abs_corr"]), doubles=["abs_corr"])
def q_target_corr(spark, sf):
    return P.target_corr(_train(spark, sf), _TC_NUM, TARGET)


@register("categorical_profile", build_sql(_P + [("cc", "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM tr WHERE {c} IS NOT NULL GROUP BY 2"
    for c in A.STRING_COLUMNS))], """SELECT * FROM (
  SELECT feature, value, count, row_number() OVER (PARTITION BY feature ORDER BY count DESC, value) AS rank,
    count(*) OVER (PARTITION BY feature) AS n_unique FROM cc) WHERE rank <= 3"""))
def q_cat_profile(spark, sf):
    return P.categorical_profile(_train(spark, sf), A.STRING_COLUMNS)


_W_D = ["corr", "mean_0", "mean_1", "t_stat", "dof"]


def _welch_sql():
    parts = []
    for c in S.ENGINEERED:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS feature, corr({x}, CAST({TARGET} AS DOUBLE)) AS corr,
  avg({x}) FILTER (WHERE {TARGET} = 0) AS mean_0, avg({x}) FILTER (WHERE {TARGET} = 1) AS mean_1,
  var_samp({x}) FILTER (WHERE {TARGET} = 0) / count({x}) FILTER (WHERE {TARGET} = 0) AS se0,
  var_samp({x}) FILTER (WHERE {TARGET} = 1) / count({x}) FILTER (WHERE {TARGET} = 1) AS se1,
  count({x}) FILTER (WHERE {TARGET} = 0) AS n0, count({x}) FILTER (WHERE {TARGET} = 1) AS n1
FROM eng WHERE {c} IS NOT NULL""")
    return "\nUNION ALL ".join(parts)


@register("welch_ttest", build_sql(_P + [("wt", _welch_sql())], """SELECT feature, corr, mean_0, mean_1,
  CASE WHEN se0 + se1 > 0 THEN (mean_0 - mean_1) / sqrt(se0 + se1) END AS t_stat,
  CASE WHEN se0 * se0 / (n0 - 1) + se1 * se1 / (n1 - 1) > 0
       THEN (se0 + se1) * (se0 + se1) / (se0 * se0 / (n0 - 1) + se1 * se1 / (n1 - 1)) END AS dof FROM wt""", _W_D),
          doubles=_W_D)
def q_welch(spark, sf):
    return P.welch_ttest(_eng(spark, sf), S.ENGINEERED, TARGET, with_p=False)


@register("welch_pvalue")
def q_welch_p(spark, sf):
    """Welch t-test with two-sided p-values (Student-t tail per feature row;
    checked against known values in the tests)."""
    return P.welch_ttest(_eng(spark, sf), S.ENGINEERED, TARGET, with_p=True)
