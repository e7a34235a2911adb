"""Registered queries: train-fitted encoders."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import encoders as E
from .q_split import _S, _splits
from .registry import build_sql, register

TARGET = "target_repeat_within_180d"
NUM = E.BASELINE_NUMERIC
CAT = E.BASELINE_CATEGORICAL


def _parts(spark, sf):
    sp = _splits(spark, sf)
    return sp, sp.filter(F.col("split") == "train")


_MED = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in NUM)
_IMP_CTE = [("med", f"SELECT {_MED} FROM sp WHERE split = 'train'"),
            ("imp", "SELECT order_id, split, " + ", ".join(
                f"coalesce(CAST(sp.{c} AS DOUBLE), med.{c}) AS {c}" for c in NUM) + " FROM sp, med")]


@register("impute_median", build_sql(_S + _IMP_CTE, "SELECT * FROM imp", NUM), doubles=NUM)
def q_impute_median(spark, sf):
    sp, train = _parts(spark, sf)
    return E.impute_median(sp, E.fit_median(train, NUM)).select("order_id", "split", *NUM)


def _mode_sql(c):
    return f"""(SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM sp
  WHERE split = 'train' AND {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1)"""


@register("impute_mode", build_sql(_S, "SELECT order_id, split, " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), {_mode_sql(c)}) AS {c}" for c in CAT) + " FROM sp"))
def q_impute_mode(spark, sf):
    sp, train = _parts(spark, sf)
    return E.impute_mode(sp, E.fit_mode(train, CAT)).select("order_id", "split", *CAT)


_SC_CTE = [("sc", ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS s_{c}" for c in NUM)
    .join(["SELECT ", " FROM imp WHERE split = 'train'"]))]


@register("standard_scale", build_sql(_S + _IMP_CTE + _SC_CTE,
    "SELECT order_id, split, " + ", ".join(f"(imp.{c} - sc.m_{c}) / sc.s_{c} AS {c}" for c in NUM) + " FROM imp, sc",
    NUM), doubles=NUM)
def q_scale(spark, sf):
    sp, train = _parts(spark, sf)
    med = E.fit_median(train, NUM)
    imp = E.impute_median(sp, med)
    params = E.fit_scaler(imp.filter(F.col("split") == "train"), NUM)
    return E.standard_scale(imp, params).select("order_id", "split", *NUM)


@register("one_hot", build_sql(_S + [("cats", """SELECT DISTINCT CAST(payment_type_mode AS VARCHAR) AS category FROM sp
WHERE split = 'train' AND payment_type_mode IS NOT NULL""")], """SELECT sp.order_id, c.category,
  CAST(coalesce(CAST(sp.payment_type_mode AS VARCHAR) = c.category, false) AS INTEGER) AS indicator
FROM sp, cats c"""))
def q_one_hot(spark, sf):
    """Indicators per train category (long form: one row per order and
    category; unseen values are all zeros)."""
    sp, train = _parts(spark, sf)
    cats = E.fit_category_table(train, ["payment_type_mode"])
    oh = E.one_hot(sp, "payment_type_mode", cats, cats.count(), "oh").select("order_id", "oh")
    places = E.with_vectors(oh, ["oh"]).select("order_id", F.posexplode(vector_to_array("oh")).alias("position", "on"))
    return places.join(cats.select("position", F.col("value").alias("category")), "position").select(
        "order_id", "category", F.col("on").cast("int").alias("indicator"))


_CODES = [("codes", """SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code FROM (
  SELECT DISTINCT CAST(product_category_main AS VARCHAR) AS value FROM sp WHERE split = 'train' AND product_category_main IS NOT NULL)""")]


@register("ordinal_encode", build_sql(_S + _CODES, """SELECT sp.order_id, sp.split, sp.product_category_main,
  CAST(coalesce(codes.code, -1) AS INTEGER) AS product_category_main_code
FROM sp LEFT JOIN codes ON CAST(sp.product_category_main AS VARCHAR) = codes.value"""))
def q_ordinal(spark, sf):
    sp, train = _parts(spark, sf)
    codes = E.fit_ordinal(train, "product_category_main")
    return E.ordinal_encode(sp, "product_category_main", codes).select(
        "order_id", "split", "product_category_main", "product_category_main_code")


_CODES_M = [("codes", f"""SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code FROM (
  SELECT DISTINCT coalesce(CAST(product_category_main AS VARCHAR), '{E.MISSING}') AS value FROM sp WHERE split = 'train')""")]


@register("ordinal_encode_missing", build_sql(_S + _CODES_M, f"""SELECT sp.order_id, sp.split, sp.product_category_main,
  CAST(coalesce(codes.code, 0) AS INTEGER) AS product_category_main_code
FROM sp LEFT JOIN codes ON coalesce(CAST(sp.product_category_main AS VARCHAR), '{E.MISSING}') = codes.value"""))
def q_ordinal_missing(spark, sf):
    """The form that embeddings take: NULL is a category, unseen values are 0."""
    sp, train = _parts(spark, sf)
    codes = E.fit_ordinal(train, "product_category_main", E.MISSING)
    return E.ordinal_encode(sp, "product_category_main", codes, unknown=0, missing=E.MISSING).select(
        "order_id", "split", "product_category_main", "product_category_main_code")


def _te_sql(m):
    return [("gm", f"SELECT avg(CAST({TARGET} AS DOUBLE)) AS mu FROM sp WHERE split = 'train'"),
            ("te", f"""SELECT CAST(customer_state AS VARCHAR) AS value,
  (sum(CAST({TARGET} AS DOUBLE)) + {float(m)} * min(gm.mu)) / (count(*) + {float(m)}) AS enc
FROM sp, gm WHERE split = 'train' AND customer_state IS NOT NULL GROUP BY 1""")]


_TE_BODY = """SELECT sp.order_id, sp.split, coalesce(te.enc, gm.mu) AS customer_state_target_enc
FROM sp CROSS JOIN gm LEFT JOIN te ON CAST(sp.customer_state AS VARCHAR) = te.value"""


@register("target_encode", build_sql(_S + _te_sql(0), _TE_BODY, ["customer_state_target_enc"]),
          doubles=["customer_state_target_enc"])
def q_target_encode(spark, sf):
    sp, train = _parts(spark, sf)
    enc = E.fit_target_encoding(train, "customer_state", TARGET, 0.0)
    return E.target_encode(sp, "customer_state", enc).select("order_id", "split", "customer_state_target_enc")


@register("target_encode_smoothed", build_sql(_S + _te_sql(10), _TE_BODY, ["customer_state_target_enc"]),
          doubles=["customer_state_target_enc"])
def q_target_encode_smoothed(spark, sf):
    """Smoothed variant: (sum y + 10 * mean) / (n + 10)."""
    sp, train = _parts(spark, sf)
    enc = E.fit_target_encoding(train, "customer_state", TARGET, 10.0)
    return E.target_encode(sp, "customer_state", enc).select("order_id", "split", "customer_state_target_enc")


_TERMS_SQL = """SELECT order_id, split, unnest(list_concat(t, CASE WHEN len(t) > 1 THEN
  list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE [] END)) AS term
FROM (SELECT order_id, split, regexp_extract_all(lower(review_text), '[\\p{L}\\p{N}_]{2,}') AS t FROM sp)"""
_VOCAB = [
    ("trm", _TERMS_SQL),
    ("tf", "SELECT order_id, split, term, count(*) AS tf FROM trm GROUP BY 1, 2, 3"),
    ("st", """SELECT term, count(*) AS df, sum(tf) AS cf FROM tf WHERE split = 'train' GROUP BY 1 HAVING count(*) >= 5"""),
    ("top", "SELECT * FROM st ORDER BY cf DESC, term LIMIT 30000"),
    ("vocab", """SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS index, df, CAST(cf AS BIGINT) AS cf,
  ln((1 + (SELECT count(*) FROM sp WHERE split = 'train')) / (1.0 + df)) + 1 AS idf FROM top"""),
]


@register("tfidf_vocabulary", build_sql(_S + _VOCAB, "SELECT * FROM vocab", ["idf"]), doubles=["idf"])
def q_vocab(spark, sf):
    _, train = _parts(spark, sf)
    return E.fit_tfidf(train, "review_text", "order_id")


@register("tfidf", build_sql(_S + _VOCAB + [("w", """SELECT tf.order_id, tf.term, v.index,
  (1 + ln(tf.tf)) * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term""")], """SELECT order_id, term, index,
  w / sqrt(sum(w * w) OVER (PARTITION BY order_id)) AS weight FROM w""", ["weight"]), doubles=["weight"])
def q_tfidf(spark, sf):
    """Sublinear, L2-normalised TF-IDF weights of every split's review text
    with the train vocabulary."""
    sp, train = _parts(spark, sf)
    vocab = E.fit_tfidf(train, "review_text", "order_id")
    return E.tfidf_weights(sp, vocab, "review_text", "order_id")


@register("baseline_columns", build_sql(_S, f"SELECT {', '.join(NUM + CAT)} FROM sp", ["freight_ratio",
          "log1p_total_price", "log1p_total_freight", "log1p_payment_value_total", "log1p_approval_lag_hours",
          "log1p_delivery_days", "delivery_delay_days_clipped"]),
          doubles=["freight_ratio", "log1p_total_price", "log1p_total_freight", "log1p_payment_value_total",
                   "log1p_approval_lag_hours", "log1p_delivery_days", "delivery_delay_days_clipped"])
def q_baseline_cols(spark, sf):
    return E.baseline_columns(_splits(spark, sf))


_CT_CTE = _IMP_CTE + _SC_CTE + [
    ("ci", "SELECT order_id, split, " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), {_mode_sql(c)}) AS {c}" for c in CAT) + " FROM sp"),
    ("cats", " UNION ALL ".join(f"SELECT DISTINCT {i} AS block, {c} AS value FROM ci WHERE split = 'train'" for i, c in enumerate(CAT))),
    ("pos", f"SELECT block, value, {len(NUM)} - 1 + row_number() OVER (ORDER BY block, value) AS position FROM cats"),
]


@register("column_transform", build_sql(_S + _CT_CTE, " UNION ALL ".join(
    [f"SELECT order_id, split, CAST({i} AS INTEGER) AS position, (imp.{c} - sc.m_{c}) / sc.s_{c} AS value FROM imp, sc" for i, c in enumerate(NUM)]
    + [f"""SELECT order_id, split, CAST(pos.position AS INTEGER), CAST(coalesce(ci.{c} = pos.value, false) AS DOUBLE)
FROM ci, pos WHERE pos.block = {i}""" for i, c in enumerate(CAT)]), ["value"]), doubles=["value"])
def q_column_transform(spark, sf):
    """Median-impute + scale numerics, mode-impute + one-hot categoricals,
    assembled into one vector (fit on train, applied to every split); a row
    for each place of each order's vector."""
    sp, train = _parts(spark, sf)
    pre = E.TabularPreprocessor(NUM, CAT).fit(train)
    return pre.transform(sp).select(
        "order_id", "split", F.posexplode(vector_to_array("features")).alias("position", "value"))
