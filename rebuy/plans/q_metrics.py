"""Registered queries: metrics on scored rows (K1–K17), metric-table
operators (Q1, Q5), priors and blends (M1, M2, M13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import aggregates as G
from ..operators import metrics as K
from ..operators import models as M
from ..operators import quality as Q
from ..sources.retail import scored_orders
from .q_split import _S, _SUM_SQL, _SUMMARY_GATE_SQL, _TO_SQL, _scratch, _splits
from .registry import build_sql, register, views

BY = ["model", "split"]
TARGET = "target_repeat_within_180d"


def _lit(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def metric_ctes(src: str = "v_scored", prefix: str = "m"):
    """Oracle CTEs for the ladder metrics of ``src`` (model, split, id, y, p)."""
    sweep = " UNION ALL ".join(f"SELECT {_lit(t)} AS t" for t in K.SWEEP)
    m = prefix
    return [
        (f"{m}_st", f"SELECT model, split, p, CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg FROM {src} GROUP BY 1, 2, 3"),
        (f"{m}_tot", f"SELECT model, split, CAST(sum(pos) AS DOUBLE) AS n_pos, CAST(sum(neg) AS DOUBLE) AS n_neg FROM {m}_st GROUP BY 1, 2"),
        (f"{m}_cu", f"""SELECT s.*, t.n_pos, t.n_neg,
  sum(pos) OVER (PARTITION BY s.model, s.split ORDER BY s.p DESC ROWS UNBOUNDED PRECEDING) AS pos_cum,
  sum(neg) OVER (PARTITION BY s.model, s.split ORDER BY s.p DESC ROWS UNBOUNDED PRECEDING) AS neg_cum
FROM {m}_st s JOIN {m}_tot t ON s.model = t.model AND s.split = t.split"""),
        (f"{m}_ap", f"""SELECT model, split, CASE WHEN min(n_pos) > 0 THEN sum(pos / n_pos * pos_cum / (pos_cum + neg_cum)) END AS pr_auc,
  CASE WHEN min(n_pos) > 0 AND min(n_neg) > 0 THEN sum(pos * (n_neg - neg_cum + 0.5 * neg)) / (min(n_pos) * min(n_neg)) END AS roc_auc
FROM {m}_cu GROUP BY 1, 2"""),
        (f"{m}_rk", f"""SELECT *, row_number() OVER (PARTITION BY model, split ORDER BY p DESC, id) AS r,
  count(*) OVER (PARTITION BY model, split) AS n, avg(y) OVER (PARTITION BY model, split) AS rate FROM {src}"""),
        (f"{m}_pk", f"""SELECT model, split, avg(y) AS precision_at_k,
  CASE WHEN min(rate) = 0 THEN 0.0 ELSE avg(y) / min(rate) END AS lift_at_k
FROM {m}_rk WHERE r <= greatest(1, floor(n * {_lit(0.1)})) GROUP BY 1, 2"""),
        (f"{m}_grid", sweep),
        (f"{m}_sw", f"""SELECT s.model, s.split, g.t AS threshold,
  CAST(sum(CASE WHEN s.p >= g.t THEN s.y ELSE 0 END) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE s.p >= g.t) - sum(CASE WHEN s.p >= g.t THEN s.y ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(s.y) - sum(CASE WHEN s.p >= g.t THEN s.y ELSE 0 END) AS BIGINT) AS fn
FROM {src} s, {m}_grid g GROUP BY 1, 2, 3"""),
        (f"{m}_f1", f"""SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
  max(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END) OVER (PARTITION BY model, split) AS best_f1
FROM {m}_sw"""),
        (f"{m}_best", f"SELECT model, split, min(threshold) FILTER (WHERE f1 = best_f1) AS threshold FROM {m}_f1 GROUP BY 1, 2"),
        (f"{m}_br", f"SELECT model, split, avg((p - y) * (p - y)) AS brier FROM {src} GROUP BY 1, 2"),
    ]


def at_threshold_sql(src: str, thr: str, prefix: str = "m"):
    """Confusion counts and F1/precision/recall of ``src`` at the thresholds
    of CTE ``thr`` (model, threshold)."""
    m = prefix
    return [
        (f"{m}_cc", f"""SELECT s.model, s.split, count(*) FILTER (WHERE y = 0 AND p < t.threshold) AS tn,
  count(*) FILTER (WHERE y = 0 AND p >= t.threshold) AS fp, count(*) FILTER (WHERE y = 1 AND p < t.threshold) AS fn,
  count(*) FILTER (WHERE y = 1 AND p >= t.threshold) AS tp, min(t.threshold) AS threshold
FROM {src} s JOIN {thr} t ON s.model = t.model GROUP BY 1, 2"""),
        (f"{m}_fpr", f"""SELECT model, split, threshold, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
  CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0.0 END AS recall FROM {m}_cc"""),
    ]


LADDER = ["pr_auc", "roc_auc", "precision_at_k", "lift_at_k", "f1", "precision", "recall", "brier", "threshold"]


def ladder_ctes(src: str = "v_scored", prefix: str = "m"):
    """compute_metrics with the threshold picked on val per model and
    applied to every split."""
    m = prefix
    return metric_ctes(src, m) + [
        (f"{m}_vthr", f"SELECT model, threshold FROM {m}_best WHERE split = 'val'"),
    ] + at_threshold_sql(src, f"{m}_vthr", m) + [
        (f"{m}_all", f"""SELECT a.model, a.split, a.pr_auc, a.roc_auc, k.precision_at_k, k.lift_at_k, f.f1, f.precision,
  f.recall, b.brier, f.threshold
FROM {m}_ap a JOIN {m}_pk k ON a.model = k.model AND a.split = k.split
JOIN {m}_fpr f ON a.model = f.model AND a.split = f.split
JOIN {m}_br b ON a.model = b.model AND a.split = b.split"""),
    ]


_V = views("scored")
_MC = _V + metric_ctes()


def _scored(spark, sf):
    return scored_orders(spark, sf)


def ladder(scored, by=BY):
    """Metric table with each model's threshold chosen on val; written once
    (a handful of rows) because the report queries read it several times."""
    from ..session import materialize
    thr = K.best_threshold(scored.filter(F.col("split") == "val"), ["model"])
    return materialize(K.compute_metrics(scored, by, threshold=thr))


@register("average_precision", build_sql(_MC, "SELECT model, split, pr_auc AS average_precision FROM m_ap",
                                         ["average_precision"]), doubles=["average_precision"])
def q_ap(spark, sf):
    return K.average_precision(_scored(spark, sf), BY)


@register("roc_auc", build_sql(_MC, "SELECT model, split, roc_auc FROM m_ap", ["roc_auc"]), doubles=["roc_auc"])
def q_auc(spark, sf):
    return K.roc_auc(_scored(spark, sf), BY)


@register("precision_at_k", build_sql(_MC, "SELECT model, split, precision_at_k FROM m_pk", ["precision_at_k"]),
          doubles=["precision_at_k"])
def q_pk(spark, sf):
    return K.precision_at_k(_scored(spark, sf), BY)


@register("lift_at_k", build_sql(_MC, "SELECT * FROM m_pk", ["precision_at_k", "lift_at_k"]),
          doubles=["precision_at_k", "lift_at_k"])
def q_lift(spark, sf):
    return K.lift_at_k(_scored(spark, sf), BY)


@register("threshold_sweep", build_sql(_MC, """SELECT model, split, threshold, tp, fp, fn, f1,
  CAST(threshold = min(threshold) FILTER (WHERE f1 = best_f1) OVER (PARTITION BY model, split) AS INTEGER) AS is_best
FROM m_f1""", ["threshold", "f1"]), doubles=["threshold", "f1"])
def q_sweep(spark, sf):
    return K.threshold_sweep(_scored(spark, sf), BY)


_HALF = _V + [("thr", "SELECT DISTINCT model, 0.5 AS threshold FROM v_scored")] + at_threshold_sql("v_scored", "thr")


@register("f1_precision_recall", build_sql(_HALF, "SELECT model, split, f1, precision, recall FROM m_fpr",
                                           ["f1", "precision", "recall"]), doubles=["f1", "precision", "recall"])
def q_f1(spark, sf):
    return K.f1_precision_recall(_scored(spark, sf), BY, 0.5)


@register("brier", build_sql(_MC, "SELECT * FROM m_br", ["brier"]), doubles=["brier"])
def q_brier(spark, sf):
    return K.brier(_scored(spark, sf), BY)


@register("weighted_log_loss", build_sql(_V + [("q", f"""SELECT model, split, CAST(y AS DOUBLE) AS y,
  least(greatest(p, {_lit(K.CLIP)}), 1 - {_lit(K.CLIP)}) AS q FROM v_scored""")], """SELECT model, split,
  avg(-(15.0 * y * ln(q) + (1 - y) * ln(1 - q))) AS weighted_bce,
  avg((0.75 * y + 0.25 * (1 - y)) * pow(1 - (q * y + (1 - q) * (1 - y)), 2) * -(y * ln(q) + (1 - y) * ln(1 - q))) AS focal_loss
FROM q GROUP BY 1, 2""", ["weighted_bce", "focal_loss"]), doubles=["weighted_bce", "focal_loss"])
def q_logloss(spark, sf):
    return K.weighted_log_loss(_scored(spark, sf), BY)


_L = _V + ladder_ctes()


@register("compute_metrics", build_sql(_L, "SELECT * FROM m_all", LADDER[:-1] + ["threshold"]),
          doubles=LADDER)
def q_compute(spark, sf):
    """The metric ladder: threshold chosen on val per model, applied to val
    and test."""
    return ladder(_scored(spark, sf))


_CR_D = ["precision", "recall", "f1_score"]


@register("confusion_report", build_sql(_HALF + [("pr", """SELECT *, CASE WHEN tn + fn > 0 THEN tn * 1.0 / (tn + fn) ELSE 0.0 END AS p0,
  CASE WHEN tn + fp > 0 THEN tn * 1.0 / (tn + fp) ELSE 0.0 END AS r0,
  CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0.0 END AS p1,
  CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0.0 END AS r1 FROM m_cc"""),
    ("pf", """SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
  CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1 FROM pr""")], """
SELECT model, split, tn, fp, fn, tp, '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, tn + fp AS support FROM pf
UNION ALL SELECT model, split, tn, fp, fn, tp, '1', p1, r1, f1, tp + fn FROM pf
UNION ALL SELECT model, split, tn, fp, fn, tp, 'accuracy', NULL, NULL, (tn + tp) * 1.0 / (tn + fp + fn + tp), tn + fp + fn + tp FROM pf
UNION ALL SELECT model, split, tn, fp, fn, tp, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tn + fp + fn + tp FROM pf
UNION ALL SELECT model, split, tn, fp, fn, tp, 'weighted avg', (p0 * (tn + fp) + p1 * (tp + fn)) / (tn + fp + fn + tp),
  (r0 * (tn + fp) + r1 * (tp + fn)) / (tn + fp + fn + tp), (f0 * (tn + fp) + f1 * (tp + fn)) / (tn + fp + fn + tp),
  tn + fp + fn + tp FROM pf""", _CR_D), doubles=_CR_D)
def q_confusion(spark, sf):
    return K.confusion_report(_scored(spark, sf), BY, 0.5)


@register("roc_curve", build_sql(_MC, """SELECT model, split, p AS threshold, neg_cum / n_neg AS fpr, pos_cum / n_pos AS tpr
FROM m_cu""", ["threshold", "fpr", "tpr"]), doubles=["threshold", "fpr", "tpr"])
def q_roc(spark, sf):
    return K.roc_curve(_scored(spark, sf), BY)


_PR_SQL = """SELECT model, split, p AS threshold, pos_cum * 1.0 / (pos_cum + neg_cum) AS precision,
  CASE WHEN n_pos > 0 THEN pos_cum / n_pos ELSE 1.0 END AS recall FROM m_cu
UNION ALL SELECT DISTINCT model, split, NULL, 1.0, 0.0 FROM m_cu"""


@register("pr_curve", build_sql(_MC, _PR_SQL, ["threshold", "precision", "recall"]),
          doubles=["threshold", "precision", "recall"])
def q_pr(spark, sf):
    return K.pr_curve(_scored(spark, sf), BY)


@register("best_f1_threshold", build_sql(_MC + [("prc", _PR_SQL), ("pf1", """SELECT *,
  2 * precision * recall / (precision + recall + 1e-9) AS f1 FROM prc WHERE threshold IS NOT NULL""")],
    """SELECT model, split, min(threshold) FILTER (WHERE f1 = mx) AS threshold, max(mx) AS f1
FROM (SELECT *, max(f1) OVER (PARTITION BY model, split) AS mx FROM pf1) GROUP BY 1, 2""", ["threshold", "f1"]),
          doubles=["threshold", "f1"])
def q_best_f1(spark, sf):
    return K.best_f1_threshold(_scored(spark, sf), BY)


_EDGES = " + ".join(f"CASE WHEN {_lit(e)} < p THEN 1 ELSE 0 END" for e in K.CALIBRATION_EDGES)


@register("calibration_curve", build_sql(_V, f"""SELECT model, split, CAST({_EDGES} AS INTEGER) AS bin,
  avg(CAST(y AS DOUBLE)) AS prob_true, avg(p) AS prob_pred, count(*) AS n FROM v_scored GROUP BY 1, 2, 3""",
                                         ["prob_true", "prob_pred"]), doubles=["prob_true", "prob_pred"])
def q_calibration(spark, sf):
    return K.calibration_curve(_scored(spark, sf), BY)


FAIL_FEATURES = ["review_score", "delivery_days", "log1p_total_price", "freight_ratio", "text_word_count",
                 "score_x_delivery"]
_FA_D = ["tp_mean", "fn_mean", "fp_mean", "tn_mean", "tp_fn_gap"]


def _fa_sql():
    from .q_profile import ENG_SQL
    parts = []
    for f in FAIL_FEATURES:
        parts.append(f"""SELECT s.model, '{f}' AS feature,
  avg(CAST({f} AS DOUBLE)) FILTER (WHERE y = 1 AND p >= 0.5) AS tp_mean, avg(CAST({f} AS DOUBLE)) FILTER (WHERE y = 1 AND p < 0.5) AS fn_mean,
  avg(CAST({f} AS DOUBLE)) FILTER (WHERE y = 0 AND p >= 0.5) AS fp_mean, avg(CAST({f} AS DOUBLE)) FILTER (WHERE y = 0 AND p < 0.5) AS tn_mean
FROM v_scored s JOIN fe ON s.id = fe.order_id GROUP BY 1""")
    return (_S + _V + [("fe", f"SELECT *, {ENG_SQL['score_x_delivery']} AS score_x_delivery FROM sp")],
            "SELECT *, tp_mean - fn_mean AS tp_fn_gap FROM (" + "\nUNION ALL ".join(parts) + ")")


@register("failure_analysis", build_sql(*_fa_sql(), _FA_D), doubles=_FA_D)
def q_failure(spark, sf):
    """Outcome groups of the scored orders that are cohort members, with
    their model-frame features."""
    feats = S.engineer_features(_splits(spark, sf)).select("order_id", *FAIL_FEATURES)
    j = _scored(spark, sf).drop("split").join(feats, F.col("id") == F.col("order_id"))
    return K.failure_analysis(j, FAIL_FEATURES, 0.5, by=["model"])


@register("model_ranking", build_sql(_L + [("lg", " UNION ALL ".join(
    f"SELECT model, split, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM m_all" for c in K.METRICS))],
    """SELECT split, metric, arg_min(model, (CASE WHEN metric = 'brier' THEN value ELSE -value END, model)) AS best_model,
  arg_min(value, (CASE WHEN metric = 'brier' THEN value ELSE -value END, model)) AS best_value
FROM lg WHERE value IS NOT NULL GROUP BY 1, 2""", ["best_value"]), doubles=["best_value"])
def q_ranking(spark, sf):
    return K.model_ranking(ladder(_scored(spark, sf)))


@register("relative_gain", build_sql(_L + [("lg", " UNION ALL ".join(
    f"SELECT model, split, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM m_all" for c in K.METRICS))],
    """SELECT l.split, l.metric, l.model, l.value, b.value AS baseline_value,
  CASE WHEN b.value <> 0 THEN (l.value - b.value) / b.value * 100 END AS gain_pct
FROM lg l JOIN lg b ON l.split = b.split AND l.metric = b.metric AND b.model = 'score_a'""",
    ["value", "baseline_value", "gain_pct"]), doubles=["value", "baseline_value", "gain_pct"])
def q_gain(spark, sf):
    return K.relative_gain(ladder(_scored(spark, sf)), "score_a")


# Q1, Q5 on metric tables ------------------------------------------------------
@register("union_metrics", build_sql(_L, "SELECT * FROM m_all", LADDER), doubles=LADDER)
def q_union(spark, sf):
    """Per-model metric tables appended into one."""
    sc = _scored(spark, sf)
    parts = [ladder(sc.filter(F.col("model") == m)) for m in ("score_a", "score_b")]
    return Q.union_metrics(*parts)


_RANGE_SQL = " UNION ALL ".join(
    [f"""SELECT '{c}_in_unit_range' AS "check", CAST(count(*) FILTER (WHERE NOT coalesce({c} BETWEEN 0 AND 1, false)) = 0 AS INTEGER) AS passed,
  CAST(count(*) FILTER (WHERE NOT coalesce({c} BETWEEN 0 AND 1, false)) AS DOUBLE) AS detail FROM m_all"""
     for c in ["pr_auc", "roc_auc", "precision_at_k", "f1", "precision", "recall", "brier"]]
    + ["""SELECT 'lift_non_negative', CAST(count(*) FILTER (WHERE NOT coalesce(lift_at_k >= 0, false)) = 0 AS INTEGER),
  CAST(count(*) FILTER (WHERE NOT coalesce(lift_at_k >= 0, false)) AS DOUBLE) FROM m_all""",
       """SELECT 'model_count', CAST(count(DISTINCT model) = 2 AS INTEGER), CAST(count(DISTINCT model) AS DOUBLE) FROM m_all"""])


@register("metric_range_gate", build_sql(_L, _RANGE_SQL))
def q_gate(spark, sf):
    return Q.metric_range_gate(ladder(_scored(spark, sf)), n_models=2)


@register("best_model_summary", build_sql(_L, """SELECT overall_validation_best_model, overall_test_best_model,
  overall_validation_best_model AS recommended_model, 'highest validation pr_auc' AS recommendation_reason,
  t.pr_auc AS test_pr_auc, t.brier AS test_brier, n_total_models_evaluated
FROM (SELECT arg_min(model, (-pr_auc, model)) FILTER (WHERE split = 'val') AS overall_validation_best_model,
    arg_min(model, (-pr_auc, model)) FILTER (WHERE split = 'test') AS overall_test_best_model,
    count(DISTINCT model) AS n_total_models_evaluated FROM m_all) b
  LEFT JOIN m_all t ON t.split = 'test' AND t.model = b.overall_validation_best_model""",
    ["test_pr_auc", "test_brier"]), doubles=["test_pr_auc", "test_brier"])
def q_best_model(spark, sf):
    best = K.best_model_summary(ladder(_scored(spark, sf)))
    return best.select(*[c for c in Q.BEST_MODEL_COLUMNS if c != "recommended_model_test_metrics"],
                       F.col("recommended_model_test_metrics.pr_auc").alias("test_pr_auc"),
                       F.col("recommended_model_test_metrics.brier").alias("test_brier"))


@register("quality_report", build_sql(_S + _L + [("sm", _SUM_SQL)], f"""SELECT 'splits_share_schema' AS "check", 1 AS passed, CAST(NULL AS DOUBLE) AS detail
UNION ALL SELECT 'splits_have_46_columns', 1, 46.0
UNION ALL {" UNION ALL ".join(f'''SELECT 'unique_order_id_{s}', CAST(count(*) = 0 AS INTEGER), CAST(count(*) AS DOUBLE)
FROM (SELECT order_id FROM sp WHERE split = '{s}' GROUP BY 1 HAVING count(*) > 1)''' for s in Q.SPLITS)}
UNION ALL SELECT 'splits_disjoint', CAST(count(*) FILTER (WHERE k > 1) = 0 AS INTEGER),
  CAST(count(*) FILTER (WHERE k > 1) AS DOUBLE) FROM (SELECT order_id, count(DISTINCT split) AS k FROM sp GROUP BY 1)
UNION ALL {_TO_SQL}
UNION ALL SELECT 'metric_columns_present', 1, 0.0
UNION ALL {_RANGE_SQL}
UNION ALL {_SUMMARY_GATE_SQL}
UNION ALL SELECT 'best_model_fields_present', 1, 0.0"""))
def q_quality_report(spark, sf):
    """Each split is stored on its own and read back for the schema gate; the
    metric gates judge the ladder of the two scorers."""
    sp = _splits(spark, sf)
    stored = {}
    for s in Q.SPLITS:
        path = _scratch(spark, f"split-{s}")
        sp.where(F.col("split") == s).drop("split").write.parquet(path)
        stored[s] = spark.read.parquet(path)
    metrics = ladder(_scored(spark, sf))
    return Q.quality_report(sp, written=stored, metrics=metrics, n_models=2, summary=G.dataset_summary(sp),
                            best_model=K.best_model_summary(metrics))


# M1, M2, M13 ------------------------------------------------------------------
@register("dummy_prior", build_sql(_S + [("dp", f"""SELECT 'dummy_prior' AS model, split, order_id AS id, {TARGET} AS y,
  (SELECT avg(CAST({TARGET} AS DOUBLE)) FROM sp WHERE split = 'train') AS p FROM sp WHERE split <> 'train'""")]
    + ladder_ctes("dp"), "SELECT * FROM m_all", LADDER), doubles=LADDER)
def q_dummy(spark, sf):
    """Constant train rate as the score; ladder metrics on val and test."""
    sp = _splits(spark, sf)
    train = sp.filter(F.col("split") == "train")
    scored = M.dummy_prior(train, sp.filter(F.col("split") != "train"), TARGET, "p")
    scored = scored.select(F.lit("dummy_prior").alias("model"), "split", F.col("order_id").alias("id"),
                           F.col(TARGET).alias("y"), "p")
    return ladder(scored)


@register("class_weights", build_sql(_S, f"""SELECT {TARGET}, count(*) AS n_c,
  (SELECT count(*) FROM sp WHERE split = 'train') / (2.0 * count(*)) AS balanced_weight,
  (SELECT CAST(count(*) FILTER (WHERE {TARGET} = 0) AS DOUBLE) / nullif(count(*) FILTER (WHERE {TARGET} = 1), 0)
   FROM sp WHERE split = 'train') AS pos_weight
FROM sp WHERE split = 'train' GROUP BY 1""", ["balanced_weight", "pos_weight"]),
          doubles=["balanced_weight", "pos_weight"])
def q_weights(spark, sf):
    return M.class_weights(_splits(spark, sf).filter(F.col("split") == "train"))


@register("blend_average", build_sql(_V, """SELECT a.split, a.id, (a.p + b.p) / 2 AS p
FROM v_scored a JOIN v_scored b ON a.id = b.id AND a.split = b.split AND a.model = 'score_a' AND b.model = 'score_b'""",
                                     ["p"]), doubles=["p"])
def q_blend(spark, sf):
    sc = _scored(spark, sf)
    return M.blend_average(sc.filter(F.col("model") == "score_a"), sc.filter(F.col("model") == "score_b"),
                           ["split", "id"])
