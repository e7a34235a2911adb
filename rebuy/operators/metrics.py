"""Metrics on scored rows ``(by..., id, y, p)``.

Ranking metrics (average precision, ROC AUC, curves) are computed from one
table with a row per distinct score per group and running totals over it
(distributed prefix sums, no single-partition window). Everything is
grouped by ``by`` (e.g. model, split) so a whole ladder is one job.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import group_rank, prefix_sums

# The threshold grid of the F1 sweep (19 points from 0.05 to
# 0.95) and the inner edges of ten uniform calibration bins.
SWEEP = np.linspace(0.05, 0.95, 19).tolist()
CALIBRATION_EDGES = np.linspace(0.0, 1.0, 11)[1:-1].tolist()
EPS_F1 = 1e-9
CLIP = 1e-15


def _by(by) -> list[str]:
    return list(by or [])


def _with_group(df: DataFrame, by: list[str]) -> tuple[DataFrame, list[str]]:
    if by:
        return df, by
    return df.withColumn("_g", F.lit(1)), ["_g"]


def totals(scored: DataFrame, by=None, y: str = "y") -> DataFrame:
    """Per group: n, positives P, negatives N."""
    df, keys = _with_group(scored, _by(by))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("n_pos")).withColumn(
        "n_neg", F.col("n") - F.col("n_pos"))


def score_curve(scored: DataFrame, by=None, y: str = "y", p: str = "p") -> DataFrame:
    """One row per (group, distinct score), scores descending, with
    pos/neg at the score and running totals pos_cum/neg_cum (>= score),
    plus the group's positives n_pos and negatives n_neg."""
    df, keys = _with_group(scored, _by(by))
    st = df.groupBy(*keys, p).agg(F.sum(F.col(y).cast("long")).alias("pos"),
                                  (F.count(F.lit(1)) - F.sum(F.col(y).cast("long"))).alias("neg"))
    cum = prefix_sums(st, [*keys, (p, False)], ["pos", "neg"])
    base = cum.groupBy(*keys).agg(F.min(F.col("pos_cum") - F.col("pos")).alias("_bp"),
                                  F.min(F.col("neg_cum") - F.col("neg")).alias("_bn"),
                                  F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    # one row per group (a model, a split) on the right-hand side: by a shuffle,
    # a group would be a task
    out = (cum.join(F.broadcast(base), keys)
              .withColumn("pos_cum", F.col("pos_cum") - F.col("_bp"))
              .withColumn("neg_cum", F.col("neg_cum") - F.col("_bn"))
              .drop("_bp", "_bn"))
    return out


def _drop_g(df: DataFrame, by=None) -> DataFrame:
    """Drop the helper group column unless the caller grouped by it."""
    return df.drop("_g") if "_g" in df.columns and "_g" not in _by(by) else df


# K1
def average_precision(scored: DataFrame, by=None, y: str = "y", p: str = "p") -> DataFrame:
    """Step-wise AP: sum over distinct thresholds of (R_i - R_{i-1}) * P_i."""
    keys = _by(by) or ["_g"]
    out = score_curve(scored, by, y, p).groupBy(*keys).agg(_ap().alias("average_precision"))
    return _drop_g(out, by)


def _ap() -> Column:
    term = F.col("pos") / F.col("n_pos") * F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))
    return F.when(F.first("n_pos") > 0, F.sum(term))


def _auc() -> Column:
    term = F.col("pos") * (F.col("n_neg") - F.col("neg_cum") + 0.5 * F.col("neg"))
    return F.when((F.first("n_pos") > 0) & (F.first("n_neg") > 0),
                  F.sum(term) / (F.first("n_pos").cast("double") * F.first("n_neg")))


# K2
def roc_auc(scored: DataFrame, by=None, y: str = "y", p: str = "p") -> DataFrame:
    """ROC AUC with ties counted half; NULL when a class is absent."""
    keys = _by(by) or ["_g"]
    out = score_curve(scored, by, y, p).groupBy(*keys).agg(_auc().alias("roc_auc"))
    return _drop_g(out, by)


# K3
def precision_at_k(scored: DataFrame, by=None, frac: float = 0.10, y: str = "y", p: str = "p",
                   id_col: str = "id") -> DataFrame:
    """Mean label among the top max(1, floor(n*frac)) scores (ties by id)."""
    df, keys = _with_group(scored, _by(by))
    return _drop_g(_top_share(score_curve(df, keys, y, p), df, keys, frac, y, p, id_col)
                   .select(*keys, "precision_at_k"), by)


def _top_share(curve: DataFrame, df: DataFrame, keys: list[str], frac: float, y: str, p: str,
               id_col: str) -> DataFrame:
    """(keys..., precision_at_k, _rate) from the score curve: the scores above
    the one that holds position k count whole, and only the rows tied at that
    score are ranked by id."""
    n = F.col("n_pos") + F.col("n_neg")
    k = F.greatest(F.lit(1), F.floor(n * F.lit(float(frac))))
    above = F.col("pos_cum") + F.col("neg_cum") - F.col("pos") - F.col("neg")
    edge = curve.filter((above < k) & (F.col("pos_cum") + F.col("neg_cum") >= k)).select(
        *keys, F.col(p).alias("_edge"), k.alias("_k"), (k - above).alias("_left"),
        (F.col("pos_cum") - F.col("pos")).alias("_above"), (F.col("n_pos") / n).alias("_rate"))
    tied = (df.join(F.broadcast(edge.select(*keys, "_edge", "_left")), keys).filter(F.col(p).eqNullSafe(F.col("_edge")))
              .select(*keys, id_col, F.col(y).cast("long").alias("_y"), "_left"))
    taken = (group_rank(tied, keys, [id_col], name="_rk", few=True).filter(F.col("_rk") <= F.col("_left"))
             .groupBy(*keys).agg(F.sum("_y").alias("_taken")))
    return edge.join(taken, keys).select(
        *keys, ((F.col("_above") + F.col("_taken")) / F.col("_k")).alias("precision_at_k"), "_rate")


def _lift(precision: Column, rate: Column) -> Column:
    return F.when(rate == 0, F.lit(0.0)).otherwise(precision / rate)


# K4
def lift_at_k(scored: DataFrame, by=None, frac: float = 0.10, y: str = "y", p: str = "p",
              id_col: str = "id") -> DataFrame:
    """precision@k / base rate; 0 when the base rate is 0."""
    keys = _by(by) or ["_g"]
    df, _ = _with_group(scored, _by(by))
    top = _top_share(score_curve(df, keys, y, p), df, keys, frac, y, p, id_col)
    out = top.select(*keys, "precision_at_k", _lift(F.col("precision_at_k"), F.col("_rate")).alias("lift_at_k"))
    return _drop_g(out, by)


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    d = 2 * tp + fp + fn
    return F.when(d > 0, 2 * tp / d.cast("double")).otherwise(F.lit(0.0))


# K5
def threshold_sweep(scored: DataFrame, by=None, y: str = "y", p: str = "p", grid=SWEEP) -> DataFrame:
    """F1 at each grid threshold (prediction = p >= t) in one pass; the
    first (lowest) threshold with the highest F1 is flagged ``is_best``."""
    df, keys = _with_group(scored, _by(by))
    yv, pv = F.col(y).cast("long"), F.col(p)
    aggs = [F.sum(yv).alias("_npos")]
    for i, t in enumerate(grid):
        aggs += [F.sum(F.when(pv >= F.lit(t), yv).otherwise(0)).alias(f"_tp{i}"),
                 F.count(F.when(pv >= F.lit(t), 1)).alias(f"_pp{i}")]
    wide = df.groupBy(*keys).agg(*aggs)
    rows = wide.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_tp{i}").alias("tp"),
                 (F.col(f"_pp{i}") - F.col(f"_tp{i}")).alias("fp"), (F.col("_npos") - F.col(f"_tp{i}")).alias("fn"))
        for i, t in enumerate(grid)])))
    rows = rows.withColumn("f1", _f1(F.col("tp"), F.col("fp"), F.col("fn")))
    best = rows.groupBy(*keys).agg(F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("_best"))
    out = rows.join(best, keys).withColumn("is_best", (F.col("threshold") == F.col("_best")).cast("int")).drop("_best")
    return _drop_g(out, by)


def best_threshold(scored: DataFrame, by=None, y: str = "y", p: str = "p") -> DataFrame:
    df, keys = _with_group(scored, _by(by))
    sw = threshold_sweep(df, keys, y, p)
    return _drop_g(sw.filter(F.col("is_best") == 1).select(*keys, "threshold"), by)


def _threshold_col(df: DataFrame, keys: list[str], threshold) -> tuple[DataFrame, Column]:
    if isinstance(threshold, DataFrame):
        tk = [k for k in keys if k in threshold.columns]
        t = threshold.select(*tk, F.col("threshold").alias("_thr"))
        return (df.join(F.broadcast(t), tk) if tk else df.withColumn("_thr", t.agg(F.first("_thr")).scalar())), F.col("_thr")
    return df, F.lit(float(threshold))


def confusion_counts(scored: DataFrame, by=None, threshold=0.5, y: str = "y", p: str = "p") -> DataFrame:
    df, keys = _with_group(scored, _by(by))
    df, thr = _threshold_col(df, keys, threshold)
    pred = F.col(p) >= thr
    yv = F.col(y) == 1
    out = df.groupBy(*keys).agg(
        F.count(F.when(~yv & ~pred, 1)).alias("tn"), F.count(F.when(~yv & pred, 1)).alias("fp"),
        F.count(F.when(yv & ~pred, 1)).alias("fn"), F.count(F.when(yv & pred, 1)).alias("tp"))
    return _drop_g(out, by)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b.cast("double")).otherwise(F.lit(0.0))


# K6
def f1_precision_recall(scored: DataFrame, by=None, threshold=0.5, y: str = "y", p: str = "p") -> DataFrame:
    keys = _by(by)
    c = confusion_counts(scored, keys, threshold, y, p)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(*keys, _f1(tp, fp, fn).alias("f1"), _ratio(tp, tp + fp).alias("precision"),
                    _ratio(tp, tp + fn).alias("recall"))


# K7
def brier(scored: DataFrame, by=None, y: str = "y", p: str = "p") -> DataFrame:
    df, keys = _with_group(scored, _by(by))
    d = F.col(p) - F.col(y)
    return _drop_g(df.groupBy(*keys).agg(F.avg(d * d).alias("brier")), by)


# K8
def weighted_log_loss(scored: DataFrame, by=None, pos_weight: float = 15.0, alpha: float = 0.75,
                      gamma: float = 2.0, y: str = "y", p: str = "p") -> DataFrame:
    """Mean BCE with a positive-class weight, and mean focal loss, on
    probabilities clipped to [1e-15, 1-1e-15]."""
    df, keys = _with_group(scored, _by(by))
    q = F.least(F.greatest(F.col(p), F.lit(CLIP)), F.lit(1 - CLIP))
    yv = F.col(y).cast("double")
    bce = -(yv * F.log(q) + (1 - yv) * F.log(1 - q))
    wbce = -(pos_weight * yv * F.log(q) + (1 - yv) * F.log(1 - q))
    p_t = q * yv + (1 - q) * (1 - yv)
    a_t = alpha * yv + (1 - alpha) * (1 - yv)
    focal = a_t * F.pow(1 - p_t, F.lit(gamma)) * bce
    return _drop_g(df.groupBy(*keys).agg(F.avg(wbce).alias("weighted_bce"), F.avg(focal).alias("focal_loss")), by)


# K9
def compute_metrics(scored: DataFrame, by=None, threshold=None, frac: float = 0.10,
                    y: str = "y", p: str = "p", id_col: str = "id") -> DataFrame:
    """The nine ladder metrics as one row per group. ``threshold``: a
    number, a frame (keys..., threshold) or None (best F1 of the sweep)."""
    df, keys = _with_group(scored, _by(by))
    thr = best_threshold(df, keys, y, p) if threshold is None else threshold
    if not isinstance(thr, DataFrame):
        thr_df = df.select(*keys).distinct().withColumn("threshold", F.lit(float(thr)))
    else:
        thr_df = thr
    curve = score_curve(df, keys, y, p)  # one curve for AP, AUC and the top share
    top = _top_share(curve, df, keys, frac, y, p, id_col)
    parts = [curve.groupBy(*keys).agg(_ap().alias("pr_auc"), _auc().alias("roc_auc")),
             top.select(*keys, "precision_at_k", _lift(F.col("precision_at_k"), F.col("_rate")).alias("lift_at_k")),
             f1_precision_recall(df, keys, thr_df, y, p),
             brier(df, keys, y, p)]
    out = reduce(lambda a, b: a.join(b, keys), parts)
    tk = [k for k in keys if k in thr_df.columns]
    out = out.join(thr_df.select(*tk, "threshold"), tk) if tk else out.withColumn(
        "threshold", thr_df.agg(F.first("threshold")).scalar())
    cols = ["pr_auc", "roc_auc", "precision_at_k", "lift_at_k", "f1", "precision", "recall", "brier", "threshold"]
    return _drop_g(out.select(*keys, *cols), by)


# K10
def confusion_report(scored: DataFrame, by=None, threshold=0.5, y: str = "y", p: str = "p") -> DataFrame:
    """Per class precision/recall/F1/support, macro and weighted averages,
    accuracy, with the confusion counts on every row."""
    keys = _by(by)
    c = confusion_counts(scored, keys, threshold, y, p)
    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    f0 = F.when(p0 + r0 > 0, 2 * p0 * r0 / (p0 + r0)).otherwise(F.lit(0.0))
    f1 = F.when(p1 + r1 > 0, 2 * p1 * r1 / (p1 + r1)).otherwise(F.lit(0.0))
    s0, s1 = tn + fp, tp + fn
    n = (s0 + s1).cast("double")
    acc = _ratio(tn + tp, s0 + s1)

    def row(label, pr, rc, f, s):
        return F.struct(F.lit(label).alias("label"), pr.alias("precision"), rc.alias("recall"),
                        f.alias("f1_score"), s.cast("long").alias("support"))
    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, s0 + s1),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1),
        row("weighted avg", (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, s0 + s1))
    return c.select(*keys, "tn", "fp", "fn", "tp", F.inline(rows))


# K11
def roc_curve(scored: DataFrame, by=None, y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    keys = _by(by)
    c = score_curve(scored, by, y, p)
    return c.select(*keys, F.col(p).alias("threshold"),
                    _ratio(F.col("neg_cum"), F.col("n_neg")).alias("fpr"),
                    _ratio(F.col("pos_cum"), F.col("n_pos")).alias("tpr"))


# K12
def pr_curve(scored: DataFrame, by=None, y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus the end
    point precision 1, recall 0 with no threshold."""
    keys = _by(by)
    c = score_curve(scored, by, y, p)
    pts = c.select(*keys, F.col(p).alias("threshold"),
                   _ratio(F.col("pos_cum"), F.col("pos_cum") + F.col("neg_cum")).alias("precision"),
                   F.when(F.col("n_pos") > 0, F.col("pos_cum") / F.col("n_pos").cast("double")).otherwise(F.lit(1.0))
                    .alias("recall"))
    ends = (pts.select(*keys).distinct() if keys else pts.limit(1)).select(
        *keys, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"))
    return pts.unionByName(ends)


# K13
def best_f1_threshold(scored: DataFrame, by=None, y: str = "y", p: str = "p") -> DataFrame:
    """Threshold on the PR curve with the highest 2PR/(P+R+1e-9); the
    lowest threshold wins ties."""
    keys = _by(by) or ["_g"]
    df, _ = _with_group(scored, _by(by))
    c = pr_curve(df, keys, y, p).filter(F.col("threshold").isNotNull())
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(EPS_F1))
    out = c.withColumn("f1", f1).groupBy(*keys).agg(
        F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("threshold"),
        F.max("f1").alias("f1"))
    return _drop_g(out, by)


# K14
def calibration_curve(scored: DataFrame, by=None, y: str = "y", p: str = "p", edges=CALIBRATION_EDGES) -> DataFrame:
    """Uniform bins (bin = number of inner edges below p): mean p, share
    positive, count; non-empty bins only."""
    df, keys = _with_group(scored, _by(by))
    b = reduce(lambda a, e: a + F.when(F.lit(float(e)) < F.col(p), 1).otherwise(0), edges, F.lit(0))
    out = (df.withColumn("bin", b.cast("int")).groupBy(*keys, "bin")
             .agg(F.avg(F.col(y).cast("double")).alias("prob_true"), F.avg(p).alias("prob_pred"),
                  F.count(F.lit(1)).alias("n")))
    return _drop_g(out, by)


# K15
def failure_analysis(scored: DataFrame, features: list[str], threshold=0.5, by=None,
                     y: str = "y", p: str = "p") -> DataFrame:
    """Feature means for TP / FN / FP / TN rows and the TP - FN gap."""
    df, keys = _with_group(scored, _by(by))
    df, thr = _threshold_col(df, keys, threshold)
    pred = F.col(p) >= thr
    yv = F.col(y) == 1
    outcome = (F.when(yv & pred, "tp").when(yv & ~pred, "fn").when(~yv & pred, "fp").otherwise("tn"))
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    long = df.select(*keys, outcome.alias("outcome"), F.explode(pairs).alias("_m")).select(
        *keys, "outcome", "_m.feature", "_m.value")
    wide = (long.groupBy(*keys, "feature").pivot("outcome", ["tp", "fn", "fp", "tn"])
                .agg(F.avg("value")))
    out = wide.select(*keys, "feature", F.col("tp").alias("tp_mean"), F.col("fn").alias("fn_mean"),
                      F.col("fp").alias("fp_mean"), F.col("tn").alias("tn_mean"),
                      (F.col("tp") - F.col("fn")).alias("tp_fn_gap"))
    return _drop_g(out, by)


METRICS = ["pr_auc", "roc_auc", "precision_at_k", "lift_at_k", "f1", "precision", "recall", "brier"]


def _metric_long(metrics: DataFrame, keys: list[str], cols: list[str], model: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])
    return metrics.select(*keys, model, F.explode(pairs).alias("_m")).select(*keys, model, "_m.metric", "_m.value")


# K16
def model_ranking(metrics: DataFrame, by=("split",), cols=None, model: str = "model",
                  lower_is_better=("brier",)) -> DataFrame:
    """Best model per metric and group (highest, or lowest for losses;
    ties by model name)."""
    keys = list(by)
    long = _metric_long(metrics, keys, list(cols or METRICS), model).filter(F.col("value").isNotNull())
    sign = F.when(F.col("metric").isin(*lower_is_better), 1.0).otherwise(-1.0)
    return long.groupBy(*keys, "metric").agg(
        F.min_by(model, F.struct(sign * F.col("value"), F.col(model))).alias("best_model"),
        F.min_by("value", F.struct(sign * F.col("value"), F.col(model))).alias("best_value"))


def best_model_summary(metrics: DataFrame, by: str = "pr_auc") -> DataFrame:
    """One row naming the best model on val and on test and the one to use
    (best on val; ties by name), with its test metrics as a struct."""
    def best(split):
        here = F.col("split") == split
        score = F.coalesce(-F.col(by), F.lit(float("inf")))
        return F.min_by(F.when(here, F.col("model")), F.when(here, F.struct(score, F.col("model"))))

    row = metrics.agg(best("val").alias("overall_validation_best_model"), best("test").alias("overall_test_best_model"),
                      F.countDistinct("model").alias("n_total_models_evaluated"))
    test = metrics.where(F.col("split") == "test").select(
        F.col("model").alias("_m"), F.struct(*METRICS).alias("recommended_model_test_metrics"))
    return row.join(test, F.col("_m") == F.col("overall_validation_best_model"), "left").select(
        "overall_validation_best_model", "overall_test_best_model",
        F.col("overall_validation_best_model").alias("recommended_model"),
        F.lit(f"highest validation {by}").alias("recommendation_reason"),
        "recommended_model_test_metrics", "n_total_models_evaluated")


# K17
def relative_gain(metrics: DataFrame, baseline: str, by=("split",), cols=None, model: str = "model") -> DataFrame:
    """% change of each model's metric over the named baseline model."""
    keys = list(by)
    long = _metric_long(metrics, keys, list(cols or METRICS), model)
    base = long.filter(F.col(model) == baseline).select(*keys, "metric", F.col("value").alias("baseline_value"))
    return (long.join(base, [*keys, "metric"])
                .withColumn("gain_pct", F.when(F.col("baseline_value") != 0,
                                               (F.col("value") - F.col("baseline_value")) / F.col("baseline_value") * 100)))
