"""Hand-written fixtures with exact expected rows for the pandas -> Spark
semantic traps (first non-null, modes, label bounds, skew, AP, splits...)."""

import datetime as dt
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from rebuy.functions import scalar as S
from rebuy.operators import assemble as A
from rebuy.operators import cohort as C
from rebuy.operators import metrics as K
from rebuy.operators import ordering as D
from rebuy.operators import profile as P

T0 = dt.datetime(2020, 1, 1)


def ts(days=0, us=0):
    return T0 + dt.timedelta(days=days, microseconds=us)


def test_first_non_null_per_column(spark):
    # One result row may mix source rows
    rows = [Row(review_id=1, order_id=10, review_score=None, review_comment_message="x",
                review_creation_date=ts(1), review_answer_timestamp=ts(2)),
            Row(review_id=2, order_id=10, review_score=4, review_comment_message=None,
                review_creation_date=ts(3), review_answer_timestamp=ts(4))]
    out = C.one_review_per_order(spark.createDataFrame(rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.review_score, r.review_comment_message, r.review_creation_date) == (4, "x", ts(1))


def test_review_order_nulls_last(spark):
    rows = [Row(review_id=1, order_id=10, review_score=1, review_creation_date=None, review_answer_timestamp=ts(1)),
            Row(review_id=2, order_id=10, review_score=5, review_creation_date=ts(9), review_answer_timestamp=ts(9))]
    out = C.one_review_per_order(spark.createDataFrame(rows)).collect()[0]
    assert out.review_score == 5 and out.review_id == 2


def test_mode_or_unknown(spark):
    # T5: ties -> smallest, no value -> 'unknown', no rows -> NULL after the join
    items = spark.createDataFrame([Row(order_id=1, v="b"), Row(order_id=1, v="a"), Row(order_id=1, v=None),
                                   Row(order_id=2, v=None)], "order_id long, v string")
    modes = items.groupBy("order_id").agg(A.mode_or_unknown("v").alias("m"))
    base = spark.createDataFrame([Row(order_id=1), Row(order_id=2), Row(order_id=3)])
    got = {r.order_id: r.m for r in base.join(modes, "order_id", "left").collect()}
    assert got == {1: "a", 2: "unknown", 3: None}


def _label_for(spark, next_at):
    first = spark.createDataFrame([Row(customer_unique_id=1, score_time=T0)])
    purch = spark.createDataFrame([Row(customer_unique_id=1, order_purchase_timestamp=next_at)])
    out = C.repeat_label(C.next_purchase_after(first, purch))
    return out.collect()[0].target_repeat_within_180d


def test_label_bounds(spark):
    # Next purchase strictly after score time; window inclusive
    assert _label_for(spark, T0) == 0
    assert _label_for(spark, ts(0, 1)) == 1
    assert _label_for(spark, ts(180)) == 1
    assert _label_for(spark, ts(180, 1)) == 0


def test_text_functions(spark):
    df = spark.createDataFrame([Row(m=None), Row(m=""), Row(m="  hi  there!\n ok?! ")], "m string")
    text = S.review_text("m")
    clean = S.clean_text(text)
    got = df.select(text.alias("t"), S.text_present(text).alias("p"), S.word_count(clean).alias("w"),
                    S.count_char(clean, "!").alias("e"), S.count_char(clean, "?").alias("q")).collect()
    assert [tuple(r) for r in got[:2]] == [(S.NO_TEXT, 0, 0, 0, 0)] * 2  # T9
    assert (got[2].p, got[2].w, got[2].e, got[2].q) == (1, 3, 2, 1)


def test_ratio_clip_flags(spark):
    df = spark.createDataFrame([Row(a=1.0, b=0.0, d=None), Row(a=2.0, b=4.0, d=-40.0), Row(a=None, b=1.0, d=3.0)],
                               "a double, b double, d double")
    got = df.select(S.safe_ratio("a", "b").alias("r"), S.clip("d", -30, 30).alias("c"),
                    S.positive_flag("d").alias("f"), S.log1p_clipped("d").alias("l")).collect()
    assert got[0].r is None and got[0].c is None and got[0].f == 0 and got[0].l is None  # T7, T8
    assert got[1].r == 0.5 and got[1].c == -30.0 and got[1].f == 0 and got[1].l == 0.0
    assert got[2].r is None and got[2].f == 1 and abs(got[2].l - math.log1p(3.0)) < 1e-12


def test_weekend_monday_zero(spark):
    # 2020-01-04 is a Saturday, 2020-01-06 a Monday
    df = spark.createDataFrame([Row(t=dt.datetime(2020, 1, 4)), Row(t=dt.datetime(2020, 1, 6))], "t timestamp_ntz")
    assert [r[0] for r in df.select(S.calendar("t")[2]).collect()] == [1, 0]


def test_skew_kurtosis_pandas_conventions(spark):
    # Bias-corrected skewness and excess kurtosis
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 10, 50)], "x double")
    r = P.describe_numeric(df, ["x"]).collect()[0]
    assert abs(r.skewness - 2.085556) < 1e-6
    assert abs(r.kurtosis - 4.397534) < 1e-6


def test_average_precision_step_sum(spark):
    # 0.6667, not the trapezoid 0.65
    rows = [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.7), (4, 0, 0.7), (5, 0, 0.2), (6, 1, 0.1)]
    df = spark.createDataFrame(rows, "id long, y int, p double")
    ap = K.average_precision(df).collect()[0][0]
    assert abs(ap - 0.666667) < 1e-6
    auc = K.roc_auc(df).collect()[0][0]
    # pairs: pos (0.9, 0.7, 0.1) vs neg (0.8, 0.7, 0.2): 3 + 1.5 + 0 over 9
    assert abs(auc - 4.5 / 9) < 1e-12


def test_ap_invariant_under_monotone_map(spark):
    rows = [(i, int(i % 3 == 0), ((i * 37) % 101) / 101) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, y int, p double")
    a = K.average_precision(df).collect()[0][0]
    b = K.average_precision(df.withColumn("p", F.exp(F.col("p") * 3))).collect()[0][0]
    assert abs(a - b) < 1e-12


def test_split_cut_positions(spark):
    # 52224 -> 36556 / 7834 / 7834
    df = spark.range(52224).withColumn("score_time", (F.col("id") % 977).cast("double")).withColumnRenamed("id", "order_id")
    counts = {r.split: r["count"] for r in D.temporal_split(df).groupBy("split").count().collect()}
    assert counts == {"train": 36556, "val": 7834, "test": 7834}


def test_global_rank_is_permutation_and_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(20000).select(F.col("id"), (F.col("id") % 7).alias("g"), ((F.col("id") * 31) % 1000).alias("v"))
    # one key holds a third of the rows: still balanced because the order ends in a unique id
    df = df.withColumn("g", F.when(F.col("id") % 3 == 0, F.lit(99)).otherwise(F.col("g")))
    r = D.global_rank(df, ["g", ("v", False), "id"], n_buckets=16)
    agg = r.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).collect()[0]
    assert tuple(agg) == (1, 20000, 20000)
    w = Window.orderBy(F.col("g"), F.col("v").desc(), F.col("id"))
    ref = df.withColumn("rn", F.row_number().over(w))
    assert r.join(ref, "id").filter(F.col("rank") != F.col("rn")).count() == 0


def test_group_rank_independent_of_partitioning(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 5).alias("g"), ((F.col("id") * 13) % 97).alias("v"))
    a = D.group_rank(df, ["g"], [("v", False), "id"], name="r", n_buckets=7).select("id", "r")
    b = D.group_rank(df.repartition(13), ["g"], [("v", False), "id"], name="r", n_buckets=5).select(
        "id", F.col("r").alias("r2"))
    assert a.join(b, "id").filter(F.col("r") != F.col("r2")).count() == 0


def test_folds_balanced(spark):
    df = spark.range(1000).select(F.col("id").alias("order_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    f = D.stratified_folds(df, "y", k=3, seed=42)
    per = f.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        c = [r["count"] for r in per if r.y == y]
        assert max(c) - min(c) <= 1 and len(c) == 3


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    vals = [float((i * 7919) % 1009) / 7 for i in range(2001)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = P.quantile_columns(P.melt(df, ["x"]), ["feature"], {"q1": 0.25, "med": 0.5, "q3": 0.75}).collect()[0]
    for name, qq in (("q1", 0.25), ("med", 0.5), ("q3", 0.75)):
        assert abs(q[name] - float(np.quantile(vals, qq))) < 1e-9


def test_student_t_pvalue():
    from rebuy.functions.stats import t_two_sided_p
    assert abs(t_two_sided_p(2.0, 10.0) - 0.07338803477) < 1e-9
    assert abs(t_two_sided_p(0.0, 5.0) - 1.0) < 1e-12
    assert t_two_sided_p(50.0, 30.0) < 1e-20


def test_threshold_sweep_first_best(spark):
    rows = [(1, 1, 0.9), (2, 0, 0.1), (3, 1, 0.8), (4, 0, 0.2)]
    df = spark.createDataFrame(rows, "id long, y int, p double")
    best = K.best_threshold(df).collect()[0][0]
    assert abs(best - 0.25) < 1e-12  # every t in (0.2, 0.8] is perfect; the first grid point above 0.2 is 0.25


def test_calibration_bins_right_closed(spark):
    df = spark.createDataFrame([(1, 1, 0.1), (2, 0, 0.1000001), (3, 1, 1.0)], "id long, y int, p double")
    got = sorted((r.bin, r.n) for r in K.calibration_curve(df).collect())
    assert got == [(0, 1), (1, 1), (9, 1)]


def test_approx_quantiles_close_to_exact(spark):
    vals = [float((i * 7919) % 1009) for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    ex = P.quantile_columns(P.melt(df, ["x"]), ["feature"], {"med": 0.5}).collect()[0].med
    ap = P.quantile_columns(P.melt(df, ["x"]), ["feature"], {"med": 0.5}, approx=True).collect()[0].med
    assert abs(ex - ap) <= 2.0


def test_quantiles_of_a_column_that_one_value_fills(spark):
    import numpy as np
    vals = [0.0] * 1900 + [float(i) for i in range(1, 101)]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", 7.0), ("b", None)], "feature string, value double")
    got = {(r.feature, r.q): r.quantile for r in P.exact_quantiles(df, ["feature"], (0.25, 0.5, 0.951, 0.99)).collect()}
    for q in (0.25, 0.5, 0.951, 0.99):
        assert abs(got[("a", q)] - float(np.quantile(vals, q))) < 1e-9
        assert got[("b", q)] == 7.0


def test_equal_values_are_one_row_when_ranked(spark, monkeypatch):
    """No task holds the copies of a value: only counted values are ordered."""
    seen = []
    ranked = P.prefix_sums
    monkeypatch.setattr(P, "prefix_sums", lambda df, *a, **k: seen.append(df.count()) or ranked(df, *a, **k))
    df = spark.range(20000).select(F.lit("f").alias("feature"), F.when(F.col("id") % 20 == 0, 1.0).otherwise(0.0).alias("value"))
    assert P.quantile_columns(df, ["feature"], {"m": 0.5}).first().m == 0.0 and seen == [2]


def test_global_rank_over_many_ranges_with_a_hot_key(spark):
    df = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("g"))
    placed = D.in_buckets(df, ["g", ("id", False)], 8)
    assert placed.select("_bkt").distinct().count() >= 8
    got = [r.id for r in D.global_rank(df, ["g", ("id", False)], n_buckets=8).orderBy("rank").collect()]
    want = [r.id for r in df.orderBy("g", F.desc("id")).collect()]
    assert got == want


def test_global_rank_of_an_empty_table(spark):
    assert D.global_rank(spark.range(0), ["id"]).count() == 0
