"""Properties of histogram, running shares, step deltas, reports and gates."""

from pyspark.sql import functions as F

from rebuy.operators import metrics as K
from rebuy.operators import ordering as D
from rebuy.operators import profile as P
from rebuy.operators import quality as Q


def test_histogram_counts_and_closed_last_bin(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 2).alias("g"))
    h = P.histogram(df, "x", bins=10, by="g", density=True).collect()
    for g in (0, 1):
        rows = sorted((r for r in h if r.g == g), key=lambda r: r.bin)
        assert len(rows) == 10 and sum(r["count"] for r in rows) == 500
        assert rows[-1].bin_right == 96.0 and rows[-1]["count"] > 0  # the maximum lands in the last bin
        area = sum(r.density * (r.bin_right - r.bin_left) for r in rows)
        assert abs(area - 1.0) < 1e-9


def test_cumulative_share_reaches_one(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([50, 30, 10, 6, 4])], "i int, v double")
    out = D.cumulative_share(df, "v", [("v", False), "i"]).orderBy("idx").collect()
    assert abs(out[-1].cum_share - 1.0) < 1e-12
    assert out[0].first_at_90 == 3 and out[0].first_at_95 == 4


def test_step_delta_flags_one_largest_gain(spark):
    df = spark.createDataFrame([(1, 0.10), (2, 0.15), (3, 0.30), (4, 0.31)], "step int, v double")
    out = {r.step: r for r in D.step_delta(df, "v", "step").collect()}
    assert out[1].delta is None and sum(r.is_largest_gain for r in out.values()) == 1
    assert out[3].is_largest_gain == 1


def test_confusion_report_consistency(spark):
    rows = [(i, int(i % 4 == 0), ((i * 37) % 101) / 101) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, y int, p double")
    rep = {r.label: r for r in K.confusion_report(df, threshold=0.5).collect()}
    r0 = rep["0"]
    n = r0.tn + r0.fp + r0.fn + r0.tp
    assert n == 400 and rep["0"].support + rep["1"].support == n
    assert abs(rep["accuracy"].f1_score - (r0.tn + r0.tp) / n) < 1e-12


def test_quality_report_passes_on_clean_split(spark):
    df = spark.range(300).select(F.col("id").alias("order_id"), F.col("id").cast("double").alias("score_time"),
                                 (F.col("id") % 2).alias("y"))
    rep = Q.quality_report(D.temporal_split(df), n_columns=3)
    assert all(r.passed == 1 for r in rep.collect())


def test_quality_report_catches_overlap(spark):
    df = spark.createDataFrame([(1, 1.0, "train"), (1, 2.0, "val"), (2, 3.0, "test"), (2, 0.5, "test")],
                               "order_id long, score_time double, split string")
    rep = {r.check: r.passed for r in Q.quality_report(df).collect()}
    assert rep["splits_disjoint"] == 0 and rep["unique_order_id_test"] == 0 and rep["val_before_test"] == 0


def test_seeded_sample_exact_and_reproducible(spark):
    df = spark.range(20000).select(F.col("id").alias("order_id"))
    a = {r.order_id for r in D.seeded_sample(df, 5000, seed=42).collect()}
    b = {r.order_id for r in D.seeded_sample(df.repartition(7), 5000, seed=42).collect()}
    c = {r.order_id for r in D.seeded_sample(df, 5000, seed=43).collect()}
    assert len(a) == 5000 and a == b and a != c


def test_top_k_ties_by_name(spark):
    df = spark.createDataFrame([("b", 3.0), ("a", 3.0), ("c", 5.0), ("d", 1.0)], "name string, v double")
    assert [r.name for r in D.top_k(df, "v", 3, tiebreak=["name"]).collect()] == ["c", "a", "b"]
