"""What moves and where: texts, classes, terms, gradients, copies, folds."""

import re
import threading
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rebuy.llm import personal_data as PD
from rebuy.operators import assemble as A
from rebuy.operators import encoders as E
from rebuy.operators import explain as X
from rebuy.operators import metrics as K
from rebuy.operators import models as M
from rebuy.operators import ordering as D
from rebuy.operators import profile as P
from rebuy.sources import retail as R


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime(1997, 1, 1)
    orders = [(k, k % 7, "F", day + timedelta(days=k % 50)) for k in range(1, 400)] + [(None, 1, "F", day)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    docs = [(i, None if i % 5 == 0 else f"text {i}é!?") for i in range(40) if i % 7] + [(1, None), (2, "text 2é!?"), (None, "lost")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_references_give_the_same_messages(spark, tables):
    """Of reviews that differ by a repeated document only, any may stand: the text wins over null."""
    by_ref = {tuple(r) for r in R.with_messages(R.v_review_refs(spark, tables), spark, tables).collect()}
    by_text = {tuple(r) for r in R.v_reviews(spark, tables).collect()}
    at = R.v_reviews(spark, tables).columns.index("review_comment_message")
    full = {r[0] for r in by_text if r[at] is not None}
    assert by_ref == {r for r in by_text if r[at] is not None or r[0] not in full}
    assert {r[at] is None for r in by_ref} == {True, False} and any((r[at] or "").endswith(" ok?!") for r in by_ref)
    refs = R.v_review_refs(spark, tables)
    assert not re.search(r"Exchange.*\btext#", plan(refs))


def test_reviews_without_a_document_are_spread(spark, tables):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for reviews in (R.v_review_refs, R.v_reviews):
            sizes = [r["count"] for r in reviews(spark, tables).groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) < sum(sizes) / 3 and sum(sizes) > 250
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_groups_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = spark.range(200).select(F.col("id"), F.when(F.col("id") % 4 == 0, "val").otherwise("test").alias("split"),
                                         (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 7 / 7).alias("p"))
        thresholds = spark.createDataFrame([("val", 0.5), ("test", 0.2)], "split string, threshold double")
        medians = P.quantile_columns(P.melt(scored, ["id", "y", "p"]), ["feature"], {"median": 0.5})
        products = scored.select(F.col("id").alias("product_id"), F.col("split").alias("product_category_name"))
        names = spark.createDataFrame([("val", "v")], "product_category_name string, product_category_name_english string")
        for out in (medians, K.score_curve(scored, ["split"]), K.confusion_counts(scored, ["split"], thresholds),
                    D.group_rank(scored, ["split"], ["id"], few=True), A.category_translate(products, names)):
            assert "SortMergeJoin" not in plan(out) and "BroadcastHashJoin" in plan(out)
        assert {r.feature: r.median for r in medians.collect()} == {"id": 99.5, "y": 0.0, "p": 3 / 7}
        got = {r.split: (r.tn, r.fp, r.fn, r.tp) for r in K.confusion_counts(scored, ["split"], thresholds).collect()}
        want = Counter(("val" if i % 4 == 0 else "test", i % 3 == 0, i % 7 / 7 >= (0.5 if i % 4 == 0 else 0.2)) for i in range(200))
        assert got == {s: tuple(want[s, y, over] for y in (False, True) for over in (False, True)) for s in ("val", "test")}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_classes_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select(F.col("id").alias("order_id"), (F.col("id") % 10 == 0).cast("int").alias(M.TARGET))
        for out, key in ((M.with_weights(df), M.TARGET), (D.stratified_folds(df, M.TARGET, 3), M.TARGET)):
            assert "SortMergeJoin" not in plan(out) and "BroadcastHashJoin" in plan(out)
            assert out.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


TEXTS = [(1, "a bb cc bb cc"), (2, None), (3, ""), (1, "cc dd"), (4, "Bb bb BB"), (None, "xx yy"), (5, "ÄÄ x1 _z")]


def test_terms_are_counted_where_their_id_is(spark):
    df = spark.createDataFrame(TEXTS, "order_id long, t string")
    want = Counter()
    for i, t in TEXTS:
        toks = re.findall(r"\w{2,}", (t or "").lower())
        want.update((i, x) for x in toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])])
    got = E.terms(df, "t", "order_id")
    assert {(r.order_id, r.term): r.tf for r in got.collect()} == dict(want)
    assert all("term" not in x for x in re.findall(r"Exchange hashpartitioning\(.*", plan(got)))


def test_a_text_is_cut_and_sorted_once(spark):
    df = spark.createDataFrame(TEXTS, "order_id long, t string")
    vocab = spark.createDataFrame([("bb", 0, 1.0)], "term string, index long, idf double")
    for out in (E.terms(df, "t", "order_id"), E.tfidf_weights(df, vocab, "t", "order_id")):
        p = out._jdf.queryExecution().optimizedPlan().toString()
        assert p.count("sort_array") == p.count("regexp_extract_all") == 1


def test_only_the_vocabulary_is_broadcast(spark):
    df = spark.createDataFrame(TEXTS, "order_id long, t string")
    vocab = spark.createDataFrame([("bb", 0, 1.0), ("cc", 1, 2.0)], "term string, index long, idf double")
    weights = E.tfidf_weights(df, vocab, "t", "order_id")
    p = plan(weights)
    assert "BroadcastHashJoin" in p and "BuildRight" in p and "SortMergeJoin" not in p
    assert {r.order_id for r in weights.collect()} == {1, 4}
    joined = plan(E.tfidf_structs(df.drop("t"), weights, 2))
    assert joined.count("BroadcastExchange") == p.count("BroadcastExchange")


def test_wide_logistic_sums_few_gradients(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(M.LogisticRegression, "fit", lambda self, data: seen.append((data.rdd.getNumPartitions(), data.count())))
    rows = [(Vectors.sparse(600, [i % 600], [1.0]), float(i % 2), 1.0) for i in range(50)]
    data = spark.createDataFrame(rows, ["all_features", "label", "weight"]).repartition(100)
    M.logistic("all_features", "weight", 50).fit(data)
    assert seen == [(min(100, 2 * spark.sparkContext.defaultParallelism), 50)]


def test_copies_of_a_narrow_slice_are_dealt_out(spark):
    df = spark.range(50).coalesce(1).select(F.col("id").alias("order_id"), (F.col("id") % 4).cast("double").alias("v"))
    parts = []

    def score(d):
        parts.append(d.rdd.getNumPartitions())
        return d.withColumn("p", F.col("v") / 4)
    got = {r.grid_value: r.mean_probability for r in X.partial_dependence(score, df, "v").collect()}
    assert got == {0.0: 0.0, 1.0: 0.25, 2.0: 0.5, 3.0: 0.75}
    assert parts[0] >= spark.sparkContext.defaultParallelism


def test_folds_are_fitted_side_by_side(spark, monkeypatch):
    together = threading.Barrier(3, timeout=120)

    class Fitted(Exception):
        pass

    def fit(self, data):
        assert "review_text" not in data.columns
        together.wait()
        raise Fitted
    monkeypatch.setattr(M.GBTClassifier, "fit", fit)
    rows = [(i, i % 2, float(i % 2), Vectors.dense([float(i)]), "x") for i in range(30)]
    train = spark.createDataFrame(rows, ["order_id", M.TARGET, "label", "all_features", "review_text"])
    with pytest.raises(Fitted):
        M.boosted_oof(train, train, k=3)


def test_personal_data_is_fitted_on_every_label(spark, monkeypatch):
    seen = []

    class Fitted(Exception):
        pass

    def fit(self, data):
        seen.append(data.count())
        raise Fitted
    monkeypatch.setattr(PD.GBTClassifier, "fit", fit)
    n = 40_000
    labelled = spark.range(n).select(F.col("id").alias("key"), F.lit("card").alias("kind"), F.lit(0).alias("start"), F.lit(9).alias("end"),
                                     *[F.lit(1.0).alias(f"f_{f}") for f in PD.FEATURES], (F.col("id") % 3 == 0).cast("int").alias("label"))
    with pytest.raises(Fitted):
        PD.fit(labelled)
    held = labelled.where(F.pmod(F.xxhash64("key", "start"), F.lit(4)) == 0).count()
    assert seen == [n - held] and seen[0] > 20_000
