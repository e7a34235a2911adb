"""Properties of the model, PCA and explanation operators on small data."""

import pytest
from pyspark.sql import functions as F

from rebuy.operators import encoders as E
from rebuy.operators import explain as X
from rebuy.operators import metrics as K
from rebuy.operators import models as M
from rebuy.operators import profile as P


@pytest.fixture(scope="module")
def frame(spark):
    # a separable toy task: y = 1 when x1 + noise is large
    df = spark.range(600).select(
        F.col("id").alias("order_id"),
        ((F.col("id") * 7919) % 1000 / 1000.0).alias("x1"),
        ((F.col("id") * 104729) % 997 / 997.0).alias("x2"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("cat"))
    df = df.withColumn("target_repeat_within_180d", (F.col("x1") + 0.2 * F.col("x2") > 0.85).cast("int"))
    return df.withColumn("split", F.when(F.col("order_id") % 5 == 0, "test").otherwise("train"))


def test_class_weights_balanced(spark, frame):
    w = {r.target_repeat_within_180d: r.balanced_weight for r in M.class_weights(frame).collect()}
    n = frame.count()
    n1 = frame.filter("target_repeat_within_180d = 1").count()
    assert abs(w[1] - n / (2 * n1)) < 1e-12 and abs(w[0] - n / (2 * (n - n1))) < 1e-12


def test_weighted_logistic_ranks_well(spark, frame):
    tm = M.TabularModel("lr", ["x1", "x2"], ["cat"], lambda n: M.logistic("all_features", "weight", n))
    tm.fit(frame.filter("split = 'train'"))
    s = tm.score(frame.filter("split = 'test'")).select(F.col("target_repeat_within_180d").alias("y"), "p")
    assert K.roc_auc(s).first()[0] > 0.95
    coef = X.linear_coefficients(tm.model, tm.pre.columns()).collect()
    assert coef[0].feature == "x1" and coef[0].coefficient > 0


def test_random_forest_and_importances(spark, frame):
    tm = M.TabularModel("rf", ["x1", "x2"], ["cat"], lambda n: M.RandomForestClassifier(
        labelCol="label", weightCol="weight", numTrees=20, maxDepth=4, seed=1), scale=False,
        categorical_mode="ordinal").fit(frame.filter("split = 'train'"))
    imp = X.tree_importance(tm.model, tm.pre.columns(), 3).collect()
    assert imp[0].feature == "x1"


def test_pca_shares_sum_to_one(spark, frame):
    scree, model = P.pca_scree(frame, ["x1", "x2"])
    rows = scree.orderBy("component").collect()
    assert abs(rows[-1].cum_share - 1.0) < 1e-9
    assert P.pca_loadings(model, ["x1", "x2"], top=2).count() == 2


def test_tfidf_rows_are_unit_length(spark):
    docs = spark.createDataFrame([(i, " ".join(["alpha beta", "gamma", "beta delta"][: 1 + i % 3]) + " alpha")
                                  for i in range(30)], "order_id long, review_text string")
    vocab = E.fit_tfidf(docs, min_df=5)
    w = E.tfidf_weights(docs, vocab)
    norms = w.groupBy("order_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-9 for r in norms)
    terms = {r.term for r in vocab.collect()}
    assert "alpha" in terms and "beta alpha" in terms or "alpha beta" in terms


def test_partial_dependence_grid_bounded(spark, frame):
    tm = M.TabularModel("lr", ["x1", "x2"], [], lambda n: M.logistic("all_features", "weight", n))
    tm.fit(frame.filter("split = 'train'"))
    feats = M.prepare(frame)

    def score(df):
        return tm.score(df)
    pdp = X.partial_dependence(score, feats, "x1").collect()
    assert 1 < len(pdp) <= 100
    vals = [r.mean_probability for r in sorted(pdp, key=lambda r: r.grid_value)]
    assert vals[-1] > vals[0]  # probability rises with x1


def test_permutation_importance_ranks_the_signal_first(spark, frame):
    scored = lambda df: df.withColumn("p", F.col("x1") + 0.2 * F.col("x2"))
    data = M.prepare(frame).select("order_id", "label", "x1", "x2", F.lit(1.0).alias("flat"))
    got = X.permutation_importance(scored, data, ["x1", "x2", "flat"], repeats=2).collect()
    assert got[0].feature == "x1" and got[0].importance_mean > 0.2
    assert abs({r.feature: r.importance_mean for r in got}["flat"]) < 1e-12


def test_partial_dependence_of_an_empty_feature_has_no_rows(spark, frame):
    data = frame.select("order_id", F.lit(None).cast("double").alias("x1"))
    assert X.partial_dependence(lambda df: df.withColumn("p", F.lit(0.5)), data, "x1").count() == 0


def test_out_of_fold_scores_cover_every_row(spark, frame):
    pre = E.TabularPreprocessor(["x1", "x2"], [], scale=False, output="all_features").fit(frame)
    data = pre.transform(M.prepare(frame))
    tr, other = M.boosted_oof(data.filter("split = 'train'"), data.filter("split = 'test'"), k=2, max_iter=3)
    assert tr.filter("oof is not null").count() == 480 and other.filter("oof is not null").count() == 120
    s = other.select(F.col("label").alias("y"), F.col("oof").alias("p"))
    assert K.roc_auc(s).first()[0] > 0.9


def test_grid_search_has_a_row_for_each_combination(spark, frame):
    pre = E.TabularPreprocessor(["x1", "x2"], [], scale=False, output="all_features").fit(frame)
    data = M.pos_weighted(pre.transform(M.prepare(frame)), "label")
    _, table = M.grid_search(data, M.gbt_estimator(), {"maxIter": [1, 2], "maxDepth": [2]}, folds=2)
    assert table.count() == 2 and table.filter("mean_roc_auc > 0.8").count() == 2


def test_forests_of_a_grid_that_differ_in_depth_are_one_fit(spark, frame, monkeypatch):
    pre = E.TabularPreprocessor(["x1", "x2"], [], scale=False, output="all_features").fit(frame)
    data = M.with_weights(pre.transform(M.prepare(frame)), "label")
    grid = {"numTrees": [6], "maxDepth": [2, 5], "minInstancesPerNode": [2, 9]}
    fits, fit = [], M.RandomForestClassifier.fit
    monkeypatch.setattr(M.RandomForestClassifier, "fit", lambda self, rows, params=None: fits.append(1) or fit(self, rows, params))
    est = M.rf_estimator()
    best, table = M.grid_search(data, est, grid, folds=2)
    assert len(fits) == 2 * 2 + 1 and best.getNumTrees == 6  # a leaf size and fold each, and the last one
    # Every combination fitted on its own has the same mean.
    table = {r.params: r.mean_roc_auc for r in table.collect()}
    rows = M.training_table(M.stratified_folds(data, "label", 2, 42, "order_id", name="fold"))
    b = M.ParamGridBuilder()
    for k, v in grid.items():
        b = b.addGrid(est.getParam(k), v)
    auc = M.BinaryClassificationEvaluator(labelCol="label")
    for m in b.build():
        scores = [auc.evaluate(fit(est, rows.where(F.col("fold") != f), m).transform(rows.where(F.col("fold") == f))) for f in (0, 1)]
        assert abs(table[str({p.name: v for p, v in m.items()})] - sum(scores) / 2) < 1e-9


def test_ladder_counts_the_terms_of_a_text_once(spark, frame, monkeypatch):
    words = F.concat_ws(" ", F.lit("alpha"), F.when(F.col("x1") > 0.7, "good").otherwise("plain"), F.col("cat"))
    splits = frame.withColumn("review_text", words).withColumn(
        "split", F.when(F.col("order_id") % 5 == 0, "test").when(F.col("order_id") % 5 == 1, "val").otherwise("train"))
    models = [lambda: M.TabularModel("words", [], [], lambda n: M.logistic("all_features", "weight", n), text=True, tabular=False),
              lambda: M.TabularModel("both", ["x1"], [], lambda n: M.logistic("all_features", "weight", n), text=True)]
    train, held = splits.filter("split = 'train'"), splits.filter("split <> 'train'")
    want = {}
    for mk in models:
        tm = mk().fit(train)
        want[tm.name] = {r.split: r.average_precision for r in K.average_precision(M._scored(tm.score(held), tm.name), ["split"]).collect()}
    counted, terms = [], E.terms
    monkeypatch.setattr(E, "terms", lambda *a: counted.append(1) or terms(*a))
    got = M.model_ladder(splits, models).collect()
    assert len(counted) == 3  # for the vocabulary, the train rows and the held rows, whatever the models
    assert len(got) == 6 and all(abs(r.pr_auc - want[r.model][r.split]) < 1e-9 for r in got if r.model in want)


def test_staged_search_scores_first_rounds(spark, frame):
    pre = E.TabularPreprocessor(["x1", "x2"], [], scale=False, output="all_features").fit(frame)
    data = M.training_table(M.pos_weighted(pre.transform(M.prepare(frame)), "label"))
    grid = {"maxIter": [2, 5], "maxDepth": [2], "stepSize": [0.1], "subsamplingRate": [0.8], "minInstancesPerNode": [10, 20]}
    best, table = M.staged_grid_search(data, grid, folds=2)
    assert table.count() == 4 and table.filter("mean_roc_auc > 0.8").count() == 4 and best.getNumTrees in (2, 5)
    # The first rounds of a long fit are the short fit.
    fits = [M.gbt_estimator().setMaxIter(n).setMaxDepth(2).setSubsamplingRate(0.8).fit(data) for n in (3, 6)]
    cut = M.first_rounds(fits[1], 3)
    assert cut.getNumTrees == 3
    a, b = (M.batch_score(m, data).select("order_id", "p").orderBy("order_id").collect() for m in (fits[0], cut))
    assert all(abs(x.p - y.p) < 1e-12 for x, y in zip(a, b))


def test_components_are_those_of_scaled_rows(spark, frame):
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    data = frame.select("x1", "x2", (F.col("x1") * 2 + F.col("x2") * F.col("x2")).alias("x3"), F.lit(0.1).alias("flat"),
                        F.when(F.col("order_id") % 9 > 0, F.col("x2") - F.col("x1")).alias("gap"))
    cols = data.columns
    _, model = P.pca_scree(data, cols)
    vec = VectorAssembler(inputCols=cols, outputCol="v").transform(data.na.fill(0.0))
    scaled = StandardScaler(inputCol="v", outputCol="s", withMean=True).fit(vec).transform(vec)
    want = PCA(k=len(cols), inputCol="s", outputCol="p").fit(scaled)
    assert abs(model.explainedVariance.toArray() - want.explainedVariance.toArray()).max() < 1e-9
    assert (abs(abs(model.pc.toArray()[:, :3]) - abs(want.pc.toArray()[:, :3])) < 1e-6).all()
    assert max(model.residuals()) < 1e-9
