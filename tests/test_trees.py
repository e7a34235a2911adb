"""Tree models as tables: scores, partial dependence, small expressions."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rebuy.operators import encoders as E
from rebuy.operators import explain as X
from rebuy.operators import models as M
from rebuy.operators import trees as N


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(700).select(F.col("id").alias("order_id"), ((F.col("id") * 7919) % 1000 / 1000.0).alias("a"),
                                 ((F.col("id") * 104729) % 997 / 997.0).alias("b"), (F.col("id") % 4).cast("double").alias("c"))
    df = df.withColumn("label", ((F.col("a") + 0.3 * F.col("b") + (F.col("order_id") % 7) / 20) > 0.8).cast("double"))
    return E.with_vectors(df.withColumn("features", E.sparse_struct(3, F.array(*map(F.lit, range(3))), F.array("a", "b", "c"))), ["features"])


@pytest.mark.parametrize("boosted", [False, True])
def test_node_table_scores_as_the_model(spark, data, boosted):
    est = GBTClassifier(maxIter=6, maxDepth=3, seed=2) if boosted else RandomForestClassifier(numTrees=9, maxDepth=6, seed=2, minInstancesPerNode=3)
    model = est.fit(data)
    nodes = N.node_table(model)
    want = {r.order_id: r.p for r in M.batch_score(model, data).select("order_id", "p").collect()}
    got = {r.order_id: r.p for r in N.tree_scores(data, nodes, vector_to_array("features"), "order_id", boosted).collect()}
    assert len(got) == 700 and all(abs(want[k] - got[k]) < 1e-9 for k in want)
    if boosted:
        m = N.margin(nodes.collect(), [F.col(c) for c in "abc"])
        got = {r.order_id: r.p for r in data.select("order_id", (1 / (1 + F.exp(-2 * m))).alias("p")).collect()}
        assert all(abs(want[k] - got[k]) < 1e-9 for k in want)


def test_linear_scores_as_the_model(spark, data):
    model = M.logistic("features", None, 700).fit(data)
    coef = spark.createDataFrame([(i, float(v)) for i, v in enumerate(model.coefficients.toArray())], "position long, coefficient double")
    want = {r.order_id: r.p for r in M.batch_score(model, data).select("order_id", "p").collect()}
    got = N.linear_scores(data, coef, float(model.intercept), vector_to_array("features"), "order_id").collect()
    assert len(got) == 700 and all(abs(want[r.order_id] - r.p) < 1e-12 for r in got)


def test_partial_dependence_by_recursion(spark):
    # One tree: x0 <= 1 goes to a leaf of 0.2 (30 rows); else x1 <= 5 to 0.4 (20 rows) or 0.9 (50 rows).
    rows = [(0, 0, 0, 1.0, 1, 2, 0.0, 100.0, 1.0), (0, 1, -1, None, -1, -1, 0.2, 30.0, 1.0), (0, 2, 1, 5.0, 3, 4, 0.0, 70.0, 1.0),
            (0, 3, -1, None, -1, -1, 0.4, 20.0, 1.0), (0, 4, -1, None, -1, -1, 0.9, 50.0, 1.0)]
    nodes = spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, value double, rows double, weight double")
    got = {r.grid_value: r.mean_probability for r in N.tree_partial_dependence(nodes, 1, [5.0, 6.0]).collect()}
    assert np.allclose([got[5.0], got[6.0]], [0.3 * 0.2 + 0.7 * 0.4, 0.3 * 0.2 + 0.7 * 0.9])
    got = {r.grid_value: r.mean_probability for r in N.tree_partial_dependence(nodes, 0, [1.0, 2.0]).collect()}
    assert np.allclose([got[1.0], got[2.0]], [0.2, 2 / 7 * 0.4 + 5 / 7 * 0.9])


@pytest.fixture(scope="module")
def forest(data):
    return RandomForestClassifier(numTrees=25, maxDepth=9, seed=4, minInstancesPerNode=2, featuresCol="features").fit(data)


def copies_scored(forest, names):
    assembled = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    return lambda df: M.batch_score(forest, assembled.transform(df.drop("features")))


def test_forest_arrays_give_the_scores_of_copies(spark, data, forest):
    # Donors of every kind: other rows, the row itself, values beyond all thresholds, NaN.
    f = N.forest_arrays(forest)
    x = np.array([r.x for r in data.select(vector_to_array("features").alias("x")).orderBy("order_id").collect()])[:60]
    donors = np.stack([x[::-1], x, np.full_like(x, 9.0), np.full_like(x, np.nan)], axis=1)
    got = N.donor_scores(f, x, donors)
    rows = []
    for j in range(3):
        for r in range(4):
            for i in range(len(x)):
                v = x[i].copy()
                v[j] = donors[i, r, j]
                rows.append((j * 4 + r, i, *map(float, v)))
    df = spark.createDataFrame(rows, "slot int, i int, a double, b double, c double")
    for r in copies_scored(forest, list("abc"))(df).select("slot", "i", "p").collect():
        assert got[r.slot, r.i] == r.p  # votes add up in the same order


def test_permutation_importance_of_a_forest_is_that_of_its_copies(spark, data, forest):
    rows = data.drop("features").withColumn("c", F.when(F.col("order_id") % 11 > 0, F.col("c")))
    score, seen = copies_scored(forest, list("abc")), []

    def counted(df):
        seen.append(df.count())
        return score(df)

    want = X.permutation_importance(score, rows, list("abc"), repeats=2).collect()
    got = X.permutation_importance(counted, rows, list("abc"), repeats=2, forest=N.forest_arrays(forest)).collect()
    assert seen == [700]  # the rows as they are, once: no copies
    assert [r.feature for r in got] == [r.feature for r in want]
    assert np.allclose([r[1:] for r in got], [r[1:] for r in want], atol=1e-12)


@pytest.mark.parametrize("feature", ["a", "c"])
def test_partial_dependence_of_a_forest_is_that_of_its_copies(spark, data, forest, feature):
    rows = data.drop("features").withColumn("b", F.when(F.col("order_id") % 5 > 0, F.col("b")))
    score = copies_scored(forest, list("abc"))
    want = {r.grid_value: r.mean_probability for r in X.partial_dependence(score, rows, feature).collect()}
    got = {r.grid_value: r.mean_probability for r in X.partial_dependence(
        score, rows, feature, forest=N.forest_arrays(forest), features=list("abc")).collect()}
    assert len(got) == (100 if feature == "a" else 4) and got.keys() == want.keys()
    assert all(abs(got[g] - want[g]) < 1e-12 for g in want)


def test_a_forest_cut_at_a_depth_is_the_fit_of_that_depth(spark, data):
    fit = lambda d: RandomForestClassifier(numTrees=12, maxDepth=d, seed=7, minInstancesPerNode=2, cacheNodeIds=True).fit(data)
    raw = N.cut_scores(data, N.forest_arrays(fit(14)), vector_to_array("features"), [2, 6, 14]).collect()
    for i, depth in enumerate([2, 6, 14]):
        want = fit(depth).transform(data).select("label", vector_to_array("rawPrediction")[1].alias("p")).collect()
        assert sorted((r.label, r.raw[i]) for r in raw) == sorted((r.label, r.p) for r in want)
