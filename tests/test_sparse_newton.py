"""Sparse vectors from arrays, join-coded categories, Newton steps."""

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rebuy.operators import encoders as E
from rebuy.operators import models as M


def test_one_vector_of_numbers_and_categories(spark):
    train = spark.createDataFrame([(1, 1.0, "b", "x"), (2, 3.0, "a", None), (3, None, "b", "y")], "order_id long, n double, c string, d string")
    rows = spark.createDataFrame([(7, 2.0, "a", "y"), (8, None, "zzz", None)], "order_id long, n double, c string, d string")
    pre = E.TabularPreprocessor(["n"], ["c", "d"], scale=False).fit(train)
    assert pre.columns() == ["n", "c_a", "c_b", "d_x", "d_y"]
    assert [tuple(r) for r in pre.names(spark).orderBy("position").collect()] == list(enumerate(pre.columns()))
    got = {r.order_id: r.features for r in pre.transform(rows).collect()}
    # d is missing: the train mode (the smallest on ties), x
    assert got[7].toArray().tolist() == [2, 1, 0, 0, 1] and got[8].toArray().tolist() == [2, 0, 0, 1, 0]
    assert list(got[7].indices) == [0, 1, 4] and got[7].size == 5


def test_many_categories_keep_the_plan_small(spark):
    n = 100_000
    train = spark.range(n).select(F.col("id").alias("order_id"), F.concat(F.lit("v"), F.col("id")).alias("c"))
    plans = []
    for t in (train.where("order_id < 10"), train):
        pre = E.TabularPreprocessor([], ["c"], scale=False).fit(t)
        plans.append(len(pre.encode(t)._jdf.queryExecution().analyzed().toString()))
    assert pre.size == n and plans[1] < 1.2 * plans[0]
    vectors = pre.transform(train)
    assert vectors.where(F.element_at(vector_to_array("features"), 1) == 1).count() == 1
    places = vectors.sample(0.001, 3).select("c", "features").collect()
    names = {r.position: r.feature for r in pre.names(spark).collect()}
    assert all(names[int(r.features.indices[0])] == f"c_{r.c}" for r in places)


def toy(spark):
    df = spark.range(900).select(
        F.col("id").alias("order_id"), ((F.col("id") * 7919) % 1000 / 1000.0).alias("a"), ((F.col("id") * 104729) % 997 / 99.7).alias("b"),
        (1 + F.col("id") % 3).cast("double").alias("weight"))
    df = df.withColumn("label", ((F.col("a") + 0.05 * F.col("b") + ((F.col("order_id") * 31) % 17) / 40.0) > 0.9).cast("double"))
    return E.with_vectors(df.withColumn("x", E.sparse_struct(2, F.array(F.lit(0), F.lit(1)), F.array("a", "b"))), ["x"])


def test_newton_reaches_the_minimum(spark):
    data = toy(spark)
    model = M.logistic("x", "weight", 900).fit(data)
    reg = 1 / 900
    beta = np.append(model.coefficients.toArray(), model.intercept)
    g, _, _, n = M.logistic_sums(data, beta, "x", "label", "weight")
    assert np.abs(g / n + reg * np.append(beta[:-1], 0)).max() < 1e-10
    spark_lr = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", regParam=reg, elasticNetParam=0.0,
                                  standardization=False, maxIter=5000, tol=1e-12).fit(data)
    assert np.allclose(beta, np.append(spark_lr.coefficients.toArray(), spark_lr.intercept), atol=1e-4)
    p = data.select("x", vector_to_array("x").alias("v")).limit(50)
    for r in M.batch_score(model, p).collect():
        assert abs(r.p - 1 / (1 + np.exp(-(np.dot(r.v, beta[:-1]) + beta[-1])))) < 1e-12


def test_newton_of_equal_columns_and_of_one_class(spark):
    data = toy(spark).select("label", "weight", "x")
    twice = E.with_vectors(data.select("label", "weight", E.sparse_struct(2, F.array(F.lit(0), F.lit(1)), F.array(vector_to_array("x")[0], vector_to_array("x")[0])).alias("x")), ["x"])
    model = M.logistic("x", "weight", None).fit(twice)  # without ridge
    assert abs(model.coefficients[0] - model.coefficients[1]) < 1e-6
    one = M.logistic("x", "weight", 900).fit(data.where("label = 1"))
    assert one.intercept > 5
