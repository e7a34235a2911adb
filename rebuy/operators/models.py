"""Models: priors and weights (M1, M2, M13) here; distributed estimators
(M3–M16) below them."""

from __future__ import annotations

import uuid
from functools import reduce
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TARGET = "target_repeat_within_180d"


# M1
def dummy_prior(train: DataFrame, scored: DataFrame, target: str = TARGET, name: str = "p") -> DataFrame:
    """Score every row with the train positive rate (a scalar subquery)."""
    rate = train.agg(F.avg(F.col(target).cast("double"))).scalar()
    return scored.withColumn(name, rate)


# M2
def class_weights(train: DataFrame, target: str = TARGET) -> DataFrame:
    """Balanced weight n / (2 n_c) per class and the positive weight
    n_neg / n_pos (one row per class)."""
    counts = train.groupBy(target).agg(F.count(F.lit(1)).alias("n_c"))
    n = train.agg(F.count(F.lit(1))).scalar()
    n_pos = train.agg(F.count(F.when(F.col(target) == 1, 1))).scalar()
    n_neg = train.agg(F.count(F.when(F.col(target) == 0, 1))).scalar()
    return counts.select(target, "n_c", (n / (2 * F.col("n_c"))).alias("balanced_weight"),
                         F.try_divide(n_neg.cast("double"), n_pos.cast("double")).alias("pos_weight"))


def with_weights(train: DataFrame, target: str = TARGET, name: str = "weight") -> DataFrame:
    """Attach the balanced class weight to every training row. The weights
    (one row per class) are broadcast: by a shuffle, a class would be a task."""
    w = class_weights(train, target).select(target, F.col("balanced_weight").alias(name))
    return train.join(F.broadcast(w), target)


# M13
def blend_average(a: DataFrame, b: DataFrame, on: list[str], p: str = "p", name: str = "p") -> DataFrame:
    """Mean of two scores for the same rows."""
    j = a.select(*on, F.col(p).alias("_pa")).join(b.select(*on, F.col(p).alias("_pb")), on)
    return j.select(*on, ((F.col("_pa") + F.col("_pb")) / 2).alias(name))


# --- distributed estimators (M3–M16) ------------------------------------------
# LR C = 1; forest 400 trees, depth 12, leaf 5; the two grid
# searches; boosted folds 100 trees, step 0.1, depth 4, leaf 10; the network
# layers 64-32.
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,  # noqa: E402
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator  # noqa: E402
from pyspark.ml.feature import VectorAssembler  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder  # noqa: E402

from . import encoders as E  # noqa: E402
from .ordering import stratified_folds  # noqa: E402
from ..session import materialize  # noqa: E402

RF_GRID = {"numTrees": [200, 400], "maxDepth": [10, 20, 30], "minInstancesPerNode": [5, 10, 20]}
GBT_GRID = {"maxIter": [200, 400], "maxDepth": [3, 5, 7], "stepSize": [0.05, 0.1],
            "subsamplingRate": [0.8], "minInstancesPerNode": [10, 20]}


#: Features up to which logistic regression is fitted by Newton steps.
NEWTON_FEATURES = 512


class Logistic:
    """sklearn-style L2 logistic regression: C * sum(w * loss) + |b|^2 / 2
    equals Spark's objective with regParam = 1 / (C * sum(w)).

    Up to ``NEWTON_FEATURES`` features it takes Newton steps: a pass over the
    rows sums the gradient and the Gram matrix (p x p), a handful of passes
    end. Beyond that Spark's L-BFGS goes to the same minimum."""

    def __init__(self, features: str, weight: str | None, n_weight_sum: float | None, C: float, max_iter: int):
        self.features, self.weight, self.label, self.max_iter = features, weight, "label", max_iter
        self.reg = 1.0 / (C * n_weight_sum) if n_weight_sum else 0.0

    def setFeaturesCol(self, name: str) -> "Logistic":
        self.features = name
        return self

    def setLabelCol(self, name: str) -> "Logistic":
        self.label = name
        return self

    def fit(self, data: DataFrame):
        first = data.select(self.features).first()
        if first is not None and len(first[0]) <= NEWTON_FEATURES:
            return newton_logistic(data, self.features, self.label, self.weight, self.reg)
        lr = LogisticRegression(featuresCol=self.features, labelCol=self.label, regParam=self.reg, elasticNetParam=0.0,
                                standardization=False, maxIter=self.max_iter, tol=1e-6)
        if self.weight:
            lr.setWeightCol(self.weight)
        # A step shuffles a gradient for each partition: two a core, not more.
        cores = data.sparkSession.sparkContext.defaultParallelism
        return lr.fit(data.select(self.features, self.label, *([self.weight] if self.weight else [])).coalesce(2 * cores))


def logistic(features: str = "features", weight: str | None = "weight", n_weight_sum: float | None = None,
             C: float = 1.0, max_iter: int = 12000) -> Logistic:
    return Logistic(features, weight, n_weight_sum, C, max_iter)


def logistic_sums(data: DataFrame, beta, features: str, label: str, weight: str | None):
    """(gradient, Gram matrix, loss, sum of weights) of the weighted log loss
    at ``beta`` (coefficients, then the intercept): each task reduces its rows
    to one matrix, Spark adds the cells."""
    import numpy as np
    import pyarrow as pa

    p = len(beta)
    rows = data.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"),
                       (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))

    def run(batches):
        total, seen = np.zeros(p * p + p + 2), False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            x = np.ones((batch.num_rows, p))
            x[:, :-1] = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, p - 1)
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            z = x @ beta
            mu = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            total[:p * p] += (x.T @ (x * (w * mu * (1 - mu))[:, None])).ravel()
            total[p * p:-2] += x.T @ (w * (mu - y))
            total[-2:] += (w * (np.logaddexp(0, z) - y * z)).sum(), w.sum()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "value"])

    cells = rows.mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    total = np.zeros(p * p + p + 2)
    for r in cells.collect():  # p x p cells, whatever the rows
        total[r["cell"]] = r["value"]
    return total[p * p:-2], total[:p * p].reshape(p, p), total[-2], total[-1]


def logistic_gradient(data: DataFrame, beta: list[float], features: str, label: str, weight: str | None, reg: float) -> DataFrame:
    """Gradient of mean weighted log loss + reg / 2 |b|^2 at ``beta``
    (coefficients, then the free intercept), one row a ``position``."""
    x = F.concat(vector_to_array(features), F.array(F.lit(1.0)))
    w = (F.col(weight) if weight else F.lit(1.0)).cast("double")
    coef = F.array(*[F.lit(float(b)) for b in beta])
    z = F.aggregate(F.zip_with(F.col("_x"), coef, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    rows = data.select(x.alias("_x"), w.alias("_w"), F.col(label).cast("double").alias("_y"))
    rows = rows.select("_x", "_w", (F.col("_w") * (1 / (1 + F.exp(-z)) - F.col("_y"))).alias("_r"))
    sums = rows.select("_w", "_r", F.posexplode("_x").alias("position", "_v")).groupBy("position").agg(
        (F.sum(F.col("_r") * F.col("_v")) / F.sum("_w")).alias("mean"))
    free = F.col("position") == len(beta) - 1
    ridge = F.when(free, 0.0).otherwise(reg * F.element_at(coef, F.col("position") + 1))
    return sums.select(F.col("position").cast("long").alias("position"), (F.col("mean") + ridge).alias("gradient"))


def newton_logistic(data: DataFrame, features: str, label: str, weight: str | None, reg: float,
                    tol: float = 1e-12, max_steps: int = 50):
    """Newton steps on mean weighted log loss + reg / 2 |b|^2 (the intercept
    is free), halved while the loss rises. Ends when the gradient is below
    ``tol`` or steps no longer lower the loss."""
    import numpy as np

    p = len(data.select(features).first()[0]) + 1
    ridge = np.append(np.full(p - 1, reg), 0.0)
    beta = np.zeros(p)

    def at(b):
        g, h, loss, n = logistic_sums(data, b, features, label, weight)
        return g / n + ridge * b, h / n + np.diag(ridge), loss / n + (ridge * b * b).sum() / 2

    grad, hess, loss = at(beta)
    for _ in range(max_steps):
        if np.abs(grad).max() < tol:
            break
        # The least-norm step: without ridge, equal columns share it.
        step, size = np.linalg.lstsq(hess, grad, rcond=1e-14)[0], 1.0
        new = at(beta - step)
        while not new[2] <= loss + 1e-13 * abs(loss) and size > 1e-4:
            size /= 2
            new = at(beta - size * step)
        if not new[2] <= loss + 1e-13 * abs(loss) or np.abs(new[0]).max() >= np.abs(grad).max() and new[2] >= loss:
            break
        beta = beta - size * step
        grad, hess, loss = new
    spark = data.sparkSession
    values = spark.sparkContext._gateway.new_array(spark._jvm.double, p - 1)
    for i, v in enumerate(beta[:-1]):
        values[i] = float(v)
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"newton_{uuid.uuid4().hex[:12]}", spark._jvm.org.apache.spark.ml.linalg.Vectors.dense(values), float(beta[-1]))
    model = LogisticRegressionModel(java)
    model._resetUid(java.uid())
    return model.setFeaturesCol(features)


def prepare(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.withColumn("label", F.col(target).cast("double"))


# M15
def batch_score(model, df: DataFrame, name: str = "p", threshold: float | None = None) -> DataFrame:
    """Positive-class probability per row (and ``>=`` threshold prediction)."""
    out = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    if threshold is not None:
        out = out.withColumn("prediction", (F.col(name) >= F.lit(float(threshold))).cast("int"))
    return out.drop("rawPrediction", "probability")


def _scored(df: DataFrame, model_name: str, id_col: str = "order_id", target: str = TARGET) -> DataFrame:
    return df.select(F.lit(model_name).alias("model"), "split", F.col(id_col).alias("id"),
                     F.col(target).alias("y"), "p")


class Texts:
    """Vocabulary of a train split and term weights of its parts, made once
    for all models that read the same texts."""

    def __init__(self, train: DataFrame):
        self.train, self.lock, self.made = train, Lock(), {}

    def _once(self, key: str, make):
        with self.lock:
            if key not in self.made:
                self.made[key] = make()
            return self.made[key]

    def vocabulary(self) -> DataFrame:
        return self._once("vocabulary", lambda: materialize(E.fit_tfidf(self.train), "vocabulary"))

    def pairs(self, df: DataFrame, part: str) -> DataFrame:
        vocab = self.vocabulary()
        return self._once(part, lambda: materialize(E.tfidf_pairs(E.tfidf_weights(df, vocab)), "terms"))


class TabularModel:
    """Preprocessor (fit on train) + one Spark estimator. ``texts`` are those
    of the same train split, if other models read them too."""

    texts: Texts | None = None

    def __init__(self, name, numeric, categorical, estimator_fn, scale=True, categorical_mode="onehot",
                 weighted=True, text: bool = False, tabular: bool = True):
        self.name, self.numeric, self.categorical = name, numeric, categorical
        self.estimator_fn, self.scale, self.mode = estimator_fn, scale, categorical_mode
        self.weighted, self.text, self.tabular = weighted, text, tabular

    def _features(self, df: DataFrame, part: str = "held") -> DataFrame:
        # Texts are read where their terms are counted and moved nowhere else.
        out = prepare(df.drop("review_text"))
        if self.mode != "onehot" and not self.text:
            return VectorAssembler(inputCols=["features"], outputCol="all_features").transform(self.pre.transform(out))
        parts = []
        if self.tabular:
            out = self.pre.encode(out)
            parts.append(("features", self.pre.size))
        if self.text:
            weights = self.texts.pairs(df, part) if self.texts else E.tfidf_weights(df, self.vocab)
            out = E.tfidf_structs(out, weights, self.vocab_size)
            parts.append(("text_features", self.vocab_size))
        out = out.withColumn("all_features", E.joined_structs(parts)).drop(*[name for name, _ in parts])
        return E.with_vectors(out.hint("rebalance"), ["all_features"])

    def fit(self, train: DataFrame) -> "TabularModel":
        if self.tabular:
            self.pre = E.TabularPreprocessor(self.numeric, self.categorical, self.scale, self.mode).fit(train)
        if self.text:
            self.vocab = self.texts.vocabulary() if self.texts else materialize(E.fit_tfidf(train), "vocabulary")
            self.vocab_size = self.vocab.count()
        data = with_weights(train, TARGET, "weight") if self.weighted else train
        data = self._features(data, "train")
        if isinstance(self.estimator_fn(None), RandomForestClassifier):
            data = training_table(data, wide=True)
        self.n = data.count()  # of the written features
        self.model = self.estimator_fn(self.n).setFeaturesCol("all_features").fit(data)
        return self

    def score(self, df: DataFrame) -> DataFrame:
        return batch_score(self.model, self._features(df))


def review_score_lr():
    # M3
    return TabularModel("review_score_lr", ["review_score", "text_present"], [],
                        lambda n: logistic("all_features", "weight", n))


def tabular_lr():
    # M4
    return TabularModel("tabular_lr", E.BASELINE_NUMERIC, E.BASELINE_CATEGORICAL,
                        lambda n: logistic("all_features", "weight", n))


def tabular_rf(num_trees=400, max_depth=12, min_leaf=5, seed=42):
    # M5
    return TabularModel("tabular_rf", E.BASELINE_NUMERIC, E.BASELINE_CATEGORICAL,
                        lambda n: RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=num_trees,
                                                         maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                                         featureSubsetStrategy="sqrt", seed=seed,
                                                         maxMemoryInMB=1024, cacheNodeIds=True),
                        scale=False, categorical_mode="ordinal")


def text_lr():
    # M6
    return TabularModel("text_tfidf_lr", [], [], lambda n: logistic("all_features", "weight", n),
                        text=True, tabular=False)


def combined_lr():
    # M7
    return TabularModel("combined_tfidf_lr", E.BASELINE_NUMERIC, E.BASELINE_CATEGORICAL,
                        lambda n: logistic("all_features", "weight", n), text=True)


def training_table(df: DataFrame, wide: bool = False) -> DataFrame:
    """The feature rows written once for an iterative learner, in even
    partitions that AQE sizes by bytes (``spark.sql.adaptive.
    advisoryPartitionSizeInBytes``); nothing caps their number. A forest does
    much work per pass (``wide=True``): at least one partition per core."""
    data = materialize(df.hint("rebalance"), "training")
    cores = df.sparkSession.sparkContext.defaultParallelism
    return data.repartition(cores) if wide and data.rdd.getNumPartitions() < cores else data


# M8 / M9
def grid_search(train: DataFrame, estimator, grid: dict, features: str = "all_features", folds: int = 3,
                seed: int = 42, parallelism: int = 4):
    """Exhaustive grid with stratified folds (D4) and ROC AUC; refit on all
    training rows. Returns (best model, frame of mean AUC per combination).
    Forests that differ in ``maxDepth`` only are grown once."""
    b = ParamGridBuilder()
    for k, vals in grid.items():
        b = b.addGrid(estimator.getParam(k), vals)
    maps = b.build()
    data = training_table(stratified_folds(train, "label", folds, seed, "order_id", name="fold"))
    evaluator = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    spark = train.sparkSession
    if isinstance(estimator, RandomForestClassifier) and len(grid.get("maxDepth", [])) > 1:
        means = depth_staged_means(data, estimator, maps, evaluator, folds, features)
        best = estimator.fit(data, maps[max(range(len(maps)), key=means.__getitem__)])
    else:
        cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, numFolds=folds, foldCol="fold",
                            evaluator=evaluator, parallelism=parallelism, seed=seed)
        cvm = cv.fit(data)
        best, means = cvm.bestModel, cvm.avgMetrics
    rows = [tuple([str({p.name: v for p, v in m.items()}), float(s)]) for m, s in zip(maps, means)]
    return best, spark.createDataFrame(rows, "params string, mean_roc_auc double")


def depth_staged_means(data: DataFrame, estimator, maps: list, evaluator, folds: int, features: str) -> list[float]:
    """Mean metric of each parameter map over the folds. A forest grows level
    by level from one seed, so the forest of a smaller ``maxDepth`` is the
    deepest one cut there (a test shows equal votes; where a level has more
    nodes than ``maxMemoryInMB`` takes at once the order of its random draws
    differs): maps that differ in depth only are one fit a fold, and the held
    rows go down it once. Each depth has its own evaluation."""
    from . import trees as N

    depth = estimator.getParam("maxDepth")
    groups: dict = {}
    for i, m in enumerate(maps):
        groups.setdefault(tuple((p.name, v) for p, v in m.items() if p != depth), []).append(i)
    parts = [(data.where(F.col("fold") != f).cache(), data.where(F.col("fold") == f).cache()) for f in range(folds)]

    def score(job):
        members, (rows, held) = job
        depths = [maps[i][depth] for i in members]
        model = estimator.fit(rows, max((maps[i] for i in members), key=lambda m: m[depth]))
        raw = materialize(N.cut_scores(held, N.forest_arrays(model), vector_to_array(features), depths), "raw")
        return [(i, evaluator.evaluate(raw.select("label", F.get("raw", F.lit(at)).alias("rawPrediction")))) for at, i in enumerate(members)]

    # A fit over few rows is a chain of one-task jobs: as many as cores side by
    # side. Large forests start first, next to small ones of another fold.
    jobs = [(members, parts[f]) for members in groups.values() for f in range(folds)]
    jobs.sort(key=lambda j: -maps[j[0][0]].get(estimator.getParam("numTrees"), estimator.getNumTrees()))
    with ThreadPool(min(len(jobs), data.sparkSession.sparkContext.defaultParallelism, 8)) as pool:
        found = [x for part in pool.map(score, jobs, chunksize=1) for x in part]
    for part in parts:
        for rows in part:
            rows.unpersist()
    return [sum(v for j, v in found if j == i) / folds for i in range(len(maps))]


def first_rounds(model, n: int):
    """The boosted model of the first ``n`` rounds: a fit of ``n`` rounds with
    the same seed has the same trees."""
    from pyspark import SparkContext
    sc, java = SparkContext._active_spark_context, model._java_obj
    ml, trees, weights = sc._jvm.org.apache.spark.ml, java.trees(), java.treeWeights()
    n = min(n, len(trees))
    some = sc._gateway.new_array(ml.regression.DecisionTreeRegressionModel, n)
    steps = sc._gateway.new_array(sc._jvm.double, n)
    for i in range(n):
        some[i], steps[i] = trees[i], float(weights[i])
    out = GBTClassificationModel(ml.classification.GBTClassificationModel(f"{model.uid}_{n}", some, steps))
    return out.setFeaturesCol(model.getFeaturesCol())


def staged_grid_search(train: DataFrame, grid: dict, features: str = "all_features", folds: int = 3, seed: int = 42,
                       parallelism: int = 8):
    """``grid_search`` for boosted trees: combinations that differ in
    ``maxIter`` only are one fit of the most rounds for each fold, and their
    scores are those of its first rounds. Returns (best model, frame of mean
    AUC per combination)."""
    from itertools import product

    rounds = sorted(grid["maxIter"])
    names = [k for k in grid if k != "maxIter"]
    combos = [dict(zip(names, v)) for v in product(*[grid[k] for k in names])]
    data = training_table(stratified_folds(train, "label", folds, seed, "order_id", name="fold")).select("label", "weight", "fold", features)
    auc = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")

    def fit(params, rows, n):
        est = GBTClassifier(labelCol="label", weightCol="weight", seed=seed, featuresCol=features, maxIter=n, cacheNodeIds=True)
        return est.setParams(**params).fit(rows)

    def score(job):
        params, fold = job
        model = fit(params, data.where(F.col("fold") != fold), rounds[-1])
        held = data.where(F.col("fold") == fold)
        return [(params, n, auc.evaluate(first_rounds(model, n).transform(held))) for n in rounds]

    with ThreadPool(parallelism) as pool:
        found = pool.map(score, [(c, f) for c in combos for f in range(folds)], chunksize=1)
    mean = {}
    for params, n, value in (x for part in found for x in part):
        mean.setdefault(str({"maxIter": n, **params}), (params, n, []))[2].append(value)
    rows = [(k, float(sum(v) / len(v))) for k, (_, _, v) in mean.items()]
    best, n, _ = mean[max(rows, key=lambda r: r[1])[0]]
    return fit(best, data, n), train.sparkSession.createDataFrame(rows, "params string, mean_roc_auc double")


def rf_estimator():
    return RandomForestClassifier(labelCol="label", weightCol="weight", featureSubsetStrategy="sqrt",
                                  seed=42, featuresCol="all_features", maxMemoryInMB=1024, cacheNodeIds=True)


def gbt_estimator():
    return GBTClassifier(labelCol="label", weightCol="weight", seed=42, featuresCol="all_features")


def pos_weighted(train: DataFrame, target: str = TARGET, name: str = "weight") -> DataFrame:
    """Weight n_neg / n_pos on positives, 1 on negatives."""
    cw = class_weights(train, target).select("pos_weight").limit(1)
    pw = cw.agg(F.first("pos_weight")).scalar()
    return train.withColumn(name, F.when(F.col(target) == 1, pw).otherwise(F.lit(1.0)))


# M10
def boosted_oof(train: DataFrame, others: DataFrame, features: str = "all_features", k: int = 5, seed: int = 42,
                max_iter: int = 100, step: float = 0.1, depth: int = 4, min_leaf: int = 10):
    """k-fold out-of-fold scores for train rows, fold-averaged scores for
    ``others``. Returns (train with 'oof', others with 'oof')."""
    # fold ids are a global rank: write them once instead of once per fold
    folds = stratified_folds(pos_weighted(train).select("order_id", "label", "weight", features), "label", k, seed, "order_id", name="fold")
    data = training_table(folds)
    rounds = GBTClassifier(labelCol="label", featuresCol=features, weightCol="weight", maxIter=max_iter, stepSize=step, maxDepth=depth,
                           minInstancesPerNode=min_leaf, seed=seed)
    # A round is a few short jobs, one after another: the folds run side by side.
    with ThreadPool(k) as pool:
        fitted = pool.map(lambda f: rounds.copy().fit(data.filter(F.col("fold") != f)), range(k))
    oof_parts = [batch_score(m, data.filter(F.col("fold") == f), "oof").select("order_id", "oof") for f, m in enumerate(fitted)]
    avg_parts = [batch_score(m, others, "oof").select("order_id", "oof") for m in fitted]
    oof = reduce(lambda a, b: a.unionByName(b), oof_parts)
    avg = reduce(lambda a, b: a.unionByName(b), avg_parts).groupBy("order_id").agg(F.avg("oof").alias("oof"))
    return materialize(train.join(oof, "order_id"), "oof"), materialize(others.join(avg, "order_id"), "oof")


# M11
def guided_features(df: DataFrame, features: str = "all_features", extra: str = "oof",
                    out: str = "guided_features") -> DataFrame:
    return VectorAssembler(inputCols=[features, extra], outputCol=out).transform(df)


# M12
def stacked_meta(fit_on: DataFrame, p1: str, p2: str, label: str = "label"):
    """LR (C=1, unweighted) on [p1, p2, p1*p2, |p1-p2|]; returns a scoring
    function."""
    def feats(df):
        d = df.withColumns({"_x1": F.col(p1) * F.col(p2), "_x2": F.abs(F.col(p1) - F.col(p2))})
        return VectorAssembler(inputCols=[p1, p2, "_x1", "_x2"], outputCol="_meta").transform(d)
    n = fit_on.count()
    m = logistic("_meta", None, n).setLabelCol(label).fit(feats(fit_on))
    return lambda df: batch_score(m, feats(df)).drop("_x1", "_x2", "_meta")


# M14
def mlp_classifier(train: DataFrame, features: str = "all_features", layers=(64, 32), max_iter: int = 200,
                   seed: int = 42):
    """Multilayer network; class balance by replicating each positive
    round(n_neg / n_pos) times (the estimator has no weight column)."""
    pw = class_weights(train, "label").agg(F.first("pos_weight")).scalar()
    rep = F.when(F.col("label") == 1, F.greatest(F.round(pw).cast("int"), F.lit(1))).otherwise(F.lit(1))
    data = training_table(train.withColumn("_rep", F.explode(F.sequence(F.lit(1), rep))).drop("_rep"))
    d = len(train.select(features).first()[0])
    mlp = MultilayerPerceptronClassifier(featuresCol=features, labelCol="label", layers=[d, *layers, 2],
                                         maxIter=max_iter, seed=seed)
    return mlp.fit(data)


LADDER_MODELS = [review_score_lr, tabular_lr, tabular_rf, text_lr, combined_lr]


# M16
def model_ladder(splits: DataFrame, models=None, store: str | None = None) -> DataFrame:
    """Fit the dummy prior and each model on train, score val and test,
    choose each model's threshold on val, and return the metric rows. The
    models read the same texts, whose terms are counted once; the forest
    grows while the linear models take their many short steps."""
    from .metrics import best_threshold, compute_metrics
    from .quality import union_metrics
    train = splits.filter(F.col("split") == "train")
    held = splits.filter(F.col("split") != "train")
    texts = Texts(train)

    def score(mk):
        tm = mk()
        tm.texts = texts
        tm.fit(train)
        if store:
            from ..sources.io import save_model
            save_model(tm.model, f"{store}/{tm.name}")
        # Written here: a model's scoring overlaps the other's fit.
        return materialize(_scored(tm.score(held), tm.name), "scored")

    with ThreadPool(2) as pool:
        scored = pool.map(score, sorted(models or LADDER_MODELS, key=lambda mk: mk is not tabular_rf), chunksize=1)
    s = materialize(union_metrics(_scored(dummy_prior(train, held, TARGET, "p"), "dummy_prior"), *scored))
    thr = best_threshold(s.filter(F.col("split") == "val"), ["model"])
    return compute_metrics(s, ["model", "split"], threshold=thr)
