"""Tree models as tables: one row a node, and scorers that read it.

A forest's or boosted ensemble's node table has ``tree``, ``node`` (0 is the
root), ``feature``, ``threshold`` (at most it: left), ``left``, ``right`` (-1
in a leaf), ``value`` (a leaf's probability of class 1, or a regression
tree's prediction), ``rows`` (training weight or count) and ``weight`` of the
tree. Categorical splits do not occur: features are ordered numbers.
"""

from __future__ import annotations

import sys
import uuid
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

# The scorers run in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _stored(model) -> str:
    """Path of the model's stored form."""
    spark = SparkSession.active()
    path = shared_path(spark, f"{spark.sparkContext.applicationId}/model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    return path


def node_table(model) -> DataFrame:
    """Node table of a fitted tree ensemble, by way of its stored form."""
    spark, path = SparkSession.active(), _stored(model)
    data = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    stats = F.col("impurityStats")
    # A classification node has the weight of each class, a regression node
    # count, sum and sum of squares; only the latter's prediction is a value.
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    classes = model.numClasses == 2 and type(model).__name__ == "RandomForestClassificationModel"
    value = F.when(total > 0, F.element_at(stats, 2) / total).otherwise(0.0) if classes else F.col("prediction")
    nodes = data.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"), value.alias("value"), (total if classes else F.element_at(stats, 1)).alias("rows"))
    return nodes.join(weights, "tree")


def margin(nodes: list, features: list[Column]) -> Column:
    """Weighted sum of the trees as one expression, for small ensembles only
    (the nodes are literals in the plan). ``nodes``: collected node table."""
    trees: dict = {}
    for r in nodes:
        trees.setdefault(r["tree"], {})[r["node"]] = r

    def below(tree: dict, at: int) -> Column:
        r = tree[at]
        if r["left"] < 0:
            return F.lit(float(r["value"]))
        return F.when(features[r["feature"]] <= F.lit(float(r["threshold"])), below(tree, r["left"])).otherwise(below(tree, r["right"]))

    return reduce(lambda a, b: a + b, [F.lit(float(t[0]["weight"])) * below(t, 0) for _, t in sorted(trees.items())])


def packed(nodes: DataFrame) -> DataFrame:
    """One row a tree: its nodes as arrays in node order."""
    fields = ("feature", "threshold", "left", "right", "value")
    by_node = F.sort_array(F.collect_list(F.struct("node", *fields)))
    return nodes.groupBy("tree").agg(F.first("weight").alias("weight"), by_node.alias("n")).select(
        "tree", "weight", *[F.col(f"n.{f}").alias(f"_{f}") for f in fields])


def tree_scores(df: DataFrame, nodes: DataFrame, x: Column, id_col: str, boosted: bool = False, depth: int = 30,
                name: str = "p") -> DataFrame:
    """``id_col`` and the ensemble's probability from its node table: each row
    meets each tree and goes down at most ``depth`` levels. ``x``: array of
    the row's features. Averages leaf values (forest), or takes the logistic
    function of twice their weighted sum (``boosted``)."""
    trees = packed(nodes)  # a row a tree, in arrays: never larger than the model
    rows = df.select(F.col(id_col), x.alias("_x")).crossJoin(trees)
    at = lambda field, node: F.element_at(F.col(field), node + 1)
    step = lambda node, _: F.when(at("_left", node) < 0, node).when(
        F.element_at(F.col("_x"), at("_feature", node) + 1) <= at("_threshold", node), at("_left", node)).otherwise(at("_right", node))
    leaf = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)
    value = rows.select(id_col, "weight", F.element_at(F.col("_value"), leaf + 1).alias("_v"))
    score = 1 / (1 + F.exp(-2 * F.sum(F.col("weight") * F.col("_v")))) if boosted else F.avg("_v")
    return value.groupBy(id_col).agg(score.alias(name))


def linear_scores(df: DataFrame, coefficients: DataFrame, intercept: float, x: Column, id_col: str, name: str = "p") -> DataFrame:
    """``id_col`` and the logistic probability from a coefficient table
    (``position``, ``coefficient``); ``x``: array of the row's features."""
    coef = coefficients.agg(F.sort_array(F.collect_list(F.struct("position", "coefficient"))).alias("c")).select(F.col("c.coefficient").alias("_c"))
    z = F.aggregate(F.zip_with("_x", "_c", lambda a, b: a * b), F.lit(float(intercept)), lambda a, b: a + b)
    return df.select(F.col(id_col), x.alias("_x")).crossJoin(coef).select(id_col, (1 / (1 + F.exp(-z))).alias(name))


def tree_partial_dependence(nodes: DataFrame, feature: int, grid: list[float]) -> DataFrame:
    """Mean value of a forest at each grid value of a feature, by weighted
    recursion: a node that splits on the feature passes its weight to the
    value's side, any other to both by their training rows. A pass over the
    node table, whatever the data."""
    import pandas as pd

    values = np.array(grid, float)

    def run(tree: pd.DataFrame) -> pd.DataFrame:
        rows = {r.node: r for r in tree.itertuples()}
        total, open_nodes = np.zeros(len(values)), [(0, np.ones(len(values)))]
        while open_nodes:
            node, weight = open_nodes.pop()
            r = rows[node]
            if r.left < 0:
                total += weight * r.value
            else:
                share = values <= r.threshold if r.feature == feature else rows[r.left].rows / (rows[r.left].rows + rows[r.right].rows)
                open_nodes += [(r.left, weight * share), (r.right, weight * (1 - share))]
        return pd.DataFrame({"grid_value": values, "value": total})

    fields = ("tree", "node", "feature", "threshold", "left", "right", "value", "rows")
    each = nodes.select(*fields).groupBy("tree").applyInPandas(run, "grid_value double, value double")
    return each.groupBy("grid_value").agg(F.avg("value").alias("mean_probability"))


class Forest(NamedTuple):
    """A forest of two classes as flat arrays, tree after tree, a place a
    node; it is no larger than the model. A leaf leads to itself, so a row
    that has arrived stays. ``votes``: the share of each class in a node."""
    roots: np.ndarray
    levels: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    prediction: np.ndarray
    votes: np.ndarray


def forest_arrays(model) -> Forest:
    """The arrays of a fitted ``RandomForestClassificationModel``."""
    spark = SparkSession.active()
    n = F.col("nodeData")
    threshold = F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0))
    t = spark.read.parquet(f"{_stored(model)}/data").select(
        "treeID", n["id"].alias("id"), n["split"]["featureIndex"].alias("feature"), threshold.alias("threshold"), n["leftChild"].alias("left"),
        n["rightChild"].alias("right"), n["prediction"].alias("prediction"), *[F.get("nodeData.impurityStats", F.lit(c)).alias(f"w{c}") for c in (0, 1)]).toArrow()
    c = {name: t[name].to_numpy() for name in t.column_names}
    order = np.lexsort((c["id"], c["treeID"]))
    c = {name: v[order] for name, v in c.items()}
    roots = np.flatnonzero(c["id"] == 0)
    first = np.repeat(roots, np.diff(np.append(roots, len(order))))
    own, leaf = np.arange(len(order)), c["left"] < 0
    left, right = (np.where(leaf, own, first + c[side]).astype(np.int32) for side in ("left", "right"))
    depth, at, d = np.zeros(len(order), np.int16), roots, 0
    while len(at := at[~leaf[at]]):
        d += 1
        at = np.concatenate([left[at], right[at]])
        depth[at] = d
    total = c["w0"] + c["w1"]
    votes = np.stack([np.divide(c[w], total, out=np.zeros(len(order)), where=total != 0) for w in ("w0", "w1")])
    return Forest(roots, np.maximum.reduceat(depth, roots), np.where(leaf, 0, c["feature"]).astype(np.int32), np.where(leaf, np.inf, c["threshold"]),
                  left, right, depth, c["prediction"], votes)


def leaf_places(f: Forest, tree: int, x: np.ndarray) -> np.ndarray:
    """Place of the leaf of each row of ``x`` (rows by features) in a tree."""
    flat, rows = x.ravel(), np.arange(len(x)) * x.shape[1]
    at = np.full(len(x), f.roots[tree])
    for _ in range(f.levels[tree]):
        at = np.where(flat[rows + f.feature[at]] <= f.threshold[at], f.left[at], f.right[at])
    return at


def cut_places(f: Forest, depth: int) -> np.ndarray:
    """For each node the place where its rows end in the same trees grown to
    ``depth`` only. As in a fit, leaves of one parent that predict the same
    class are one leaf."""
    own = np.arange(len(f.depth))
    ends = (f.left == own) | (f.depth >= depth)
    for d in range(depth - 1, -1, -1):
        at = np.flatnonzero((f.depth == d) & (f.left != own))
        a, b = f.left[at], f.right[at]
        ends[at] = ends[a] & ends[b] & (f.prediction[a] == f.prediction[b])
    place = own.copy()
    for d in range(int(f.depth.max(initial=0))):
        at = np.flatnonzero((f.depth == d) & (f.left != own))
        at = at[ends[at] | (place[at] != at)]
        place[f.left[at]] = place[f.right[at]] = place[at]
    return place


def _matrix(column, width: int) -> np.ndarray:
    """A list column of ``width`` doubles a row; NULL is NaN, as in a vector."""
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width))


def cut_scores(df: DataFrame, f: Forest, x: Column, depths: list[int]) -> DataFrame:
    """The votes for class 1 of each row from the forest grown to each of
    ``depths``: columns ``label`` and ``raw``, an array. The rows go down once."""
    import pyarrow as pa

    spark = df.sparkSession
    sent = spark.sparkContext.broadcast((tuple(f), [cut_places(f, d) for d in depths]))

    def run(batches):
        f, places = Forest(*sent.value[0]), sent.value[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(1)
            xs = _matrix(rows, len(rows[0]))
            raw = np.zeros((len(xs), len(places)))
            for tree in range(len(f.roots)):
                at = leaf_places(f, tree, xs)
                for i, place in enumerate(places):
                    raw[:, i] += f.votes[1][place[at]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(raw.ravel(), len(places)).cast(pa.list_(pa.float64()))], ["label", "raw"])

    return df.select(F.col("label").cast("double").alias("label"), x.alias("_x")).mapInArrow(run, "label double, raw array<double>")


def donor_scores(f: Forest, x: np.ndarray, donors: np.ndarray) -> np.ndarray:
    """Probability of class 1 with one feature at a time taken from a donor:
    ``x`` rows by features, ``donors`` rows by donors by features; result
    (features * donors) by rows, a feature's donors side by side. A tree
    votes as for the row itself unless the donor's value turns a decision on
    the row's path; from the first such node on the row goes down anew. Votes
    add up in the order of the trees, so scores are equal to those of a copy."""
    n, k = x.shape
    m = donors.shape[1]
    flat, given, start = x.ravel(), donors.ravel(), np.arange(n) * k
    sums = [np.zeros((k * m, n)) for _ in (0, 1)]
    for tree in range(len(f.roots)):
        at, found = np.full(n, f.roots[tree]), []
        turned = np.zeros((m, n), np.int64 if k < 63 else object)  # a bit a feature
        for _ in range(f.levels[tree]):
            j, limit, left, right = f.feature[at], f.threshold[at], f.left[at], f.right[at]
            goes = flat[start + j] <= limit
            bit = np.left_shift(1, j.astype(np.int64)) if k < 63 else np.array([1 << int(i) for i in j], object)
            for r in range(m):
                value = given[start * m + r * k + j]
                new = np.flatnonzero(((value <= limit) != goes) & ((turned[r] & bit) == 0) & (left != right))
                if len(new):
                    turned[r][new] |= bit[new]
                    found.append((new, j[new], np.full(len(new), r), value[new], np.where(goes, right, left)[new]))
            at = np.where(goes, left, right)
        if found:
            row, j, r, value, node = (np.concatenate(v) for v in zip(*found))
            slot, end = j * m + r, np.empty(len(row), np.int64)
            open_, here = np.arange(len(row)), node
            while len(open_):
                own = start[row[open_]]
                g = f.feature[here]
                v = np.where(g == j[open_], value[open_], flat[own + g])
                to = np.where(v <= f.threshold[here], f.left[here], f.right[here])
                done = f.left[here] == here
                end[open_[done]] = here[done]
                open_, here = open_[~done], to[~done]
        for s, votes in zip(sums, f.votes):
            if found:
                changed = s[slot, row] + votes[end]
            s += votes[at]
            if found:
                s[slot, row] = changed
    return sums[1] / (sums[0] + sums[1])


def with_donor_scores(df: DataFrame, f: Forest, y: Column, x: Column, donors: Column, n_features: int, n_donors: int) -> DataFrame:
    """``donor_scores`` of each row: ``y`` and ``scores``, an array. ``x`` is
    an array of features, ``donors`` one of the donors' features, donor after
    donor."""
    import pyarrow as pa

    sent = df.sparkSession.sparkContext.broadcast(tuple(f))

    def run(batches):
        f = Forest(*sent.value)
        for batch in batches:
            if batch.num_rows:
                p = donor_scores(f, _matrix(batch.column(1), n_features),
                                 _matrix(batch.column(2), n_donors * n_features).reshape(-1, n_donors, n_features))
                p = pa.FixedSizeListArray.from_arrays(np.ascontiguousarray(p.T).ravel(), len(p)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), p], ["y", "scores"])

    return df.select(y.cast("double").alias("y"), x.alias("_x"), donors.alias("_d")).mapInArrow(run, "y double, scores array<double>")


def _grid_sums(f: Forest, x: np.ndarray, feature: int, grid: np.ndarray) -> np.ndarray:
    """Sum over rows and trees of the votes for class 1 at each grid value
    (ascending) of ``feature``. A row goes both ways where a tree splits on
    the feature, with the part of the grid that goes that way."""
    n = len(grid)
    cut = np.searchsorted(grid, f.threshold, side="right")  # so many values go left
    flat, start, steps = x.ravel(), np.arange(len(x)) * x.shape[1], np.zeros(n + 1)
    for root in f.roots:
        rows, at = np.arange(len(x)), np.full(len(x), root)
        low, high = np.zeros(len(x), np.int64), np.full(len(x), n, np.int64)
        while len(rows):
            left, right = f.left[at], f.right[at]
            done = left == right
            if done.any():
                value = f.votes[1][at[done]]
                steps += np.bincount(low[done], value, n + 1) - np.bincount(high[done], value, n + 1)
                rows, at, low, high, left, right = (v[~done] for v in (rows, at, low, high, left, right))
            j, c = f.feature[at], cut[at]
            free = j == feature
            goes = flat[start[rows] + j] <= f.threshold[at]
            to_left, to_right = np.where(free, low < c, goes), np.where(free, high > c, ~goes)
            at = np.concatenate([left[to_left], right[to_right]])
            high, low = (np.concatenate([np.where(free, np.minimum(high, c), high)[to_left], high[to_right]]),
                         np.concatenate([low[to_left], np.where(free, np.maximum(low, c), low)[to_right]]))
            rows = np.concatenate([rows[to_left], rows[to_right]])
    return np.cumsum(steps[:n])


def forest_dependence(df: DataFrame, f: Forest, x: Column, feature: int, grid: list[float]) -> DataFrame:
    """Mean probability of the rows with a feature set to each grid value:
    what scored copies of the rows give, in one pass over the rows. ``x``:
    array of the row's features."""
    import pyarrow as pa

    sent = df.sparkSession.sparkContext.broadcast((tuple(f), np.array(sorted(grid), float)))

    def run(batches):
        f, values = Forest(*sent.value[0]), sent.value[1]
        sums, n = np.zeros(len(values)), 0
        for batch in batches:
            if batch.num_rows:
                xs = batch.column(0)
                sums, n = sums + _grid_sums(f, _matrix(xs, len(xs[0])), feature, values), n + batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(sums), pa.array(np.full(len(values), n))], ["grid_value", "votes", "n"])

    parts = df.select(x.alias("_x")).mapInArrow(run, "grid_value double, votes double, n long")
    return parts.groupBy("grid_value").agg((F.sum("votes") / (F.sum("n") * len(f.roots))).alias("mean_probability"))
