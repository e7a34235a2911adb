"""Exact top-k search as a Voronoi kNN join for integer inner products.

Vectors are grouped by their nearest pivot. A summary has each group's size,
radius and smallest distances to the pivot. For a query group and a data group
the summaries bound every inner product from both sides: with pivots ``p`` and
``c``, query radius ``a`` and data distance ``d``,
``<p,c> - a|c| - d(|p| + a) <= <q,x> <= <p,c> + a|c| + d(|p| + a)``.
The k-th best lower bound is what a query group finds at least; a data group
whose upper bound stays below it is never copied to that query group. The
rest are copied in blocks of bounded size, solved locally, and the blocks'
best are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: Rows of a local block of queries and of data.
QUERY_BLOCK, DATA_BLOCK = 1024, 8192
_MAX = 2 ** 63 - 1


def scaled(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id`` and ``vec``: components as floor(scale * x), packed as doubles.

    Rows with a null id, a null or empty vector, or a null or non-finite
    component take no part; rows equal in id and vector count once.
    """
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("id is not null and v is not null and size(v) > 0").where(~bad).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(1)
            at, flat = col.offsets.to_numpy(), np.floor(scale * col.values.to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([flat[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())], ["id", "vec"])

    return rows.mapInArrow(run, "id long, vec binary")


def _matrix(packed) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where those are exact, else in
    Python integers held within 64 bits."""
    top = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    if top < 2.0 ** 52:
        return (q @ x.T).astype(np.int64)
    to = np.vectorize(int, otypes=[object])
    return np.clip(to(q).dot(to(x).T), -_MAX - 1, _MAX).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each row's ``k`` highest scores among ids that aren't its own, ties to
    the smaller id."""
    out = []
    for s, i in zip(scores, own):
        may = np.flatnonzero(ids != i)
        v = s[may]
        if len(v) > k:
            cut = np.partition(v, len(v) - k)[len(v) - k]
            more = np.flatnonzero(v > cut)
            ties = np.flatnonzero(v == cut)
            ties = ties[np.argsort(ids[may[ties]], kind="stable")[:k - len(more)]]
            may = may[np.concatenate([more, ties])]
        out.append((ids[may], s[may]))
    return out


def _assign(rows: DataFrame, points: np.ndarray) -> DataFrame:
    """Adds ``cell`` (nearest pivot of the same dimension) and ``dist``."""

    def run(batches):
        norms = (points ** 2).sum(axis=1)
        for batch in batches:
            packed = batch.column(1).to_pylist()
            cell, dist = np.zeros(len(packed), np.int32), np.zeros(len(packed))
            for at in range(0, len(packed), 4096):
                x = _matrix(packed[at:at + 4096])
                near = norms[None, :] - 2 * (x @ points.T)
                c = near.argmin(axis=1)
                cell[at:at + len(x)], dist[at:at + len(x)] = c, np.sqrt(((x - points[c]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell), pa.array(dist)], ["id", "vec", "cell", "dist"])

    return rows.mapInArrow(run, "id long, vec binary, cell int, dist double")


def _partial(placed: DataFrame, k: int) -> DataFrame:
    """Each task's rows, radius and ``k`` smallest distances of a cell."""

    def run(batches):
        seen: dict[int, list] = {}
        for batch in batches:
            cells, dists = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for c in np.unique(cells):
                d = dists[cells == c]
                n, radius, near = seen.get(c, (0, 0.0, np.zeros(0)))
                seen[c] = n + len(d), max(radius, d.max()), np.sort(np.append(near, d))[:k]
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.int32()), pa.array([x[0] for x in seen.values()], pa.int64()),
                 pa.array([float(x[1]) for x in seen.values()]), pa.array([x[2].tolist() for x in seen.values()], pa.list_(pa.float64()))],
                ["cell", "n", "radius", "near"])

    return placed.select("cell", "dist").mapInArrow(run, "cell int, n long, radius double, near array<double>")


def needed(points: np.ndarray, queries: list, data: list, k: int) -> list[tuple[int, int]]:
    """Pairs of query cell and data cell that may hold one of the ``k`` best.
    ``queries``: (cell, radius); ``data``: (cell, rows, radius, k + 1 smallest distances)."""
    norm = np.sqrt((points ** 2).sum(axis=1))
    out = []
    for i, a in queries:
        lower = []
        for j, _, _, near in data:
            base = points[i] @ points[j] - a * norm[j]
            lower += [base - d * (norm[i] + a) for d in near]
        lower = sorted(lower, reverse=True)
        # One of the rows may be the query itself: k + 1 are sure to hold k others.
        least = lower[k] if len(lower) > k else -math.inf
        slack = 1e-6 * (1 + abs(least)) if math.isfinite(least) else 0
        out += [(i, j) for j, _, radius, _ in data
                if points[i] @ points[j] + a * norm[j] + radius * (norm[i] + a) >= least - slack]
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vec_col: str = "embedding", n_pivots: int = 16) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k``
    rows with the highest integer inner product for each query row.

    ``is_query`` is a condition on ``id``. A query's own id is no candidate.
    Only vectors of a query's dimension are its candidates; fewer than ``k``
    are all returned. See ``scaled`` for rows that take no part. Pivots
    (``n_pivots`` a dimension, the bound of what reaches the driver together
    with their summaries) are the rows with the smallest hash.
    """
    spark = vectors.sparkSession
    rows = written(scaled(vectors, id_col, vec_col, scale), "vectors")
    out = []
    for d in [r["d"] for r in rows.select((F.length("vec") / 8).cast("int").alias("d")).distinct().collect()]:
        out.append(_search(rows.where(F.length("vec") == 8 * d), is_query, k, n_pivots, d))
    schema = "query_id long, rank int, vec_id long, score long"
    found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for x in out:
        found = found.unionByName(x)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        *[x.split(" ")[0] for x in schema.split(", ")])


def _search(rows: DataFrame, is_query: Column, k: int, n_pivots: int, d: int) -> DataFrame:
    spark = rows.sparkSession
    # Distinct vectors only: a vector that many rows share is one pivot.
    points = (rows.select("vec", F.xxhash64("vec").alias("h")).distinct().orderBy("h", "vec").limit(n_pivots).collect())
    points = _matrix([bytes(r["vec"]) for r in points])
    placed = written(_assign(rows, points), "placed")
    queries = placed.where(is_query)
    parts = _partial(placed, k + 1).groupBy("cell").agg(
        F.sum("n").alias("n"), F.max("radius").alias("radius"),
        F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"))
    summary = [(r["cell"], r["n"], r["radius"], r["near"]) for r in parts.collect()]
    groups = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius")).collect()
    pairs = needed(points, [(r["cell"], r["radius"]) for r in groups], summary, k)
    empty = spark.createDataFrame([], "query_id long, vec_id long, score long")
    if not pairs:
        return empty
    # A query cell has as many query blocks, a data cell as many data blocks
    # as its size asks for; a pair of blocks is solved on its own.
    q_blocks = {r["cell"]: math.ceil(r["n"] / QUERY_BLOCK) for r in groups}
    d_blocks = {c: math.ceil(n / DATA_BLOCK) for c, n, _, _ in summary}
    to_data: dict[int, list] = {}
    to_query: dict[int, list] = {}
    for i, j in pairs:
        to_data.setdefault(j, []).append(i)
        to_query.setdefault(i, []).append(j)

    def blocks(frame: DataFrame, own: dict[int, int], targets: dict[int, list], flip: bool, other: dict[int, int]) -> DataFrame:
        """Rows copied to each block pair that needs them."""
        lists = [(c, own[c], [(t, b) for t in ts for b in range(other[t])]) for c, ts in targets.items()]
        table = spark.createDataFrame(lists, "cell int, blocks int, to array<struct<c:int,b:int>>")
        mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        x = frame.join(F.broadcast(table), "cell").select("id", "vec", "cell", mine.alias("block"), F.explode("to").alias("t"))
        names = ("qc", "qb", "dc", "db")
        cols = ["t.c", "t.b", "cell", "block"] if flip else ["cell", "block", "t.c", "t.b"]
        return x.select(*[F.col(c).alias(n) for c, n in zip(cols, names)],
                        F.col("id").alias("data_id" if flip else "query_id"), F.col("vec").alias("data" if flip else "query"))

    left = blocks(queries, q_blocks, to_query, False, d_blocks)
    right = blocks(placed, d_blocks, to_data, True, q_blocks)

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        own, ids, xs = q["query_id"].to_numpy(), x["data_id"].to_numpy(), _matrix(x["data"].tolist())
        out = []
        for at in range(0, len(own), 128):
            some = own[at:at + 128]
            scores = products(_matrix(q["query"].iloc[at:at + 128].tolist()), xs)
            for i, (vec, score) in zip(some, best(scores, ids, some, k)):
                out.append(pd.DataFrame({"query_id": np.full(len(vec), i), "vec_id": vec, "score": score}))
        return pd.concat(out, ignore_index=True)

    key = ["qc", "qb", "dc", "db"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(solve, "query_id long, vec_id long, score long")
