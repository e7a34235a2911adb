"""Explanations (X1–X5): coefficients, text terms, permutation importance,
partial dependence and tree importances.

For any model, permutation importance and partial dependence replicate the
scored rows once per (feature, repeat) or grid point inside one Spark job; the
copies are bounded by the parameter counts (features x repeats, grid points).
For a forest the same scores come from its arrays (``trees``), and a tree is
gone through anew only where the changed feature turns a decision.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import trees as N
from .metrics import average_precision
from .ordering import global_rank, seeded_hash
from .profile import melt, quantile_columns


def _spark() -> SparkSession:
    return SparkSession.getActiveSession()


# X1
def linear_coefficients(model, feature_names) -> DataFrame:
    """(feature, coefficient, |coefficient|), largest first. Names come as a
    list or as a table (``position``, ``feature``)."""
    spark = _spark()
    coef = spark.createDataFrame([(i, float(x)) for i, x in enumerate(model.coefficients.toArray())], "_at long, coefficient double")
    names = feature_names if isinstance(feature_names, DataFrame) else \
        spark.createDataFrame(list(enumerate(feature_names)), "position long, feature string")
    df = names.join(coef, F.col("position") == F.col("_at")).select("feature", "coefficient")
    return df.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(F.desc("abs_coefficient"), "feature")


# X2
def top_text_terms(model, vocab: DataFrame, k: int = 20, offset: int = 0) -> DataFrame:
    """The ``k`` most negative and ``k`` most positive text coefficients
    (vocabulary index + ``offset`` = coefficient position)."""
    coef = model.coefficients.toArray()
    spark = _spark()
    c = spark.createDataFrame([(i - offset, float(coef[i])) for i in range(offset, offset + vocab.count())],
                              "index long, coefficient double")
    j = vocab.select("term", "index").join(c, "index")
    neg = j.orderBy("coefficient", "term").limit(k).withColumn("side", F.lit("negative"))
    pos = j.orderBy(F.desc("coefficient"), "term").limit(k).withColumn("side", F.lit("positive"))
    return neg.unionByName(pos)


# X3
def permutation_importance(scored_fn, df: DataFrame, features: list[str], repeats: int = 5, seed: int = 42,
                           id_col: str = "order_id", label: str = "label", forest: N.Forest | None = None) -> DataFrame:
    """Drop in average precision when one column is shuffled, mean and
    population std over ``repeats`` shuffles. A shuffle pairs the row at
    position i (by id) with the row at position i of a seeded-hash order of
    its repeat, for all features alike: one rank by id and one per repeat.
    Each feature's copy of a row takes that feature from the paired row and
    is scored by ``scored_fn`` (DataFrame -> DataFrame with column 'p').
    ``forest``: the arrays of the forest that ``scored_fn`` applies to the
    vector of ``features``; the copies' scores come from one pass over it."""
    base_ap = average_precision(scored_fn(df).select(F.col(label).alias("y"), "p")).first()[0]
    names = F.array(*[F.lit(f) for f in features])
    placed = global_rank(df, [id_col], name="_pos")
    donors = []
    for r in range(repeats):
        h = seeded_hash(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(r)), seed)
        donors.append(global_rank(df.select(id_col, h.alias("_h"), *[F.col(c).cast("double").alias(f"_d_{c}") for c in features]),
                                  ["_h", id_col], name="_pos").drop(id_col, "_h"))
    if forest is not None:
        ap = _forest_copies(placed, donors, features, forest, label)
    else:
        scored = []
        for r, donor in enumerate(donors):
            copies = placed.join(donor, "_pos").withColumn("_f", F.explode(names)).withColumns(
                {c: F.when(F.col("_f") == F.lit(c), F.col(f"_d_{c}")).otherwise(F.col(c).cast("double")) for c in features})
            scored.append(scored_fn(copies).select("_f", F.lit(r).alias("_r"), F.col(label).alias("y"), "p"))
        ap = average_precision(reduce(DataFrame.unionByName, scored), ["_f", "_r"])
    drop = ap.select(F.col("_f").alias("feature"), (F.lit(base_ap) - F.col("average_precision")).alias("d"))
    return (drop.groupBy("feature").agg(F.avg("d").alias("importance_mean"), F.stddev_pop("d").alias("importance_std"))
                .orderBy(F.desc("importance_mean"), "feature"))


def _forest_copies(placed: DataFrame, donors: list[DataFrame], features: list[str], forest: N.Forest, label: str) -> DataFrame:
    """Average precision of each feature (``_f``) and repeat (``_r``): a row
    meets its donors of all repeats, and its copies' scores are one array."""
    array = lambda names: F.array(*[F.col(c).cast("double") for c in names])
    rows = placed.select("_pos", F.col(label).alias("_y"), array(features).alias("_x"))
    for r, donor in enumerate(donors):
        rows = rows.join(donor.select("_pos", array([f"_d_{c}" for c in features]).alias(f"_d{r}")), "_pos")
    # A row is much work for few bytes: dealt out to all cores.
    rows = rows.repartition(4 * placed.sparkSession.sparkContext.defaultParallelism)
    given = F.concat(*[F.col(f"_d{r}") for r in range(len(donors))])
    scored = N.with_donor_scores(rows, forest, F.col("_y"), F.col("_x"), given, len(features), len(donors))
    ap = average_precision(scored.select("y", F.posexplode("scores").alias("_k", "p")), ["_k"])
    name = F.element_at(F.array(*map(F.lit, features)), F.floor(F.col("_k") / len(donors)).cast("int") + 1)
    return ap.select(name.alias("_f"), (F.col("_k") % len(donors)).alias("_r"), "average_precision")


# X4
def feature_grid(df: DataFrame, feature: str, grid_resolution: int = 100, percentiles=(0.05, 0.95)) -> list[float]:
    """The distinct values when fewer than ``grid_resolution``, else an even
    grid between the 5th and 95th percentiles."""
    vals = df.select(F.col(feature).cast("double").alias("v")).filter(F.col("v").isNotNull())
    n_distinct = vals.agg(F.countDistinct("v")).scalar()
    few = vals.distinct().withColumn("_few", F.lit(1))
    q = quantile_columns(melt(df, [feature]), ["feature"], {"lo": percentiles[0], "hi": percentiles[1]})
    lo, hi = q.select("lo").scalar(), q.select("hi").scalar()
    even = (q.select(F.explode(F.sequence(F.lit(0), F.lit(grid_resolution - 1))).alias("i"))
              .select((lo + F.col("i") * (hi - lo) / (grid_resolution - 1)).alias("v")))
    grid = few.select("v").where(n_distinct < grid_resolution).unionByName(even.where(n_distinct >= grid_resolution))
    return [float(r.v) for r in grid.orderBy("v").collect()]  # at most grid_resolution values


def partial_dependence(scored_fn, df: DataFrame, feature: str, grid_resolution: int = 100,
                       percentiles=(0.05, 0.95), forest: N.Forest | None = None, features: list[str] | None = None) -> DataFrame:
    """Mean predicted probability with ``feature`` set to each value of its
    ``feature_grid``, for any model. ``forest``: the arrays of the forest that
    ``scored_fn`` applies to the vector of ``features``; the same mean then
    comes from one pass over the rows, without copies."""
    g = feature_grid(df, feature, grid_resolution, percentiles)
    if forest is not None and g:
        x = F.array(*[F.col(c).cast("double") for c in features])
        rows = df.select(x.alias("_x")).repartition(4 * df.sparkSession.sparkContext.defaultParallelism)
        return N.forest_dependence(rows, forest, F.col("_x"), features.index(feature), g)
    values = F.array(*[F.lit(v) for v in g]).cast("array<double>")  # no values: no rows
    # Rows are dealt out first: a slice of a sorted table lies in few partitions.
    cores = df.sparkSession.sparkContext.defaultParallelism
    expanded = df.repartition(4 * cores).select("*", F.explode(values).alias("_grid"))
    expanded = expanded.withColumn(feature, F.col("_grid"))
    return scored_fn(expanded).groupBy(F.col("_grid").alias("grid_value")).agg(F.avg("p").alias("mean_probability"))


# X5
def tree_importance(model, feature_names: list[str], top: int = 20) -> DataFrame:
    imp = [float(x) for x in model.featureImportances.toArray()]
    df = _spark().createDataFrame(list(zip(feature_names, imp)), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)
