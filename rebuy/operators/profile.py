"""Profiling and statistics (P1–P11; P12–P13 live with the models).

Wide statistics are one aggregate over all columns, turned into rows with
``inline``, or one aggregate grouped by column. Order statistics (quartiles,
medians) are exact and distributed over counted distinct values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import sample_excess_kurtosis, sample_skewness, t_pvalue
from .ordering import group_rank, prefix_sums
from .quantiles import at_positions

TARGET = "target_repeat_within_180d"


def melt(df: DataFrame, cols: list[str], keep: list[str] = (), name: str = "feature",
         value: str = "value", cast: str = "double") -> DataFrame:
    """Wide -> long: one row per (input row, column)."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast(cast).alias(value)) for c in cols])
    return (df.select(*keep, F.explode(pairs).alias("_m"))
              .select(*keep, F.col(f"_m.{name}").alias(name), F.col(f"_m.{value}").alias(value)))


def _rows(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn a one-row wide result into rows."""
    return one_row.select(F.inline(F.array(*structs)))


def quantile_columns(long: DataFrame, keys: list[str], qs: dict[str, float], value: str = "value",
                     approx: bool = False, accuracy: int = 10000, narrow: bool = False) -> DataFrame:
    """Quantiles of ``value`` as named columns (e.g. {'q1': .25, 'q3': .75})
    per ``keys`` group, exact and linear-interpolated (position q*(n-1)
    between neighbours). Equal values collapse to one counted row before the
    shuffle, running counts give each value its span of positions, and only
    the values whose span holds a wanted position are kept, so a value that
    fills a column costs one row. NULL and NaN take no part; a group without
    values gives no row. ``approx=True`` opts into ``percentile_approx``
    (relative rank error 1/accuracy), ``narrow=True`` into narrowing histograms
    (exact, four scans without an order over values; see ``quantiles``)."""
    data = long.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    if approx:
        got = F.percentile_approx(value, [float(q) for q in qs.values()], accuracy)
        return data.groupBy(*keys).agg(got.alias("_qs")).select(
            *keys, *[F.col("_qs")[i].alias(n) for i, n in enumerate(qs)])
    if narrow:
        found = at_positions(data, keys, list(qs.values()), value)
        between = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at"))
        # Neighbours that are equal need no difference, which infinity lacks.
        exact = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(between)
        return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, exact)).alias(n) for i, n in enumerate(qs)])
    counted = data.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    cum = prefix_sums(counted, [*keys, value], ["_c"])
    groups = cum.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.min(F.col("_c_cum") - F.col("_c")).alias("_start"))
    last = F.col("_c_cum") - F.col("_start") - 1
    first = last - F.col("_c") + 1
    # One row per group (a column, a class): by a shuffle, a group would be a task.
    spans = cum.join(F.broadcast(groups), keys).select(*keys, F.col(value).alias("_v"), "_n", first.alias("_first"), last.alias("_last"))
    aggs, outs = [F.first("_n").alias("_n")], []
    for i, (name, q) in enumerate(qs.items()):
        at = F.lit(float(q)) * (F.col("_n") - 1)
        for side, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.max(F.when(pos.between(F.col("_first"), F.col("_last")), F.col("_v"))).alias(f"_{side}{i}"))
        outs.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (at - F.floor(at))).alias(name))
    return spans.groupBy(*keys).agg(*aggs).select(*keys, *outs)


def exact_quantiles(long: DataFrame, keys: list[str], qs=(0.25, 0.5, 0.75),
                    value: str = "value", approx: bool = False, accuracy: int = 10000, narrow: bool = False) -> DataFrame:
    """``quantile_columns`` as rows (keys..., q, quantile)."""
    names = {f"_q{i}": float(q) for i, q in enumerate(qs)}
    wide = quantile_columns(long, keys, names, value, approx, accuracy, narrow)
    return wide.select(*keys, F.inline(F.array(*[F.struct(F.lit(q).alias("q"), F.col(n).alias("quantile"))
                                                 for n, q in names.items()])))


# P1
def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: count, mean, sample std, bias-corrected skewness and
    excess kurtosis (pandas conventions; 0 for a constant column), min,
    max, nulls. One aggregate grouped by column over the melted values (nine
    buffers, inside code generation, whatever the number of columns). An
    empty table gives no rows."""
    x = F.col("value")
    n = F.col("n").cast("double")
    const = F.col("_vp") == 0
    per = melt(df, cols).groupBy("feature").agg(
        F.count(x).alias("n"), F.count(F.lit(1)).alias("_rows"), F.avg(x).alias("mean"), F.skewness(x).alias("_g1"),
        F.kurtosis(x).alias("_g2"), F.var_pop(x).alias("_vp"), F.min(x).alias("min"), F.max(x).alias("max"))
    return per.select(
        "feature", "n", "mean", F.when(n > 1, F.sqrt(F.col("_vp") * n / (n - 1))).alias("std"),
        F.when(n < 3, None).when(const, 0.0).otherwise(sample_skewness(F.col("_g1"), n)).alias("skewness"),
        F.when(n < 4, None).when(const, 0.0).otherwise(sample_excess_kurtosis(F.col("_g2"), n)).alias("kurtosis"),
        "min", "max", (F.col("_rows") - F.col("n")).alias("nulls"))


# P2
def missing_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null count and share (%, 2 decimals) per column, only columns with
    nulls, largest share first."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    rows = _rows(wide, [F.struct(F.lit(c).alias("feature"), F.col(c).alias("missing_count"),
                                 F.round(F.col(c) / F.col("__rows") * 100, 2).alias("missing_pct"))
                        for c in cols])
    return rows.filter(F.col("missing_count") > 0).orderBy(F.desc("missing_pct"), "feature")


def _fenced(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    long = melt(df, cols).filter(F.col("value").isNotNull())
    qs = quantile_columns(long, ["feature"], {"q1": 0.25, "median": 0.5, "q3": 0.75})
    fences = qs.select("*", (F.col("q3") - F.col("q1")).alias("iqr")).select(
        "*", (F.col("q1") - k * F.col("iqr")).alias("lower_fence"),
        (F.col("q3") + k * F.col("iqr")).alias("upper_fence"))
    v = F.col("value")
    inside = (v >= F.col("lower_fence")) & (v <= F.col("upper_fence"))
    counted = (long.join(fences.select("feature", "lower_fence", "upper_fence"), "feature")
                   .groupBy("feature").agg(
                       F.count(v).alias("n"),
                       F.count(F.when(~inside, 1)).alias("n_outliers"),
                       F.min(F.when(inside, v)).alias("whisker_low"),
                       F.max(F.when(inside, v)).alias("whisker_high")))
    return fences.join(counted, "feature")


# P3
def iqr_outliers(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    f = _fenced(df, cols, k)
    return f.select("feature", "q1", "q3", "iqr", "lower_fence", "upper_fence", "n_outliers",
                    (F.col("n_outliers") / F.col("n") * 100).alias("outlier_pct"))


# P4
def box_stats(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    f = _fenced(df, cols, k)
    return f.select("feature", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers")


# P5
def histogram(df: DataFrame, col: str, bins: int = 30, by: str | None = None,
              density: bool = False) -> DataFrame:
    """Equal-width bins over each group's [min, max] (last bin closed; a
    constant column gets [v-0.5, v+0.5]); empty bins appear with count 0."""
    keys = [by] if by else ["_g"]
    data = df.select(F.col(by) if by else F.lit(1).alias("_g"), F.col(col).cast("double").alias("x"))
    data = data.filter(F.col("x").isNotNull() & F.col(keys[0]).isNotNull())
    rng = data.groupBy(*keys).agg(F.min("x").alias("_mn"), F.max("x").alias("_mx"), F.count("x").alias("_n"))
    same = F.col("_mn") == F.col("_mx")
    rng = rng.select(*keys, "_n", F.when(same, F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                     F.when(same, F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
    b = F.least(F.floor((F.col("x") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))),
                F.lit(bins - 1)).cast("int")
    counts = (data.join(rng, keys).select(*keys, b.alias("bin"))
                  .groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count")))
    spine = rng.select(*keys, "_n", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    out = spine.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_left"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_right"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
        (F.coalesce(F.col("count"), F.lit(0)) / (F.col("_n") * width)).alias("density"))
    if not density:
        out = out.drop("density")
    return out.drop("_g")


# P6
def class_kde(df: DataFrame, col: str, label: str = TARGET, points: int = 100) -> DataFrame:
    """Gaussian KDE per class on ``points`` grid points over the class's
    [min, max]; Scott bandwidth h = std * n^(-1/5). Values are pre-binned
    by distinct value (exact), then each distinct value meets its class's
    grid."""
    data = df.select(label, F.col(col).cast("double").alias("x")).filter(
        F.col("x").isNotNull() & F.col(label).isNotNull())
    st = data.groupBy(label).agg(F.count("x").alias("_n"), F.stddev_samp("x").alias("_sd"),
                                 F.min("x").alias("_mn"), F.max("x").alias("_mx"))
    st = st.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    grid = st.select(label, "_n", "_h", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
                     "_mn", "_mx").withColumn(
        "grid_x", F.col("_mn") + F.col("point") * (F.col("_mx") - F.col("_mn")) / (points - 1))
    vals = data.groupBy(label, "x").agg(F.count(F.lit(1)).alias("_c"))
    z = (F.col("grid_x") - F.col("x")) / F.col("_h")
    contrib = F.col("_c") * F.exp(-0.5 * z * z) / (F.col("_h") * math.sqrt(2 * math.pi))
    return (vals.join(grid.select(label, "point", "grid_x", "_n", "_h"), label)
                .groupBy(label, "point", "grid_x")
                .agg((F.sum(contrib) / F.first("_n")).alias("density")))


# P7
def class_stats(df: DataFrame, cols: list[str], label: str = TARGET) -> DataFrame:
    """Mean, exact median and count per (feature, class)."""
    long = melt(df.filter(F.col(label).isNotNull()), cols, keep=[label]).filter(F.col("value").isNotNull())
    basic = long.groupBy("feature", label).agg(F.avg("value").alias("mean"), F.count("value").alias("n"))
    med = quantile_columns(long, ["feature", label], {"median": 0.5})
    return basic.join(med, ["feature", label])


def pairwise_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete co-moments of ``cols`` (centred on the column means
    for accuracy): per (a, b) the count of rows where both are present and
    the sums of a, b, a², b², ab over those rows. Each partition reduces its
    rows to k x k matrices with numpy; Spark sums the k² cells."""
    import numpy as np
    import pandas as pd

    k = len(cols)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shift = np.array([0.0 if means[i] is None else float(means[i]) for i in range(k)])
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    ia, ib = np.meshgrid(np.arange(k), np.arange(k), indexing="ij")

    def part(batches):
        n = np.zeros((k, k)); sa = np.zeros((k, k)); saa = np.zeros((k, k)); sab = np.zeros((k, k))
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64") - shift
            m = (~np.isnan(x)).astype("float64")
            x0 = np.where(m > 0, x, 0.0)
            n += m.T @ m
            sa += x0.T @ m
            saa += (x0 * x0).T @ m
            sab += x0.T @ x0
        yield pd.DataFrame({"a": ia.ravel(), "b": ib.ravel(), "n": n.ravel(), "sa": sa.ravel(),
                            "saa": saa.ravel(), "sab": sab.ravel()})
    schema = "a long, b long, n double, sa double, saa double, sab double"
    sums = data.mapInPandas(part, schema).groupBy("a", "b").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "saa", "sab")])
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.element_at(names, F.col("a").cast("int") + 1).alias("col_a"),
                       F.element_at(names, F.col("b").cast("int") + 1).alias("col_b"), "a", "b",
                       "n", "sa", "saa", "sab")


# P8
def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlations, pairwise complete (rows where both columns are
    present), long form (a, b, r) over all ordered pairs; NULL when a
    column is constant over the shared rows."""
    mo = pairwise_moments(df, cols)
    t = mo.select(F.col("a").alias("b"), F.col("b").alias("a"), F.col("sa").alias("sb"), F.col("saa").alias("sbb"))
    j = mo.join(t, ["a", "b"])
    n = F.col("n")
    cov = n * F.col("sab") - F.col("sa") * F.col("sb")
    va = n * F.col("saa") - F.col("sa") * F.col("sa")
    vb = n * F.col("sbb") - F.col("sb") * F.col("sb")
    r = F.when((n > 1) & (va > 0) & (vb > 0), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cov / F.sqrt(va * vb))))
    return j.select(F.col("col_a").alias("a"), F.col("col_b").alias("b"),
                    F.when(F.col("a") == F.col("b"), F.when(va > 0, F.lit(1.0))).otherwise(r).alias("r"))


# P9
def target_corr(df: DataFrame, cols: list[str], target: str = TARGET, alarm: float = 0.5) -> DataFrame:
    """|corr| of each column with the target, ranked, with a leakage flag."""
    long = melt(df.withColumn("_y", F.col(target).cast("double")), cols, keep=["_y"])
    rows = long.groupBy("feature").agg(F.abs(F.corr("value", "_y")).alias("abs_corr"))
    rows = rows.withColumn("abs_corr", F.when(~F.isnan("abs_corr"), F.col("abs_corr")))
    return (group_rank(rows.withColumn("_all", F.lit(1)), ["_all"], [("abs_corr", False), "feature"],
                       name="rank").drop("_all")
            .withColumn("leakage_alarm", F.coalesce(F.col("abs_corr") > alarm, F.lit(False)).cast("int")))


# P10
def categorical_profile(df: DataFrame, cols: list[str], top: int = 3) -> DataFrame:
    """Distinct count and the ``top`` most frequent values per column
    (ties by value)."""
    long = melt(df, cols, cast="string").filter(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    card = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique"))
    ranked = group_rank(counts, ["feature"], [("count", False), "value"], name="rank")
    return ranked.filter(F.col("rank") <= top).join(card, "feature")


# P11
def welch_ttest(df: DataFrame, cols: list[str], target: str = TARGET, alpha: float = 0.05,
                with_p: bool = True) -> DataFrame:
    """Per feature (rows with the feature present): correlation with the
    target, class means, Welch's t (class 0 minus class 1), its degrees of
    freedom and two-sided p-value."""
    y = F.col(target).cast("double")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        x0 = F.when(x.isNotNull() & (y == 0), x)
        x1 = F.when(x.isNotNull() & (y == 1), x)
        aggs += [F.corr(x, F.when(x.isNotNull(), y)).alias(f"{c}__r"),
                 F.count(x0).alias(f"{c}__n0"), F.avg(x0).alias(f"{c}__m0"), F.var_samp(x0).alias(f"{c}__v0"),
                 F.count(x1).alias(f"{c}__n1"), F.avg(x1).alias(f"{c}__m1"), F.var_samp(x1).alias(f"{c}__v1")]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("feature"), F.col(f"{c}__r").alias("corr"),
                        F.col(f"{c}__n0").alias("n0"), F.col(f"{c}__m0").alias("mean_0"),
                        F.col(f"{c}__v0").alias("var_0"), F.col(f"{c}__n1").alias("n1"),
                        F.col(f"{c}__m1").alias("mean_1"), F.col(f"{c}__v1").alias("var_1"))
               for c in cols]
    rows = _rows(wide, structs)
    se0 = F.col("var_0") / F.col("n0")
    se1 = F.col("var_1") / F.col("n1")
    rows = rows.select(
        "feature", F.when(~F.isnan("corr"), F.col("corr")).alias("corr"), "mean_0", "mean_1",
        F.try_divide(F.col("mean_0") - F.col("mean_1"), F.sqrt(se0 + se1)).alias("t_stat"),
        F.try_divide((se0 + se1) * (se0 + se1),
                     se0 * se0 / (F.col("n0") - 1) + se1 * se1 / (F.col("n1") - 1)).alias("dof"))
    if with_p:
        rows = rows.withColumn("p_value", t_pvalue("t_stat", "dof")).withColumn(
            "significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)).cast("int"))
    return rows


# P12
class Components:
    """Principal components: ``pc`` (features x components, by falling
    eigenvalue), ``eigenvalues``, and the ``matrix`` they belong to."""

    def __init__(self, matrix):
        import numpy as np
        from pyspark.ml.linalg import DenseMatrix, DenseVector

        values, vectors = np.linalg.eigh(matrix)
        order = np.argsort(-values, kind="stable")
        self.matrix, self.eigenvalues, self.vectors = matrix, values[order], vectors[:, order]
        self.pc = DenseMatrix(*vectors.shape, self.vectors.ravel(order="F").tolist())
        total = np.trace(matrix)
        self.explainedVariance = DenseVector(self.eigenvalues / total if total > 0 else self.eigenvalues * 0)

    def residuals(self) -> list[float]:
        """Largest entry of ``|C v - lambda v|`` for each component."""
        return abs(self.matrix @ self.vectors - self.vectors * self.eigenvalues).max(0).tolist()


def standardised_covariance(df: DataFrame, cols: list[str]):
    """Covariance of the standardised columns (nulls are 0; a constant column
    has zeros) from one pass of merged co-moments: k x k cells, no scaled rows."""
    import numpy as np

    data = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    k = len(cols)
    n, sa, sab = np.zeros((k, k)), np.zeros((k, k)), np.zeros((k, k))
    for r in pairwise_moments(data, cols).collect():  # k x k rows
        n[r.a, r.b], sa[r.a, r.b], sab[r.a, r.b] = r.n, r.sa, r.sab
    with np.errstate(all="ignore"):
        cov = sab - sa * sa.T / n
        std = np.sqrt(np.diag(cov))
        # Sums of equal values leave rounding errors, not a variance.
        flat = ~(std > 1e-12 * np.sqrt(np.maximum(np.diag(sab), 1)))
        out = cov / std[:, None] / std[None, :]
    out[flat, :] = out[:, flat] = 0.0
    return (out + out.T) / 2


def pca_scree(df: DataFrame, cols: list[str], k: int | None = None):
    """PCA of the standardised columns (nulls -> 0) by the eigenvectors of
    their covariance. Returns (scree frame with explained share, cumulative
    share and the component counts that reach 90 % / 95 %, components)."""
    from .ordering import cumulative_share
    model = Components(standardised_covariance(df, cols))
    spark = df.sparkSession
    ev = [max(0.0, float(x)) for x in model.explainedVariance.toArray()][:k]
    comps = spark.createDataFrame([(i + 1, v) for i, v in enumerate(ev)], "component int, explained double")
    return cumulative_share(comps, "explained", ["component"]), model


# P13
def pca_loadings(model, cols: list[str], top: int = 10, n_pc: int = 3) -> DataFrame:
    """Loadings of the first components per feature (each component's sign
    fixed so its largest |loading| is positive), the ``top`` features by
    |PC1|."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    import numpy as np
    pc = np.array(model.pc.toArray())
    n_pc = min(n_pc, pc.shape[1])
    rows = []
    for j in range(n_pc):
        col = pc[:, j]
        sign = 1.0 if col[abs(col).argmax()] >= 0 else -1.0
        pc[:, j] = col * sign
    for i, c in enumerate(cols):
        rows.append((c, *[float(pc[i, j]) for j in range(n_pc)]))
    names = [f"pc{j + 1}" for j in range(n_pc)]
    df = spark.createDataFrame(rows, ", ".join(["feature string"] + [f"{n} double" for n in names]))
    return df.withColumn("abs_pc1", F.abs("pc1")).orderBy(F.desc("abs_pc1"), "feature").limit(top)
