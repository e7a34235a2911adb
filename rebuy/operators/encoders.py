"""Train-fitted encoders (E1–E9): fit on the train split, apply to any
split. Fitted state is small (one value per column or per category, a
vocabulary) and travels as literals or broadcast frames; rows never leave
the executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, shared_path
from .ordering import global_rank
from .profile import melt, quantile_columns

TARGET = "target_repeat_within_180d"

# The 16 numeric and 4 categorical baseline features, the
# missing-category label, the token pattern (runs of 2+ letters, digits or
# underscores) and the text defaults (30000 terms, min_df 5, 1-2 grams).
BASELINE_NUMERIC = [
    "review_score", "text_present", "text_char_len", "text_word_count", "log1p_total_price",
    "log1p_total_freight", "freight_ratio", "log1p_payment_value_total", "payment_installments_max",
    "log1p_approval_lag_hours", "log1p_delivery_days", "delivery_delay_days_clipped",
    "late_delivery_flag", "item_count", "seller_count", "same_state_seller_customer",
]
BASELINE_CATEGORICAL = ["payment_type_mode", "product_category_main", "customer_state", "seller_state_mode"]
MISSING = "__MISSING__"
TOKEN = r"[\p{L}\p{N}_]{2,}"
MAX_FEATURES, MIN_DF = 30000, 5


# E1
def fit_median(train: DataFrame, cols: list[str]) -> dict[str, float]:
    """Exact train medians (distributed order statistics)."""
    q = quantile_columns(melt(train, cols), ["feature"], {"median": 0.5})
    got = {r.feature: r.median for r in q.collect()}  # one row per column
    return {c: got.get(c) for c in cols}


def impute_median(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double"))
                           for c, m in medians.items()})


# E2
def fit_mode(train: DataFrame, cols: list[str]) -> dict[str, str]:
    """Most frequent train value per column (smallest on ties)."""
    counts = (melt(train, cols, cast="string").filter(F.col("value").isNotNull())
              .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    got = {r.feature: r.mode for r in best.collect()}  # one row per column
    return {c: got.get(c) for c in cols}


def impute_mode(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(m)) for c, m in modes.items()})


# E3
def fit_scaler(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Train mean and population std per column (a zero std scales by 1)."""
    row = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols]).first()
    out = {}
    for c in cols:
        s = row[f"s_{c}"]
        out[c] = (row[f"m_{c}"], 1.0 if (s is None or s == 0) else s)
    return out


def standard_scale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()})


# Sparse vectors without Python: the vector's storage struct is built with
# array functions, written, and read back under the vector type.
def sparse_struct(size, indices: Column, values: Column) -> Column:
    """A sparse vector as it is stored; ``indices`` ascend."""
    size = size if isinstance(size, Column) else F.lit(int(size))
    return F.struct(F.lit(0).cast("byte").alias("type"), size.alias("size"), indices.cast("array<int>").alias("indices"),
                    values.cast("array<double>").alias("values"))


def joined_structs(parts: list[tuple[str, int]]) -> Column:
    """Sparse structs (column, size) one after another, as one struct."""
    indices, values, at = [], [], 0
    for name, size in parts:
        shift = at
        indices.append(F.transform(F.col(f"{name}.indices"), lambda i: i + F.lit(shift)))
        values.append(F.col(f"{name}.values"))
        at += size
    return sparse_struct(at, F.concat(*indices), F.concat(*values))


def with_vectors(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` written with the structs ``names``, read back as vectors."""
    from pyspark.ml.linalg import VectorUDT
    spark = df.sparkSession
    path = shared_path(spark, f"{spark.sparkContext.applicationId}/vectors-{uuid.uuid4().hex}")
    df.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name in names else f.dataType) for f in df.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


# E4
def fit_category_table(train: DataFrame, cols: list[str]) -> DataFrame:
    """One row for each distinct train value of each column: ``block`` (the
    column's place in ``cols``), ``value``, ``code`` (alphabetical, from 0, in
    its block) and ``position`` (from 0, block after block). Written."""
    blocks = F.array_position(F.array(*map(F.lit, cols)), F.col("feature")).cast("int") - 1
    distinct = melt(train, cols, cast="string").where("value is not null").select(blocks.alias("block"), "value").distinct()
    ranked = global_rank(distinct, ["block", "value"], name="position").withColumn("position", F.col("position") - 1)
    first = ranked.groupBy(F.col("block").alias("_b")).agg(F.min("position").alias("_first"))  # a row a column
    return materialize(ranked.join(first, F.col("block") == F.col("_b")).select(
        "block", "value", (F.col("position") - F.col("_first")).alias("code"), "position"), "categories")


def with_category(df: DataFrame, col: str, table: DataFrame, block: int = 0, field: str = "position", name: str | None = None) -> DataFrame:
    """``field`` of the column's category (NULL if it was not in train), by a
    join: the plan does not grow with the categories."""
    t = table.where(F.col("block") == block).select(F.col("value").alias("_v"), F.col(field).cast("int").alias("_f"))
    return df.join(t, F.col(col).cast("string") == F.col("_v"), "left").withColumn(name or f"{col}_{field}", F.col("_f")).drop("_v", "_f")


def one_hot(df: DataFrame, col: str, table: DataFrame, size: int, name: str | None = None) -> DataFrame:
    """Sparse struct with a one at the train category of ``col``; unseen
    values and NULL have none. ``size``: rows of the category table."""
    out = with_category(df, col, table, name="_at")
    at = F.array_compact(F.array("_at"))
    return out.withColumn(name or f"{col}_onehot", sparse_struct(size, at, F.transform(at, lambda _: F.lit(1.0)))).drop("_at")


# E5
def fit_ordinal(train: DataFrame, col: str, missing: str | None = None) -> DataFrame:
    """Alphabetical code (0-based) of every distinct train value, as a
    frame (one row per category). ``missing``: NULL counts as this value."""
    vals = train.select(F.coalesce(F.col(col).cast("string"), F.lit(missing).cast("string")).alias("value")).filter(F.col("value").isNotNull()).distinct()
    return global_rank(vals, ["value"], name="code").withColumn("code", F.col("code") - 1)


def ordinal_encode(df: DataFrame, col: str, codes: DataFrame, unknown: int = -1,
                   name: str | None = None, missing: str | None = None) -> DataFrame:
    """Code of the value; values unseen in train -> ``unknown``, and NULL too
    unless it counts as the value ``missing``. Embedding inputs take
    ``missing=MISSING, unknown=0``."""
    # one row per train category: AQE broadcasts it when it is small
    c = codes.select(F.col("value").alias("_v"), F.col("code").alias("_code"))
    value = F.coalesce(F.col(col).cast("string"), F.lit(missing).cast("string"))
    out = df.join(c, value == F.col("_v"), "left")
    return out.withColumn(name or f"{col}_code", F.coalesce(F.col("_code"), F.lit(unknown)).cast("int")) \
              .drop("_v", "_code")


# E6
def fit_target_encoding(train: DataFrame, col: str, target: str = TARGET, smoothing: float = 0.0) -> DataFrame:
    """Per category: (sum y + m * mean) / (n + m); m = 0 is the plain mean.
    Returns (value, encoding) plus the global mean for unseen values."""
    mean = train.agg(F.avg(F.col(target).cast("double"))).scalar()
    g = train.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("value")).agg(
        F.sum(F.col(target).cast("double")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return g.select("value", ((F.col("_s") + F.lit(float(smoothing)) * mean) /
                              (F.col("_n") + F.lit(float(smoothing)))).alias("encoding"), mean.alias("global_mean"))


def target_encode(df: DataFrame, col: str, enc: DataFrame, name: str | None = None) -> DataFrame:
    e = enc.select(F.col("value").alias("_v"), F.col("encoding").alias("_e"), F.col("global_mean").alias("_gm"))
    gm = e.agg(F.first("_gm")).scalar()
    out = df.join(e.drop("_gm"), F.col(col).cast("string") == F.col("_v"), "left")
    return out.withColumn(name or f"{col}_target_enc", F.coalesce(F.col("_e"), gm)).drop("_v", "_e")


# E7
def terms(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """(id, term, tf) rows: lower-cased tokens and adjacent-token bigrams of
    each id with their counts. Only texts are shuffled, by id; the terms of
    one id are sorted and counted in its row."""
    def with_bigrams(toks: Column) -> Column:
        more = F.greatest(F.size(toks) - 1, F.lit(0))
        return F.concat(toks, F.zip_with(F.slice(toks, 1, more), F.slice(toks, 2, more), lambda a, b: F.concat(a, F.lit(" "), b)))

    ids = df.where(F.col(text).isNotNull()).groupBy(id_col).agg(F.collect_list(text).alias("_texts"))
    toks = F.transform("_texts", lambda t: F.regexp_extract_all(F.lower(t), F.lit(TOKEN), 0))
    rows = ids.select(id_col, F.sort_array(F.flatten(F.transform(toks, with_bigrams))).alias("_t"))
    # Places where a run of equal terms begins; each ends where the next begins.
    begins = F.filter(F.transform("_t", lambda t, i: F.when((i == 0) | (t != F.get("_t", i - 1)), i)), lambda i: i.isNotNull())
    # Outer: for an inner explode Spark infers a filter on the array's size
    # and pushes it down, so that each text is cut and sorted a second time.
    rows = rows.select(id_col, "_t", begins.alias("_at")).select(id_col, "_t", "_at", F.posexplode_outer("_at").alias("_k", "_b"))
    end = F.coalesce(F.get("_at", F.col("_k") + 1), F.size("_t"))
    return rows.where(F.col("_b").isNotNull()).select(
        id_col, F.get("_t", F.col("_b")).alias("term"), (end - F.col("_b")).cast("long").alias("tf"))


def fit_tfidf(train: DataFrame, text: str = "review_text", id_col: str = "order_id",
              max_features: int = MAX_FEATURES, min_df: int = MIN_DF) -> DataFrame:
    """Vocabulary: terms in at least ``min_df`` train documents, the
    ``max_features`` most frequent over the corpus (ties by term), indexed
    alphabetically, with smoothed idf = ln((1+n)/(1+df)) + 1."""
    n_docs = train.agg(F.count(F.lit(1))).scalar()
    tf = terms(train, text, id_col)
    stats = (tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
               .filter(F.col("df") >= min_df))
    top = global_rank(stats, [("cf", False), "term"], name="_r").filter(F.col("_r") <= max_features)
    vocab = global_rank(top.drop("_r"), ["term"], name="index").withColumn("index", F.col("index") - 1)
    return vocab.select("term", "index", "df", "cf",
                        (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf_weights(df: DataFrame, vocab: DataFrame, text: str = "review_text", id_col: str = "order_id") -> DataFrame:
    """(id, term, index, weight): sublinear tf * idf, L2-normalised per doc.
    The vocabulary is at most ``max_features`` rows and is broadcast, so the
    terms stay where their id is."""
    w = (terms(df, text, id_col).join(F.broadcast(vocab.select("term", "index", "idf")), "term")
           .withColumn("w", (1 + F.log(F.col("tf").cast("double"))) * F.col("idf")))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", "index", (F.col("w") / norm).alias("weight"))


def tfidf_pairs(weights: DataFrame, id_col: str = "order_id") -> DataFrame:
    """One row per id: ``_pairs``, its (index, weight) in order of the index."""
    return weights.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct(F.col("index").cast("int").alias("index"), "weight"))).alias("_pairs"))


def tfidf_structs(df: DataFrame, weights: DataFrame, size: int, id_col: str = "order_id",
                  name: str = "text_features") -> DataFrame:
    """Attach a sparse struct per row (empty for rows without vocabulary
    terms). ``weights``: rows of ``tfidf_weights`` or of ``tfidf_pairs``."""
    per_doc = weights if "_pairs" in weights.columns else tfidf_pairs(weights, id_col)
    pairs = F.coalesce("_pairs", F.array().cast("array<struct<index:int,weight:double>>"))
    # Merged, so that the lists of terms are never broadcast.
    return df.join(per_doc.hint("merge"), id_col, "left").withColumn(name, sparse_struct(size, pairs["index"], pairs["weight"])).drop("_pairs")


def tfidf_vectors(df: DataFrame, weights: DataFrame, size: int, id_col: str = "order_id",
                  name: str = "text_features") -> DataFrame:
    """``tfidf_structs`` written and read back as vectors."""
    return with_vectors(tfidf_structs(df, weights, size, id_col, name), [name])


# E9
def baseline_columns(df: DataFrame) -> DataFrame:
    return df.select(*BASELINE_NUMERIC, *BASELINE_CATEGORICAL)


# E8
class TabularPreprocessor:
    """Per-column-group pipelines concatenated into one vector:
    numeric -> median impute (-> standard scale); categorical -> mode impute
    -> one-hot (unseen -> zeros) or ordinal code (unseen -> -1)."""

    def __init__(self, numeric: list[str], categorical: list[str], scale: bool = True,
                 categorical_mode: str = "onehot", output: str = "features"):
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.scale, self.mode, self.output = scale, categorical_mode, output

    def fit(self, train: DataFrame) -> "TabularPreprocessor":
        self.medians = fit_median(train, self.numeric) if self.numeric else {}
        t = impute_median(train, self.medians)
        self.scaler = fit_scaler(t, self.numeric) if (self.scale and self.numeric) else {}
        self.modes = fit_mode(train, self.categorical) if self.categorical else {}
        self.table = fit_category_table(impute_mode(train, self.modes), self.categorical) if self.categorical else None
        onehot = self.mode == "onehot" and self.categorical
        self.size = len(self.numeric) + (self.table.count() if onehot else len(self.categorical))
        return self

    def columns(self) -> list[str]:
        """Names of the vector's places, for reports."""
        cols = list(self.numeric)
        if self.mode != "onehot":
            return cols + [f"{c}_code" for c in self.categorical]
        if self.table is not None:
            cols += [f"{self.categorical[r.block]}_{r.value}" for r in self.table.orderBy("position").collect()]
        return cols

    def names(self, spark) -> DataFrame:
        """``position`` and ``feature`` of the vector's places, as a table."""
        fixed = list(self.numeric) + ([f"{c}_code" for c in self.categorical] if self.mode != "onehot" else [])
        out = spark.createDataFrame(list(enumerate(fixed)), "position long, feature string")
        if self.mode != "onehot" or self.table is None:
            return out
        col = F.element_at(F.array(*map(F.lit, self.categorical)), F.col("block") + 1)
        return out.unionByName(self.table.select((F.col("position") + len(self.numeric)).alias("position"),
                                                 F.concat_ws("_", col, "value").alias("feature")))

    def _prepared(self, df: DataFrame) -> DataFrame:
        out = impute_median(df, self.medians)
        if self.scaler:
            out = standard_scale(out, self.scaler)
        return impute_mode(out, self.modes)

    def encode(self, df: DataFrame) -> DataFrame:
        """``output`` as a sparse struct: the numeric columns, then a one for
        the category of each categorical column (none if it is unseen)."""
        out, n = self._prepared(df), len(self.numeric)
        places = [f"_at{i}" for i in range(len(self.categorical))]
        for i, c in enumerate(self.categorical):
            out = with_category(out, c, self.table, i, name=places[i])
        ones = F.array_compact(F.array(*places)) if places else F.array().cast("array<int>")
        indices = F.concat(F.array(*[F.lit(i) for i in range(n)]).cast("array<int>"), F.transform(ones, lambda i: i + F.lit(n)))
        values = F.concat(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in self.numeric]).cast("array<double>"),
                          F.transform(ones, lambda _: F.lit(1.0)))
        return out.withColumn(self.output, sparse_struct(self.size, indices, values)).drop(*places)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.mode == "onehot":
            return with_vectors(self.encode(df), [self.output])
        from pyspark.ml.feature import VectorAssembler
        out = self._prepared(df)
        for i, c in enumerate(self.categorical):
            out = with_category(out, c, self.table, i, "code", f"{c}_code")
            out = out.withColumn(f"{c}_code", F.coalesce(f"{c}_code", F.lit(-1)).cast("double"))
        return VectorAssembler(inputCols=self.columns(), outputCol=self.output, handleInvalid="keep").transform(out)
