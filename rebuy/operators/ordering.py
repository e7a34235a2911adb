"""Global order, splits, sampling and small running computations.

``global_rank`` is the one primitive: an exact 1..n position under a total
order without a single-partition window. Rows are range-partitioned by their
sort key, sorted within their range and written once with their place in it;
the sizes of the ranges before (one row per range) shift the places to
positions. Ranges are sized by Spark's own sampling and by AQE, and stay
balanced even when one leading key value holds a third of the rows, as long
as the order ends in a unique tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: monotonically_increasing_id keeps the row's place in the lower 33 bits
PLACE_BITS = 33


def _spec(order) -> list[tuple[str, bool]]:
    """Normalise an order list: ``"c"`` or ``("c", ascending)``."""
    out = []
    for o in order:
        if isinstance(o, str):
            out.append((o, True))
        else:
            out.append((o[0], bool(o[1])))
    return out


def _sort_cols(spec) -> list[Column]:
    # Spark defaults: ascending = NULLS FIRST, descending = NULLS LAST
    return [F.col(c).asc() if a else F.col(c).desc() for c, a in spec]


def in_buckets(df: DataFrame, order, n_buckets: int | None = None) -> DataFrame:
    """``df`` with ``_bkt`` (key range, ascending in the order) and ``_at``
    (0-based place within the range), written once to the shared folder so
    that every later branch sees the same ranges. Without ``n_buckets`` AQE
    sizes the ranges by bytes; it merges neighbours only, which keeps the order."""
    cols = _sort_cols(_spec(order))
    ranged = df.repartitionByRange(n_buckets, *cols) if n_buckets else df.repartitionByRange(*cols)
    placed = materialize(ranged.sortWithinPartitions(*cols).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    return (placed.withColumn("_bkt", F.shiftright("_at", PLACE_BITS))
                  .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))))


# D1
def global_rank(df: DataFrame, order, name: str = "rank", n_buckets: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row under ``order``
    (``"c"`` or ``("c", ascending)`` items; end with a unique key for a
    reproducible result). One range shuffle; no window over the rows."""
    placed = in_buckets(df, order, n_buckets)
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = sizes.select("_bkt", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    # one row per range, so at most spark.sql.shuffle.partitions rows: safe to broadcast
    return (placed.join(F.broadcast(offsets), "_bkt")
                  .withColumn(name, F.col("_off") + F.col("_at") + 1)
                  .drop("_bkt", "_at", "_off"))


def prefix_sums(df: DataFrame, order, values: list[str], n_buckets: int | None = None,
                suffix: str = "_cum") -> DataFrame:
    """Inclusive running totals of ``values`` under a total ``order``:
    running sums within each range plus the totals of the ranges before."""
    placed = in_buckets(df, order, n_buckets)
    within = Window.partitionBy("_bkt").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({f"{v}{suffix}": F.sum(v).over(within) for v in values})
    sizes = placed.groupBy("_bkt").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bkt", *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}")
                                     for v in values])
    out = local.join(F.broadcast(offsets), "_bkt")
    out = out.withColumns({f"{v}{suffix}": F.col(f"{v}{suffix}") + F.col(f"_o_{v}") for v in values})
    return out.drop("_bkt", "_at", *[f"_o_{v}" for v in values])


# D2
def temporal_split(df: DataFrame, time_col: str = "score_time", train_fraction: float = 0.70,
                   val_fraction: float = 0.15, tiebreak: str = "order_id",
                   name: str = "split") -> DataFrame:
    """Positional cut of the time-sorted rows at floor(n*f1), floor(n*(f1+f2))."""
    n = df.agg(F.count(F.lit(1))).scalar()
    c1 = F.floor(n * F.lit(float(train_fraction)))
    c2 = F.floor(n * F.lit(float(train_fraction + val_fraction)))
    ranked = global_rank(df, [time_col, tiebreak], name="_r")
    return (ranked.withColumn(name, F.when(F.col("_r") <= c1, "train")
                                     .when(F.col("_r") <= c2, "val").otherwise("test"))
                  .drop("_r"))


def lcg_hash(id_col, seed: int) -> Column:
    """(id * 48271 + seed) mod 2^31-1: a seeded integer hash both Spark and
    plain SQL compute identically (fixed values 48271 and 2147483647)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(c.cast("long") * F.lit(48271) + F.lit(seed), F.lit(2147483647))


def seeded_hash(id_col, seed: int, kind: str = "xxhash") -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    if kind == "lcg":
        return lcg_hash(c, seed)
    return F.xxhash64(c, F.lit(seed))


# D3
def seeded_sample(df: DataFrame, n: int = 5000, seed: int = 42, id_col: str = "order_id",
                  kind: str = "xxhash") -> DataFrame:
    """Exactly min(n, rows) rows, reproducible: the n smallest seeded hashes
    (top-n per partition, then one merge of n rows per partition)."""
    h = seeded_hash(id_col, seed, kind)
    return df.withColumn("_h", h).orderBy("_h", id_col).limit(n).drop("_h")


# D4
def stratified_folds(df: DataFrame, label: str, k: int = 5, seed: int = 42,
                     id_col: str = "order_id", name: str = "fold", kind: str = "xxhash") -> DataFrame:
    """Fold = position within class (seeded-hash order) mod k, so every fold
    holds each class's rows to within one."""
    h = seeded_hash(id_col, seed, kind)
    ranked = global_rank(df.withColumn("_h", h), [label, "_h", id_col], name="_r")
    starts = ranked.groupBy(label).agg(F.min("_r").alias("_s"))  # one row per label value
    return (ranked.join(F.broadcast(starts), label)
                  .withColumn(name, ((F.col("_r") - F.col("_s")) % k).cast("int"))
                  .drop("_h", "_r", "_s"))


# D5
def top_k(df: DataFrame, by, k: int, ascending: bool = False, tiebreak: list[str] | None = None) -> DataFrame:
    """The k first rows by ``by`` (TakeOrdered: top-k per partition, then merge)."""
    col = F.col(by) if isinstance(by, str) else by
    order = [col.asc() if ascending else col.desc()] + [F.col(t).asc() for t in (tiebreak or [])]
    return df.orderBy(*order).limit(k)


# D6
def cumulative_share(df: DataFrame, value: str, order: list, thresholds=(0.90, 0.95)) -> DataFrame:
    """Running share of ``value`` under ``order`` plus, per threshold, the
    1-based index of the first row reaching it. For small frames (one row
    per feature / component / category)."""
    w = Window.orderBy(*_sort_cols(_spec(order))).rowsBetween(Window.unboundedPreceding, 0)
    total = df.agg(F.sum(value)).scalar()
    out = df.withColumn("share", F.col(value) / total)
    out = out.withColumn("cum_share", F.sum("share").over(w))
    out = out.withColumn("idx", F.row_number().over(Window.orderBy(*_sort_cols(_spec(order)))))
    for t in thresholds:
        first = out.agg(F.min(F.when(F.col("cum_share") >= F.lit(t), F.col("idx")))).scalar()
        out = out.withColumn(f"first_at_{int(round(t * 100))}", first)
    return out


# D7
def step_delta(df: DataFrame, value: str, step: str) -> DataFrame:
    """Value minus the previous step's value; flag the largest gain
    (first on ties). Small frames (one row per step)."""
    w = Window.orderBy(step)
    out = df.withColumn("delta", F.col(value) - F.lag(value).over(w))
    best = out.agg(F.min_by(F.col(step), F.when(F.col("delta").isNotNull(),
                                                F.struct(-F.col("delta"), F.col(step))))).scalar()
    return out.withColumn("is_largest_gain", (F.col(step) == best).cast("int"))


def group_rank(df: DataFrame, by: list[str], order, name: str = "rank",
               n_buckets: int | None = None, few: bool = False) -> DataFrame:
    """1-based position within each ``by`` group under ``order``, without a
    window per group (a hot group is spread over many ranges): one global
    rank over (by, order), minus the group's first position. ``few`` groups
    (classes, models) have their first positions broadcast: by a shuffle, a
    group would be a task."""
    ranked = global_rank(df, [*by, *_spec(order)], name="_gr", n_buckets=n_buckets)
    # one row per group; unless they are few, the number of groups is not
    # bounded here, so the join strategy is left to AQE
    starts = ranked.groupBy(*by).agg(F.min("_gr").alias("_gs"))
    return (ranked.join(F.broadcast(starts) if few else starts, by, "left")
                  .withColumn(name, F.col("_gr") - F.col("_gs") + 1)
                  .drop("_gr", "_gs"))
