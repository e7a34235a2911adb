"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with rate ``r = target / size of the source`` is taken
``floor(r)`` times for sure and once more with probability ``r - floor(r)``.
The fractions are rounded together: two fractional documents of a source are
paired and probability mass, weighed by document size, moves from one to the
other (in a random direction whose odds keep both expectations) until one of
them is 0 or 1. So the words taken of a source always differ from its target
by less than one document, and each document keeps its own probability.

The pairing runs as a reduction tree: leaves of about ``fan_in`` documents of
like size (same power of two) fold to one fractional residual each, and
residuals fold again at the next level. Leaves are dealt by row hash, so a hot
source spreads over all tasks; the number of levels grows with the logarithm
of the largest class. The last fold of a source takes the residuals of its
classes and about ``reserve`` documents held back of each class, largest
first. So what is left to round by its own probability is one of the smallest
documents. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, written


def word_count(text: Column) -> Column:
    """Words of a text; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weight: str = "weight", cap: float = 3.0) -> DataFrame:
    """Targets that share the sum of ``source_size`` by ``weight``, none above
    ``cap`` times its source's size; the excess is shared again by weight.

    ``sizes`` has one row a source. Each round moves two sums to the driver;
    a round that caps no further source is the last. Null, zero or negative
    weights get a target of 0. Adds ``target`` (double).
    """
    w = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    limit = F.col("source_size") * F.lit(float(cap))
    total = sizes.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level, capped = 0.0, -1
    while True:
        full = w * F.lit(level) >= limit
        row = sizes.agg(F.sum(F.when(full, limit)).alias("held"),
                        F.sum(F.when(~full, w)).alias("free"),
                        F.count(F.when(full & (limit > 0), 1)).alias("n")).first()
        if not row["free"] or row["n"] == capped:
            break
        capped, level = row["n"], max(level, (total - (row["held"] or 0.0)) / row["free"])
    return sizes.withColumn("target", F.least(w * F.lit(level), limit))


def _uniform(seed: int, *cols) -> Column:
    """A number in (0, 1) fixed by the columns."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double") + 0.5) * F.lit(2.0 ** -53)


def _fold(items: Column, item_type: str, seed: int, level: int) -> Column:
    """Fold an array of fractional items; struct(done, rest): the items that
    became 0 or 1 (in ``p``) and the one that is left, null if none."""
    eps = F.lit(1e-12)
    start = F.struct(F.lit(None).cast(item_type).alias("rest"), F.array().cast(f"array<{item_type}>").alias("done"))

    def with_p(x, p):
        return F.struct(x["size"].alias("size"), x["h"].alias("h"), p.alias("p"), x["row"].alias("row"))

    def step(acc, b):
        a = acc["rest"]
        # In words: what a can take from b until a is 1 or b is 0, and what
        # b can take from a.
        up = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])
        down = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])
        move = F.when(_uniform(seed, F.lit(level), a["h"], b["h"]) * (up + down) < down, up).otherwise(-down)
        pa, pb = a["p"] + move / a["size"], b["p"] - move / b["size"]

        def whole(p):
            return (p < eps) | (p > 1 - eps)

        na, nb = with_p(a, F.when(pa < eps, 0.0).when(pa > 1 - eps, 1.0).otherwise(pa)), \
            with_p(b, F.when(pb < eps, 0.0).when(pb > 1 - eps, 1.0).otherwise(pb))
        null = F.lit(None).cast(item_type)
        pair = (F.when(whole(pa) & whole(pb), F.struct(null.alias("rest"), F.concat(acc["done"], F.array(na, nb)).alias("done")))
                .when(whole(pa), F.struct(nb.alias("rest"), F.concat(acc["done"], F.array(na)).alias("done")))
                .otherwise(F.struct(na.alias("rest"), F.concat(acc["done"], F.array(nb)).alias("done"))))
        return F.when(a.isNull(), F.struct(b.alias("rest"), acc["done"].alias("done"))).otherwise(pair)

    return F.aggregate(items, start, step)


def mix(docs: DataFrame, weights: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """Struct ``row`` (all columns of ``docs``) and ``copies`` of the documents
    that a mix takes, whose size is the words of their text; the options and
    cases are those of ``mix_sizes``.

    Rows are rounded by a 96-bit key and their text is moved once, to meet
    their copies. Rows equal in every column come as one row with the copies
    of all; rows that aren't taken don't come.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.struct(F.xxhash64(row).alias("a"), F.hash(row).alias("b")).alias("key"))
    source = options.pop("source_col", "source")
    sizes = rows.select("key", F.col("row")[source].alias("source"), word_count(F.col("row")[text_col]).alias("size"))
    taken = totals(sizes, weights, **options).where("total > 0").select(F.col("row.key").alias("_key"), F.col("total").alias("copies"))
    return rows.join(taken, F.col("key") == F.col("_key")).dropDuplicates(["key"]).select("row", "copies")


def mix_sizes(docs: DataFrame, weights: DataFrame, **options) -> DataFrame:
    """``totals`` by row of ``docs``: struct ``row``, ``size``,
    ``source_size``, ``target`` and ``copies``, at most ``ceil(cap)`` each.
    Equal rows share their copies evenly."""
    # The k copies due to `times` equal rows: the first k mod times get one more.
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return (totals(docs, weights, **options).withColumn("i", each)
            .select("row", "size", "source_size", "target",
                    (F.floor(F.col("total") / F.col("times"))
                     + (F.col("i") <= F.col("total") % F.col("times")).cast("long")).cast("long").alias("copies")))


def totals(docs: DataFrame, weights: DataFrame, size_col: str = "size", source_col: str = "source",
           cap: float = 3.0, seed: int = 17, fan_in: int = 32, reserve: int = 24) -> DataFrame:
    """Copies of each distinct row of ``docs`` that make up the mix.

    ``weights`` has ``source`` and ``weight``, one row a source (a source it
    lacks weighs 0). Returns struct ``row`` (all columns of ``docs``, so names
    cannot clash), ``times`` it comes, ``size``, ``source_size``, ``target``
    and ``total`` (copies of all its ``times``). Rows of size 0 (null or blank
    text) count for nothing and are taken once if their source's target is
    positive. A null source is a source of its own; a null size is 0. Rows
    equal in every column are counted first, so they cannot crowd one leaf.
    An empty table gives an empty mix. The same input gives the same mix.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    size = F.coalesce(F.col("row")[size_col], F.lit(0)).cast("long")
    # Written: sizes are counted once, whatever reads them below.
    rows = written(rows.groupBy("row").agg(F.count(F.lit(1)).alias("times")).withColumn("size", size), "mix-rows", compression="zstd")
    by_source = written(
        rows.groupBy(F.col("row")[source_col].alias("source")).agg(F.sum(F.col("size") * F.col("times")).alias("source_size")), "mix-sources")
    shares = by_source.join(weights.select(F.col("source").alias("_s"), "weight"),
                            F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    shares = written(targets(shares, cap=cap), "mix-targets")
    # One row a source and size class.
    rows = rows.withColumn("class", F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int"))
    classes = written(rows.groupBy(F.col("row")[source_col].alias("_s"), F.col("class").alias("_c")).agg(F.count(F.lit(1)).alias("n")), "mix-classes")
    most = classes.agg(F.max("n").alias("n")).first()["n"] or 0
    t = classes.join(shares.select("source", "source_size", "target"), F.col("_s").eqNullSafe(F.col("source"))).drop("source")
    rows = rows.join(t, rows["row"][source_col].eqNullSafe(F.col("_s")) & (F.col("class") == F.col("_c"))).drop("_s", "_c")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (rows.withColumn("rate", rate)
            .withColumn("due", F.when(F.col("size") > 0, F.col("rate") * F.col("times"))
                        .otherwise(F.when(F.col("rate") > 0, F.col("times").cast("double")).otherwise(0.0)))
            .withColumn("sure", F.floor(F.col("due") + 1e-9)))
    keep = F.struct(F.col("row"), F.col("size"), F.col("times"), F.col("sure"), F.col("source_size"), F.col("target"))
    level = rows.select(
        F.col("row")[source_col].alias("s"), "class", F.xxhash64(F.col("row")).alias("h"), F.col("n"), F.col("size"),
        F.greatest(F.col("due") - F.col("sure"), F.lit(0.0)).alias("p"), keep.alias("row"))
    sure = F.col("p") <= 1e-9
    parts = [level.where(sure).select("row", F.lit(0).alias("extra"))]
    level = level.where(~sure)
    held = F.col("n") * _uniform(seed, F.lit(-2), F.col("h")) < reserve
    last = level.where(held).select("s", "size", "h", "p", "row")
    # Leaves hold fan_in / 2 rows on average: hashing fills them unevenly.
    leaves = F.greatest(F.lit(1), F.ceil(F.col("n") * 2 / F.lit(fan_in))).cast("long")
    level = level.where(~held).withColumn("n", leaves).withColumn("leaf", F.expr("pmod(h, n)"))

    def folded(groups: DataFrame, *key: str) -> DataFrame:
        """One level of the tree, written so that no later level repeats it.
        Largest first: what is left then is a small document."""
        item = T.StructType([groups.schema[c] for c in ("size", "h", "p", "row")]).simpleString()
        items = F.sort_array(F.collect_list(F.struct("size", "h", "p", "row")), asc=False)
        out = written(groups.groupBy(*key).agg(items.alias("items")).select(*key, _fold(F.col("items"), item, seed, k).alias("f")), "mix-level")
        parts.append(out.select(F.explode("f.done").alias("x")).select("x.row", F.round("x.p").cast("int").alias("extra")))
        return out.where("f.rest is not null").select(*key, "f.rest.size", "f.rest.h", "f.rest.p", "f.rest.row")

    most, k = math.ceil(most * 2 / fan_in), 0
    while most >= 1:
        level = folded(level, "s", "class", "n", "leaf")
        if most == 1:
            break
        level = level.withColumn("n", F.ceil(F.col("n") / fan_in)).withColumn("leaf", F.floor(F.col("leaf") / fan_in))
        most, k = math.ceil(most / fan_in), k + 1
    k += 1
    level = folded(last.unionByName(level.select("s", "size", "h", "p", "row")), "s")
    last = (_uniform(seed, F.lit(-1), F.col("h")) < F.col("p")).cast("int")
    parts.append(level.select("row", last.alias("extra")))
    taken = reduce(DataFrame.unionAll, parts)
    return taken.select("row.*", (F.col("row.sure") + F.col("extra")).alias("total"))


def pattern_weights(docs: DataFrame, source_col: str = "source", pattern=(5, 2, 1)) -> DataFrame:
    """Weights that repeat ``pattern`` over the sources in code point order,
    null last. One row a source is numbered, never one a document."""
    s = docs.select(F.col(f"`{source_col}`").alias("source")).distinct()
    i = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return s.select("source", F.element_at(F.array(*[F.lit(float(p)) for p in pattern]),
                                           (i % len(pattern) + 1).cast("int")).alias("weight"))
