"""Exact quantiles by narrowing histograms.

A double is mapped to a whole number that orders like it: the 64 bits of its
binary form, negative for negative values. The number is read in four digits of
16 bits. The first pass counts the values of each group by their first digit,
which gives the group's size and, for each wanted position, the digit that holds
it and the values before that digit. Each later pass counts the next digit, only
over values that agree with a wanted position in all digits so far. The fourth
digit leaves one value.

All groups and positions narrow together, in four scans whatever the values are.
A scan shuffles at most 65,536 counts a task and wanted prefix; values are neither
sorted nor ranked, and a value that fills a column is one count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Bits of a digit, and digits of a number.
DIGIT, DIGITS = 16, 4


def order_key(x: Column) -> Column:
    """A long that orders like the double ``x`` (not NaN); 0.0 and -0.0 are equal.

    Exponent and mantissa come from arithmetic that is exact for doubles:
    products with powers of two, the largest power first found by a logarithm
    and then corrected by one."""
    a = F.abs(x)
    low, high = F.lit(-1022), F.lit(1023)
    guess = F.greatest(low, F.least(high, F.floor(F.least(F.coalesce(F.log2(a), F.lit(-1022.0)), F.lit(1023.0))).cast("int")))
    two = F.lit(2.0)
    power = F.greatest(low, F.least(high, F.when(a < F.pow(two, guess), guess - 1).when(a / F.pow(two, guess) >= 2, guess + 1).otherwise(guess)))
    bits = F.when(a == F.lit(float("inf")), F.lit(2047 << 52)).otherwise(
        (power + 1022).cast("long") * F.lit(1 << 52) + (a / F.pow(two, power) * float(1 << 52)).cast("long"))
    return F.when(x < 0, -bits).otherwise(bits)


def _same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_w_{c}"]) for c in cols])


def _wanted(rows: DataFrame, cols: list[str]) -> DataFrame:
    """``rows`` with ``cols`` renamed for a join; a null in a key equals a null."""
    return rows.withColumnsRenamed({c: f"_w_{c}" for c in cols})


def at_positions(data: DataFrame, keys: list[str], qs: list[float], value: str) -> DataFrame:
    """Per group and share of ``qs`` (index ``_i``): position ``_at`` =
    q * (n - 1) and the values ``_lo`` and ``_hi`` at its floor and ceiling.
    Null keys are a group; ``data`` has no null and no NaN in ``value``."""
    x = F.col(value).cast("double")
    data = data.select(*keys, x.alias("_x")).withColumn("_key", order_key(F.col("_x")))
    digit = lambda p: F.shiftright("_key", 64 - DIGIT * (p + 1))  # noqa: E731  all digits up to p
    wanted = None
    for p in range(DIGITS):
        groups = keys if p == 0 else [*keys, "_prefix"]
        rows = data.withColumn("_digit", digit(p))
        if wanted is not None:
            rows = rows.withColumn("_prefix", digit(p - 1))
            some = _wanted(wanted.select(*groups).distinct(), groups)
            rows = rows.join(some, _same(rows, some, groups), "left_semi")
        counts = rows.groupBy(*groups, "_digit").agg(F.count(F.lit(1)).alias("_c"), F.max("_x").alias("_v"))
        # At most 65,536 counts a window.
        upto = Window.partitionBy(*groups).orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("_end", F.sum("_c").over(upto))
        if wanted is None:
            counts = counts.withColumn("_n", F.sum("_c").over(Window.partitionBy(*groups)))
            at = F.array(*[F.struct(F.lit(i).alias("_i"), (F.lit(float(q)) * (F.col("_n") - 1)).alias("_at")) for i, q in enumerate(qs)])
            one = counts.withColumn("_q", F.explode(at)).select("*", "_q._i", "_q._at")
            sides = F.array(*[F.struct(F.lit(s).alias("_side"), pos.cast("long").alias("_left"))
                              for s, pos in (("_lo", F.floor("_at")), ("_hi", F.ceil("_at")))])
            found = one.withColumn("_s", F.explode(sides)).select("*", "_s._side", "_s._left")
        else:
            ours = _wanted(wanted, groups)
            found = counts.join(ours, _same(counts, ours, groups)).select(*keys, "_digit", "_c", "_v", "_end", "_i", "_at", "_side", "_left")
        here = (F.col("_left") < F.col("_end")) & (F.col("_left") >= F.col("_end") - F.col("_c"))
        found = found.where(here).select(*keys, "_i", "_at", "_side", (F.col("_left") - (F.col("_end") - F.col("_c"))).alias("_left"),
                                         F.col("_digit").alias("_prefix"), F.col("_v"))
        if p == DIGITS - 1:
            return found.groupBy(*keys, "_i", "_at").agg(*[F.max(F.when(F.col("_side") == s, F.col("_v"))).alias(s) for s in ("_lo", "_hi")])
        # Written: two rows a group and share, whose size decides how the next scan joins them.
        wanted = materialize(found.drop("_v"), "brackets")
