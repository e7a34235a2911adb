"""Registry of named queries: each has a Spark plan and, where SQL can say
the same thing, a DuckDB oracle text over the driver's base tables.

Doubles are rounded to ``DIGITS`` significant digits on both sides so that
summation order does not decide the comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.retail import VIEW_SQL

DIGITS = 10


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)


REGISTRY: dict[str, Query] = {}


def round_sig(c, digits: int = DIGITS):
    """Round to ``digits`` significant digits; NaN and ±inf become NULL."""
    c = c.cast("double")
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))))
    finite = ~F.isnan(c) & (F.abs(c) != float("inf"))
    return (F.when(finite & (c == 0), F.lit(0.0))
             .when(finite, F.round(c / scale, digits - 1) * scale))


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double/float column to significant digits."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_sig(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def round_sig_sql(c: str, digits: int = DIGITS) -> str:
    x = f"CAST({c} AS DOUBLE)"
    scale = f"pow(10.0, floor(log10(abs({x}))))"
    return (f"CASE WHEN NOT isfinite({x}) THEN NULL WHEN {x} = 0 THEN 0.0 "
            f"ELSE round({x} / {scale}, {digits - 1}) * {scale} END")


def register(name: str, sql: str | None = None, doubles: list[str] | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        def run(spark, sf_dir, _fn=fn):
            return round_doubles(_fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, run, sql, list(doubles or []))
        return fn
    return deco


# --- SQL assembly ----------------------------------------------------------

def views(*names: str) -> list[tuple[str, str]]:
    return [(f"v_{n}", VIEW_SQL[n]) for n in names]


def build_sql(parts: list[tuple[str, str]], body: str, doubles: list[str] | None = None) -> str:
    seen, uniq = set(), []
    for n, s in parts:
        if n not in seen:
            seen.add(n)
            uniq.append((n, s))
    head = ("WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in uniq) + "\n") if uniq else ""
    if doubles:
        rep = ", ".join(f"{round_sig_sql(c)} AS {c}" for c in doubles)
        return f"{head}SELECT * REPLACE ({rep}) FROM (\n{body}\n) _q"
    return head + body


_MEMO: dict = {}


def materialized(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` written as Parquet under the session's checkpoint folder
    (later scans read only their columns), once per (application, data
    folder, name)."""
    from ..session import materialize
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _MEMO:
        _MEMO[key] = materialize(build(), name)
    return _MEMO[key]
