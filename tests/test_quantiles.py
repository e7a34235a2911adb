"""Quantiles by narrowing histograms against numpy."""

import math
import random
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rebuy.operators import profile as P
from rebuy.operators.quantiles import order_key

QS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, math.nextafter(2.0 ** -1022, 0), 1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2),
         8.0, math.nextafter(8.0, 0), 2.0 ** 1023, math.nextafter(2.0 ** 1023, 0), 1.7976931348623157e308, math.inf, -math.inf, -1.0, -3.5]


def bits(x):
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def test_key_is_the_binary_form(spark):
    r = random.Random(3)
    xs = EDGES + [s * math.nextafter(2.0 ** e, d) for e in range(-1074, 1024, 7) for s in (1, -1) for d in (0, math.inf)]
    xs += [struct.unpack("<d", struct.pack("<Q", r.getrandbits(64)))[0] for _ in range(5000)]
    xs = [x for x in xs if not math.isnan(x)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", order_key(F.col("x")).alias("k"))
    assert all(row.k == bits(row.x) for row in df.collect())


def test_groups_narrow_together(spark):
    r = random.Random(4)
    rows = [("a", r.gauss(0, 1e-3) * 10 ** r.randint(-9, 9)) for _ in range(3000)] + [("b", float(r.randint(-2, 2))) for _ in range(500)]
    rows += [(None, r.random()) for _ in range(7)] + [("one", 3.5), ("none", None), ("none", float("nan")), ("a", None), ("a", float("nan"))]
    got = P.exact_quantiles(spark.createDataFrame(rows, "feature string, value double"), ["feature"], QS, narrow=True).collect()
    assert {x.feature for x in got} == {"a", "b", None, "one"} and len(got) == 4 * len(QS)
    for x in got:
        own = [v for f, v in rows if f == x.feature and v is not None and not math.isnan(v)]
        assert x.quantile == pytest.approx(float(np.quantile(own, x.q)), rel=1e-12, abs=1e-300)


def test_infinite_neighbours_and_no_rows(spark):
    df = spark.createDataFrame([(x,) for x in EDGES], "value double").withColumn("g", F.lit(1))
    got = P.quantile_columns(df, ["g"], {"low": 0.0, "high": 1.0, "mid": 0.5}, narrow=True).first()
    assert got.low == -math.inf and got.high == math.inf and got.mid == float(np.sort(EDGES)[8:10].mean())
    assert P.quantile_columns(df.limit(0), ["g"], {"m": 0.5}, narrow=True).count() == 0


@settings(max_examples=4, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=40))
def test_any_values(spark, xs):
    df = spark.createDataFrame([("g", x) for x in xs], "feature string, value double")
    got = P.quantile_columns(df, ["feature"], {"m": 0.5, "q": 0.3}, narrow=True).first()
    assert got.m == pytest.approx(float(np.quantile(xs, 0.5)), rel=1e-9, abs=1e-30)
    assert got.q == pytest.approx(float(np.quantile(xs, 0.3)), rel=1e-9, abs=1e-30)
