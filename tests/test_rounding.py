"""Exact rounding helpers against Python / numpy semantics."""
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pluvio.functions.rounding import half_even_div, numpy_round1, py_round1


def _ties():
    # x.x5 values (exact-decimal ties whose binary value is above or below)
    return [k / 100 for k in range(-2005, 2006, 10)] + [0.25, 0.35, 2.675, 1.45, 1e6 + 0.05]


def test_py_round1_matches_python(spark):
    rnd = random.Random(7)
    xs = _ties() + [rnd.uniform(-1e4, 1e4) for _ in range(3000)] + [rnd.randint(-99999, 99999) / 100
                                                                    for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(py_round1("x")).collect()]
    for x, g in zip(xs, got):
        assert g == round(x, 1), (x, g, round(x, 1))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(min_value=-1e7, max_value=1e7, allow_nan=False), min_size=1, max_size=50))
def test_py_round1_property(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(py_round1("x")).collect()]
    assert got == [round(x, 1) for x in xs]


def test_numpy_round1(spark):
    xs = _ties() + [random.Random(3).uniform(-500, 500) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = np.array([r[0] for r in df.select(numpy_round1("x")).collect()])
    assert np.array_equal(got, np.round(np.array(xs), 1))


def test_half_even_div(spark):
    rnd = random.Random(11)
    pairs = [(rnd.randint(-10**12, 10**12), rnd.randint(1, 10**6)) for _ in range(2000)]
    pairs += [(n, d) for d in (2, 10, 20) for n in range(-45, 46)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(half_even_div(F.col("n"), F.col("d"))).collect()]
    from fractions import Fraction
    for (n, d), g in zip(pairs, got):
        assert g == round(Fraction(n, d)), (n, d, g)


def test_py_round1_large_magnitudes(spark):
    xs = [1e15 + 0.5, 4.6e15, 1e300, -(2.0 ** 50) - 0.25, 3.0e14 + 0.25, -1.2e14 - 0.35]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(py_round1("x")).collect()]
    assert got == [round(x, 1) for x in xs]


def test_one_decimal_sums_avoid_decimals_row_by_row(spark):
    """Whole tenths are summed as whole numbers; values of other forms as decimals, to the same total."""
    from pyspark.sql import functions as F

    from pluvio.functions.rounding import decimal1, decimal_sum1
    rows = [(1, 0.1), (1, 0.2), (1, 1e9), (2, None), (2, 0.3), (3, float("nan")), (3, 2.5), (4, 0.25), (4, 0.1), (4, -0.05), (5, None),
            (6, 1.25e11), (6, -0.1), (7, -0.0)]
    df = spark.createDataFrame(rows, "g int, x double")
    for poison in (True, False):
        missing = F.sum(F.when(F.col("x").isNull() | F.isnan("x"), 1).otherwise(0)) if poison else F.lit(0)
        out = df.groupBy("g").agg(decimal_sum1("x", poison).alias("got"),
                                  F.when(missing == 0, F.sum(decimal1("x")).cast("double")).alias("want")).collect()
        assert len(out) == 7 and all(r["got"] == r["want"] for r in out)
    plan = df.groupBy("g").agg(decimal_sum1("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "as bigint" in plan
