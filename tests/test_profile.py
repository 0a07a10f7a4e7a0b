from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.functions.aggregates import Measure
from granary.operators import profile
from granary.operators.quantiles import exact_quantile


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, 7.0)], "a double, b double, c double")
    got = {(r.row, r.col): r.r for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] is None and got["b", "b"] is None
    assert got["a", "c"] == got["c", "a"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])
    assert profile.linear_trend(df, "b", "a").first().slope is None
    line = profile.linear_trend(df, "a", "c").first()
    assert np.allclose([line.slope, line.intercept], np.polyfit([1, 2, 3], [2, 4, 7], 1))


def test_correlation_uses_pairwise_complete_rows(spark):
    rows = [(1.0, 2.0), (2.0, None), (None, 9.0), (4.0, 1.0), (5.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    r = profile.feature_target_correlation(df, ["a"], "b").first().r
    assert r == pytest.approx(np.corrcoef([1, 4, 5], [2, 1, 7])[0, 1])


@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_like_numpy(spark, bins):
    values = [random.Random(3).gauss(10, 4) for _ in range(500)] + [100.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    n, edges = np.histogram(values, bins)
    got = profile.histogram(df, "x", bins, density=True).orderBy("bin").collect()
    assert [r.n for r in got] == n.tolist()
    assert np.allclose([r.lower for r in got], edges[:-1]) and np.allclose([r.upper for r in got], edges[1:])
    assert np.allclose([r.density for r in got], np.histogram(values, bins, density=True)[0])


def test_histogram_of_a_constant_and_of_nothing(spark):
    got = profile.histogram(spark.createDataFrame([(3.0,)] * 4, "x double"), "x", 4).orderBy("bin").collect()
    assert [r.n for r in got] == np.histogram([3.0] * 4, 4)[0].tolist()
    assert (got[0].lower, got[-1].upper) == (2.5, 3.5)
    empty = profile.histogram(spark.createDataFrame([], "x double"), "x", 3).collect()
    assert [r.n for r in empty] == [0, 0, 0]


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("few", [1, 50])
def test_exact_quantile_by_narrowing(spark, share, few):
    rng = random.Random(int(share * 100))
    values = [rng.choice([0.0, 1.0, rng.random() * 1e9, rng.gauss(0, 1), -5.0]) for _ in range(701)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    assert exact_quantile(df, "x", share, few) == pytest.approx(float(np.quantile(values, share)), rel=1e-12)


@pytest.mark.parametrize("share, want", [(0.0, -np.inf), (0.25, 1.5), (0.5, 3.0), (0.9, np.inf), (1.0, np.inf)])
def test_infinities_keep_their_place(spark, share, want):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in [-inf, 1.0, 2.0, 3.0, inf, inf, inf]], "x double")
    assert exact_quantile(df, "x", share) == want
    assert exact_quantile(df.where("x > 3"), "x", 0.5) == inf


@pytest.mark.parametrize("values, median", [([4.0], 4.0), ([1.0, 2.0], 1.5), ([2.0] * 9 + [3.0] * 9, 2.5), ([], None)])
def test_exact_median_of_few(spark, values, median):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for few in (1, 1000):
        assert exact_quantile(df, "x", 0.5, few) == median


def test_describe_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 4.0)], "a int, b double")
    got = {r.column: r for r in profile.describe_numeric(df, ["a", "b"]).collect()}
    assert (got["a"].n, got["a"].stddev, got["b"].stddev) == (1, None, pytest.approx(2**0.5))
    assert {r.column: r.n_nulls for r in profile.null_counts(df).collect()} == {"a": 1, "b": 0}
    kinds = [(r.ordinal, r.column, r.type, r.n_rows) for r in profile.schema_profile(df).collect()]
    assert kinds == [(1, "a", "int", 2), (2, "b", "double", 2)]


def test_growth(spark):
    df = spark.createDataFrame([(1993, 40.0), (1993, 60.0), (2000, 1.0), (2021, 110.0)], "y int, v double")
    got = profile.growth_rate(df, "y", Measure("total", "v", "sum", None)).first()
    assert (got.first_year, got.last_year, got.first_total, got.last_total) == (1993, 2021, 100.0, 110.0)
    assert got.growth_pct == pytest.approx((1.1 ** (1 / 28) - 1) * 100)
    assert profile.growth_rate(df.where("y = 2000"), "y", Measure("total", "v", "sum", None)).first().growth_pct is None


def test_volumes(spark):
    got = [tuple(r) for r in profile.volume_summary(spark.range(4), spark.range(10)).collect()]
    assert got == [("real", 4, 1.0), ("synthetic", 10, 2.5), ("combined", 14, 3.5)]
    assert profile.distinct_counts(spark.range(4).withColumn("n", F.lit(None).cast("int")), ["id", "n"]).collect()[1][1] == 0


def test_correlations_of_two_hundred_columns(spark):
    """Large means, gaps of their own, a constant and an empty column; a sample of pairs against the pairwise operator."""
    names = [f"c{i}" for i in range(200)]
    value = lambda i: F.lit(1e6 * i) + F.pmod(F.xxhash64("id", F.lit(i % 150)), F.lit(1000)) / 7.0
    columns = [F.when(F.col("id") % (i + 5) != 0, value(i)).alias(n) for i, n in enumerate(names[:-2])]
    df = spark.range(3000).repartition(4).select(*columns, F.lit(3.0).alias("c198"), F.lit(None).cast("double").alias("c199")).cache()
    found = {(r.row, r.col): r.r for r in profile.wide_correlations(df, names).collect()}
    assert len(found) == 40_000
    some = ["c0", "c3", "c20", "c150", "c153", "c199"]
    for r in profile.correlation_matrix(df, some).collect():
        got = found[r.row, r.col]
        assert (got is None) == (r.r is None) and (got is None or abs(got - r.r) < 1e-9), r
    assert abs(found["c0", "c150"] - 1) < 1e-9 and found["c198", "c0"] is None and found["c198", "c198"] is None
