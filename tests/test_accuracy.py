from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from granary.functions.scoring import quality_fraction, rating
from granary.operators import accuracy as acc


@pytest.fixture
def judged(spark):
    def make(pairs):
        return acc.with_errors(spark.createDataFrame([(float(a), float(p)) for a, p in pairs], "actual double, predicted double"))

    return make


def test_zero_actual_has_no_percentage(judged):
    got = judged([(0, 5), (100, 95)]).collect()
    assert [(r.error, r.error_pct) for r in got] == [(5.0, None), (-5.0, 5.0)]


def test_bands_are_half_open_and_empty_ones_stay(judged):
    got = acc.error_bands(judged([(100, 105), (100, 110), (100, 120), (100, 100), (0, 1)])).collect()
    assert [r.n for r in got] == [1, 1, 1, 1]
    assert [r.pct for r in got] == [20.0] * 4
    assert [r.n for r in acc.error_bands(judged([(100, 100)])).collect()] == [1, 0, 0, 0]


@pytest.mark.parametrize("actuals", [list(range(1, 40)) + [100], [7, 7, 7], [0, 50, 50.0001, 100]])
def test_ranges_like_pandas_cut(judged, actuals):
    labels = ["Very Low", "Low", "Medium", "High", "Very High"]
    frame = pd.DataFrame({"actual": [float(a) for a in actuals]})
    frame["e"] = (frame.actual * 1.07 + 3 - frame.actual).abs() / frame.actual.replace(0, np.nan) * 100
    cut = pd.cut(frame.actual, bins=5, labels=labels)
    expected = frame.groupby(cut, observed=False).agg(n=("e", "count"), lo=("actual", "min"), m=("e", "mean")).round(2)
    got = acc.error_by_range(judged([(a, a * 1.07 + 3) for a in actuals])).orderBy("range").collect()
    assert [r.label for r in got] == labels
    assert [r.n for r in got] == expected.n.tolist()
    for r, lo, m in zip(got, expected.lo, expected.m):
        assert (r.actual_min is None and np.isnan(lo)) or r.actual_min == pytest.approx(lo, abs=0.011)
        assert (r.error_mean is None and np.isnan(m)) or r.error_mean == pytest.approx(m, abs=0.011)


def test_metrics_and_constant_actual(judged):
    pairs = [(1, 2), (2, 2), (4, 3), (9, 11)]
    a, p = np.array(pairs, dtype=float).T
    got = acc.regression_metrics(judged(pairs)).first()
    assert got.rmse == pytest.approx(np.sqrt(((p - a) ** 2).mean()))
    assert got.mae == pytest.approx(np.abs(p - a).mean())
    assert got.r2 == pytest.approx(1 - ((p - a) ** 2).sum() / ((a - a.mean()) ** 2).sum())
    assert acc.regression_metrics(judged([(5, 4), (5, 6)])).first().r2 is None


def test_best_and_worst_take_the_first_key_on_ties(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("d", 9.0), ("c", 9.0), ("e", None)], "k string, error_pct double")
    assert [tuple(r) for r in acc.best_and_worst(df, "k").collect()] == [("best", "a", 1.0), ("worst", "c", 9.0)]


def test_top_errors_break_ties_by_shown_columns(spark):
    df = spark.createDataFrame([(k, 5.0 if k < 30 else 1.0) for k in range(40)] + [(99, None)], "k int, error_pct double")
    assert [r.k for r in acc.extreme_predictions(df, ["k"]).collect()] == list(range(10))
    assert [r.k for r in acc.extreme_predictions(df, ["k"], worst=False).collect()] == list(range(30, 40))


def test_rating_and_quality(spark):
    df = spark.createDataFrame([(0.95,), (0.9,), (0.75,), (0.1,), (None,)], "r double")
    assert [r[0] for r in df.select(rating("r")).collect()] == ["Excellent", "Good", "Fair", "Poor", None]
    df = spark.createDataFrame([(1.0, 0.0), (None, None), (2.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(quality_fraction(["a", "b"])).collect()] == [0.5, 0.0, 1.0]
    assert df.select(quality_fraction([])).first()[0] == 1.0


def test_distribution_like_pandas(judged):
    pairs = [(100, 100 + i * i) for i in range(31)]
    e = pd.Series([float(i * i) for i in range(31)])
    got = acc.error_distribution(judged(pairs)).first()
    assert (got.n, got.median) == (31, e.median())
    assert got["mean"] == pytest.approx(e.mean()) and got["std"] == pytest.approx(e.std())
    assert got.plus_1_std == pytest.approx(e.mean() + e.std())


def test_best_model_ignores_missing_r2(spark):
    df = spark.createDataFrame([("x", None), ("b", 0.5), ("a", 0.5)], "model string, r2 double")
    assert acc.best_model(df).first().model == "a"
