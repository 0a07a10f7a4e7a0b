"""Many generated cases per property, each batch in one Spark job."""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from granary.functions.cleaning import parse_number
from granary.operators import accuracy as acc
from granary.operators.profile import histogram
from granary.operators.quantiles import exact_quantile

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
NUMBERS = st.floats(allow_nan=False, allow_infinity=False, width=32)


def _expected(text: str, decimal: str, signed: bool) -> float | None:
    kept = re.sub(f"[^0-9.{',' if decimal == ',' else ''}{'-' if signed else ''}]", "", text)
    kept = kept.replace(",", ".")
    return float(kept) if re.fullmatch(r"-?([0-9]+\.?[0-9]*|\.[0-9]+)", kept) else None


@FEW
@given(st.lists(st.text(alphabet="0123456789.,- Rpx", max_size=9), min_size=20, max_size=200))
def test_parsing_follows_its_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = df.select(
        "t", parse_number("t").alias("dot"), parse_number("t", decimal=",", signed=False).alias("comma")
    ).collect()
    for row in got:
        assert row.dot == _expected(row.t, ".", True), row
        assert row.comma == _expected(row.t, ",", False), row


@FEW
@given(
    st.lists(st.one_of(NUMBERS, st.sampled_from([0.0, 1.0, -1.0, 1e300, -1e300, 5e-324])), min_size=1, max_size=80),
    st.sampled_from([0.0, 0.1, 0.5, 0.75, 1.0]),
    st.sampled_from([1, 3, 1000]),
)
def test_quantiles_are_exact(spark, values, share, few):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").coalesce(2)
    ordered = sorted(values)
    position = (len(values) - 1) * share
    low, high = ordered[math.floor(position)], ordered[math.ceil(position)]
    want = low + (high - low) * (position - math.floor(position))
    assert exact_quantile(df, "x", share, few) == pytest.approx(want, rel=1e-12, abs=1e-300)


@FEW
@given(st.lists(st.integers(1, 10_000), min_size=1, max_size=100))
def test_ranges_follow_the_cut_of_pandas(spark, actuals):
    df = spark.createDataFrame([(float(a), float(a) + 1) for a in actuals], "actual double, predicted double")
    got = [r.n for r in acc.error_by_range(acc.with_errors(df)).orderBy("range").collect()]
    assert got == pd.cut(pd.Series(actuals, dtype=float), 5).value_counts(sort=False).tolist()


@FEW
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=100), st.sampled_from([2, 10, 50]))
def test_histograms_follow_numpy(spark, values, bins):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = histogram(df, "x", bins).orderBy("bin").collect()
    assert sum(r.n for r in got) == len(values)
    edges = np.histogram_bin_edges(values, bins)
    assert np.allclose([r.lower for r in got] + [got[-1].upper], edges)
