"""Exact quantiles by group against sorted lists."""

from __future__ import annotations

import math
import random

import pytest

from granary.operators import grouped_quantiles as gq


def plain(values, share):
    at = (len(values) - 1) * share
    low = math.floor(at)
    a, b = values[low], values[min(low + 1, len(values) - 1)]
    return a if a == b or at == low else a + (b - a) * (at - low)


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(4)
    made = [("spread", 1, draw.gauss(0, 1e6)) for _ in range(6000)]
    made += [("two", 1, float(draw.random() < 0.5)) for _ in range(3000)]
    made += [("ties", None, float(draw.choice([1, 1, 1, 2, 3]))) for _ in range(3000)]
    made += [("one", 2, 5.0), ("few", 2, 1.0), ("few", 2, 4.0), (None, 3, 7.0), (None, 3, -7.0), ("none", 1, None), ("nan", 1, float("nan"))]
    made += [(f"g{i % 40}", 9, draw.expovariate(1) ** 6) for i in range(4000)] + [("ends", 1, x) for x in (float("inf"), -float("inf"), 1.0, 2.0)]
    return made, spark.createDataFrame(made, "k string, y int, x double").repartition(4).cache()


@pytest.mark.parametrize("few_rows", [10, 500, 100_000])
def test_quantiles_of_groups(rows, few_rows):
    made, df = rows
    shares = {"least": 0.0, "q1": 0.25, "median": 0.5, "p99": 0.99, "most": 1.0}
    by = {}
    for k, y, x in made:
        if x is not None and not math.isnan(x):
            by.setdefault((k, y), []).append(x)
    got = {(r.k, r.y): r for r in gq.grouped_quantiles(df, ["k", "y"], "x", shares, few_rows).collect()}
    assert set(got) == set(by)
    for key, values in by.items():
        values.sort()
        assert got[key].n == len(values)
        for name, share in shares.items():
            want = plain(values, share)
            assert str(got[key][name]) == str(want) or math.isclose(got[key][name], want, rel_tol=1e-12), (key, name)


def test_without_groups_and_without_rows(spark, rows):
    df = spark.range(1001).selectExpr("cast(id as double) as x")
    assert tuple(gq.grouped_quantiles(df, [], "x", few_rows=20).first()) == (1001, 250.0, 500.0, 750.0)
    assert gq.grouped_quantiles(rows[1].where("false"), ["k"], "x").count() == 0


def test_sketches_are_kept_and_rolled_up(rows):
    parts = gq.quantile_sketches(rows[1].where("k like 'g%'"), ["k"], "x")
    assert parts.count() == 40
    whole = gq.sketched_quantiles(gq.merged_sketches(parts, []), {"median": 0.5}).first()
    values = sorted(x for k, _, x in rows[0] if k and k.startswith("g") and k != "g")
    assert whole.n == 4000 and values[1900] <= whole.median <= values[2100]


def test_a_wrong_proposal_is_noticed(spark, rows, monkeypatch):
    """Pivots far from the wanted rank: the counts tell, and all rows are looked at again."""
    honest, calls = gq._pivots, []

    def wrong_at_first(n, first, second):
        calls.append(1)
        return honest(n, n - 1, n - 1) if len(calls) <= 3 else honest(n, first, second)

    monkeypatch.setattr(gq, "_pivots", wrong_at_first)
    df = spark.range(5000).selectExpr("1 as k", "cast(id as double) as x")
    assert tuple(gq.grouped_quantiles(df, ["k"], "x", few_rows=50).first())[1:] == (5000, 1249.75, 2499.5, 3749.25)
