from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from granary.functions.aggregates import Measure, exact_mean, exact_sum
from granary.operators import features, impute, joins
from granary.plans import silver


def test_group_means_fill_only_their_group(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("a", None, None), ("a", 3.0, None), ("b", None, 5.0), (None, None, 1.0), (None, 4.0, None)],
        "g string, x double, y double",
    )
    got = rows(impute.impute_group_mean(df, ["x", "y", "gone"], "g"))
    assert got == sorted(
        [("a", 1.0, None), ("a", 2.0, None), ("a", 3.0, None), ("b", None, 5.0), (None, 4.0, 1.0), (None, 4.0, 1.0)],
        key=repr,
    )


def test_score_may_judge_the_raw_values(spark):
    raw = spark.createDataFrame([("a", "1", "5"), ("a", "", "6"), ("b", "", "")], "code string, x string, y string")
    spec = dict(
        names={}, code="code", category="name", code_names={}, date=None, numeric=["x", "y"],
        score_on=["x", "y"], keep_if_any=["x", "y"],
    )
    for before, scores in ((False, [1.0, 1.0]), (True, [0.5, 1.0])):
        out = silver.clean_measurements(raw, silver.MeasurementSpec(**spec, score_before_fill=before))
        assert sorted(r.data_quality_score for r in out.collect()) == scores


def test_global_mean_and_all_null_column(spark, rows):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, None)], "x double, y double")
    assert rows(impute.impute_global_mean(df, ["x", "y"])) == [(1.0, None), (1.5, None), (2.0, None)]


def test_group_holding_most_rows_keeps_all_rows(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("g"),
        F.when(F.col("id") % 7 != 0, F.col("id").cast("double")).alias("x"),
    )
    out = impute.impute_group_mean(df, ["x"], "g")
    assert out.count() == 60_000
    assert out.where("x is null").isEmpty()


@pytest.mark.parametrize("small", [False, True, None])
def test_roll_up_is_the_same_for_small_and_large_dimensions(spark, rows, small):
    facts = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") % 4).alias("year"),
        (F.col("id") % 101 / 100).alias("v"),
    )
    dim = spark.range(45).select(F.col("id").alias("d"), (F.col("id") % 5).cast("string").alias("cat"))
    measures = [Measure(h, "v", h, None, 2 if h in ("mean", "sum") else None) for h in ("mean", "sum", "min", "max")]
    got = joins.rolled_up(facts, dim, "k", {"year": "year"}, "cat", measures, "d", dim_is_small=small)
    plain = facts.join(dim, facts.k == dim.d).groupBy("cat", "year").agg(*[m.direct() for m in measures])
    assert rows(got, "cat", "year") == rows(plain, "cat", "year")


@pytest.mark.parametrize("grouped", [True, False])
def test_left_integration_keeps_facts_without_features(spark, rows, grouped):
    facts = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 6.0), ("b", 1, 7.0)], "c string, y int, v double")
    feats = spark.createDataFrame([("a", 1, 0.5), ("z", 9, 0.1)], "c string, y int, f double")
    got = rows(joins.integrate_left(facts, feats, ["c", "y"], grouped))
    assert got == [("a", 1, 5.0, 0.5), ("a", 2, 6.0, None), ("b", 1, 7.0, None)]


def test_key_reconciliation(spark, rows):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "l string")
    right = spark.createDataFrame([("b",), ("c",), (None,)], "r string")
    got = rows(joins.reconcile_keys(left, "l", right, "r"))
    assert got == [("a", "left_only"), ("b", "both"), ("c", "right_only"), (None, "both")]


def test_fixed_point_sums_are_exact_whatever_the_order(spark):
    values = [0.1, 0.2, -0.35, 90071992547.99, -90071992547.98, 1e12, -1e12, 0.07] * 500
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for parts in (1, 7):
        got = df.repartition(parts).agg(exact_sum("v", 2).alias("s"), exact_mean("v", 2).alias("m")).first()
        assert (got.s, got.m) == (15.0, 15.0 / 4000)
    assert df.where("v is null").agg(exact_mean("v", 2)).first()[0] is None
    assert df.where("v is null").agg(exact_sum("v", 2)).first()[0] is None


def test_year_default(spark):
    df = spark.createDataFrame([("a", 1.004), ("a", 1.006)], "c string, x double")
    out = features.yearly_features(df, "c", "day", [Measure("m", "x")], default_year=2023).first()
    assert (out.c, out.year, out.m) == ("a", 2023, 1.01)
    with pytest.raises(ValueError):
        features.yearly_features(df, "c", "day", [Measure("m", "x")])
    with pytest.raises(ValueError):
        features.grouped_measures(df, ["c"], [])


def test_a_value_with_more_places_than_stated_is_no_silent_rounding(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("v"), F.lit(0.29).alias("w"))
    assert df.agg(exact_sum("v", 3).alias("s")).first().s == 4.0
    assert df.agg(exact_sum("w", 2).alias("s")).first().s == 290.0
    with pytest.raises(Exception, match="more than 2 decimal places"):
        df.agg(exact_sum("v", 2)).collect()


def test_facts_without_a_dimension_row_are_counted(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    assert joins.unmatched(facts, spark.createDataFrame([(1,)], "d int"), "k", "d").first().n_rows == 3
