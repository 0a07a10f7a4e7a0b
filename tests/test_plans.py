"""The physical plans that make the operators hold at scale."""

from __future__ import annotations

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from granary.operators import accuracy as acc
from granary.operators import impute, learning, shaping
from granary.testbed import load_all
from granary.testbed.judging import predictions


def test_scan_reads_only_what_the_measures_need(spark, folder):
    plan = plan_of(load_all()["yearly_features"].run(spark, folder))
    facts = next(line for line in plan.splitlines() if "l_shipdate" in line and "FileScan" in line)
    assert facts.count("l_") and "l_comment" not in facts and "l_orderkey" not in facts and "l_returnflag" not in facts


@pytest.mark.parametrize("name", ["yearly_features", "error_by_category", "dedupe_exact", "reconcile_keys", "value_counts"])
def test_aggregation_starts_before_the_shuffle(name, spark, folder):
    plan = plan_of(load_all()[name].run(spark, folder))
    assert "partial_" in plan or plan.count("HashAggregate") >= 2


def test_top_errors_are_a_top_k_not_a_sort(spark, folder):
    plan = plan_of(acc.extreme_predictions(predictions(spark, folder), ["l_orderkey"]))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_range_ends_are_subqueries_not_joins(spark, folder):
    plan = plan_of(acc.error_by_range(predictions(spark, folder)))
    assert "Subquery" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_imputation_broadcasts_by_measured_size_and_gives_the_same_without(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 900).alias("g"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 97).cast("double")).alias("x"),
    )
    small = impute.impute_group_mean(df, ["x"], "g")
    assert "BroadcastHashJoin" in plan_of(small)
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for s in settings:
        spark.conf.set(s, "-1")
    try:
        large = impute.impute_group_mean(df, ["x"], "g")
        assert "SortMergeJoin" in plan_of(large)
        got = large.groupBy("g").agg(F.sum("x").alias("s"), F.count("*").alias("n")).collect()
    finally:
        for s in settings:
            spark.conf.unset(s)
    want = small.groupBy("g").agg(F.sum("x").alias("s"), F.count("*").alias("n")).collect()
    assert {r.g: (r.n, pytest.approx(r.s)) for r in want} == {r.g: (r.n, r.s) for r in got}


def test_all_models_score_from_one_scan(spark, tmp_path):
    rows = spark.range(300).select("id", (F.col("id") % 17).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    trained = learning.fit_models(
        rows, "y", learning.feature_stages(["x"]), {"a": learning.elastic_net("y"), "b": learning.random_forest("y", 2, 2)}
    )
    scored = learning.score_all(trained, rows)
    assert plan_of(scored).count("FileScan") == 1
    assert {r.model: r.n for r in scored.groupBy("model").agg(F.count("*").alias("n")).collect()} == {"a": 300, "b": 300}


def test_renaming_and_numbers_stay_narrow(spark, folder):
    part = spark.read.parquet(f"{folder}/part.parquet")
    out = shaping.clean_numbers(shaping.rename(part, {"p_name": "name"}), ["name", "p_size"])
    assert "Exchange" not in plan_of(out)


def test_duplicates_are_dropped_without_a_sort_before_the_exchange(spark, folder):
    plan = plan_of(load_all()["dedupe_exact"].run(spark, folder)).splitlines()
    exchanges = [i for i, line in enumerate(plan) if "Exchange" in line]
    assert exchanges and not any("Sort" in line for line in plan[exchanges[-1] :])


def test_drawn_rows_stay_where_they_are_made(spark):
    from granary.operators import synth

    names = spark.createDataFrame([(f"p{i}", float(i)) for i in range(8)], "name string, v double")
    rules = [synth.RangeRule("v", 0.5, 1.5)]
    plan = plan_of(synth.draw_rows(spark, 1_000_000, synth.derive_ranges(names, rules), rules, names, "name"))
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "Range (0, 1000000" in plan
