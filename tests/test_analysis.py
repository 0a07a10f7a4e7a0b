"""The packs give what their single operators give, from few passes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from granary.operators import accuracy as acc
from granary.operators import profile
from granary.plans import analysis


@pytest.fixture(scope="module")
def tables(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.col("l_returnflag").alias("category"), F.year("l_shipdate").alias("year"), F.col("l_quantity").alias("a"),
        F.col("l_extendedprice").alias("t"), F.col("l_tax").alias("b"), F.col("l_linenumber").alias("k"),
    )
    judged = acc.with_errors(lines.select("category", "year", "k", F.col("t").alias("actual"), (F.col("t") * 1.1 - 50).alias("predicted")))
    return lines.where("k < 3"), lines.where("k >= 3"), judged


def near(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def test_chart_tables(tables):
    gold, synthetic, judged = tables
    got = analysis.plot_data(judged, gold, synthetic, ["a", "b"], "t", "category", "year")
    for source, df in (("real", gold), ("synthetic", synthetic)):
        for c in ("a", "b", "t"):
            assert near(got[f"density_{source}_{c}"].collect()) == near(profile.histogram(df, c, 20, density=True).collect())
        assert near(got[f"histogram_{source}_t"].collect()) == near(profile.histogram(df, "t", 30).collect())
        assert near(got[f"correlation_{source}"].collect()) == near(profile.correlation_matrix(df, ["a", "b", "t"]).collect())
    assert near(got["trend_a"].collect()) == near(profile.linear_trend(gold, "a", "t").collect())
    assert near(got["feature_target"].collect()) == near(profile.feature_target_correlation(gold, ["a", "b"], "t").collect())
    assert near(got["volume"].collect()) == near(profile.volume_summary(gold, synthetic).collect())
    assert near(got["year_coverage"].collect()) == near(profile.value_counts(gold, "year", "year").collect())


def test_accuracy_tables(tables):
    judged = tables[2]
    shown = ["category", "k", "actual"]
    got = analysis.accuracy_pack(judged, "category", "year", shown)
    assert near(got["accuracy_by_year"].collect()) == near(acc.error_by(judged, "year", "year").collect())
    ranked = got["accuracy_by_category"].collect()
    assert near(ranked) == near(acc.error_by(judged, "category", "category", actual="actual", digits=2).collect())
    assert [r.mean_error_pct for r in ranked] == sorted(r.mean_error_pct for r in ranked)
    assert near(got["best_and_worst_category"].collect()) == near(acc.best_and_worst(judged, "category").collect())
    assert near(got["accuracy_by_range"].collect()) == near(acc.error_by_range(judged).collect())
    assert near(got["error_distribution"].collect()) == near(acc.error_distribution(judged).collect())
    assert near(got["error_histogram"].collect()) == near(profile.histogram(judged, "error_pct", 50).collect())
    assert near(got["error_bands"].collect()) == near(acc.error_bands(judged).collect())
    for name, worst in (("worst_predictions", True), ("best_predictions", False)):
        assert near(got[name].collect()) == near(acc.extreme_predictions(judged, shown, worst=worst).collect())
        values = [r.error_pct for r in got[name].collect()]
        assert values == sorted(values, reverse=worst)


def test_accuracy_pack_of_few_and_of_null_rows(spark):
    rows = [("a", 1, None, None), ("a", 1, 0.0, None), (None, None, 5.0, 20.0), ("b", 2, 5.0, 0.0)]
    judged = spark.createDataFrame(rows, "category string, year int, actual double, error_pct double")
    got = analysis.accuracy_pack(judged, "category", "year", ["category"])
    for name, want in (
        ("accuracy_by_range", acc.error_by_range(judged)), ("error_distribution", acc.error_distribution(judged)),
        ("error_bands", acc.error_bands(judged)), ("worst_predictions", acc.extreme_predictions(judged, ["category"])),
        ("error_histogram", profile.histogram(judged, "error_pct", 50)),
    ):
        assert near(got[name].collect()) == near(want.collect()), name
    empty = analysis.accuracy_pack(judged.where("false"), "category", "year", ["category"])
    assert empty["error_distribution"].first().n in (0, None) and empty["worst_predictions"].count() == 0


def test_accuracy_pack_reads_the_predictions_three_times(spark, tables, monkeypatch):
    """A counter in every row tells how often it is read; the median, whose passes are its own, is left out."""
    seen = spark.sparkContext.accumulator(0)

    def look(value):
        seen.add(1)
        return value

    monkeypatch.setattr(analysis, "exact_quantile", lambda *_, **__: 0.0)
    judged = tables[2].repartition(4).cache()
    rows = judged.count()
    counted = judged.withColumn("error_pct", F.udf(look, "double").asNondeterministic()("error_pct"))
    for df in analysis.accuracy_pack(counted, "category", "year", ["category", "k"]).values():
        df.collect()
    assert seen.value <= 3 * rows
