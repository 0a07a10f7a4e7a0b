"""The index of a category as a table, and models fitted side by side."""

from __future__ import annotations

import time

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from granary.operators import indexing, learning


@pytest.fixture(scope="module")
def keyed(spark):
    rows = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 400)))
    return rows.repartition(5, "id")


def test_the_table_gives_the_library_s_own_index(spark, keyed):
    theirs = StringIndexer(inputCol="k", outputCol="i", handleInvalid="keep").fit(keyed.where("id < 2000"))
    ours = indexing.CategoryIndexer(inputCol="k", outputCol="i").fit(keyed.where("id < 2000"))
    assert ours.labels.count() == len(theirs.labels)
    assert ours.transform(keyed).exceptAll(theirs.transform(keyed)).isEmpty()
    assert [r.label for r in ours.labels.orderBy("index").collect()] == theirs.labels
    numbers = keyed.withColumn("k", F.col("id") % 7)
    assert indexing.category_index(numbers, "k").agg(F.max("index"), F.sum("n")).first() == (6, 3000)
    assert indexing.category_index(keyed.where("false"), "k").count() == 0
    assert [r.i for r in indexing.with_index(keyed.limit(2), indexing.category_index(keyed.where("false"), "k"), "k", "i").collect()] == [0.0, 0.0]


def test_an_index_is_saved_within_a_pipeline(spark, keyed, tmp_path):
    rows = keyed.withColumn("x", F.col("id").cast("double"))
    model = Pipeline(stages=learning.feature_stages(["x"], "k", many_labels=True)).fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    unpack = lambda m: sorted(tuple(r) for r in learning.unpack(m.transform(rows), learning.SCALED, ["x2", "k2"]).select("id", "x2", "k2").collect())
    assert unpack(back) == unpack(model)


def test_jobs_run_side_by_side_and_faults_are_raised(spark):
    starts = {}

    def job(name):
        starts[name] = time.monotonic()
        time.sleep(1)
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    begun = time.monotonic()
    got = learning.side_by_side({n: (lambda n=n: job(n)) for n in "abc"}, spark)
    assert got == {n: f"fit-{n}" for n in "abc"} and list(got) == list("abc") and time.monotonic() - begun < 2.5

    def bad():
        raise ValueError("no fit")

    with pytest.raises(ValueError, match="no fit"):
        learning.side_by_side({"bad": bad, "good": lambda: 1}, spark)


def test_stopping_round_and_folds_repeat_bit_for_bit(spark):
    rows = spark.range(1500).withColumn("x", F.col("id") % 97 / 10.0).withColumn("y", F.col("x") * 3 + F.pmod(F.xxhash64("id"), F.lit(100)) / 10.0)
    stages = learning.feature_stages(["x"])
    seen, folds = [], []
    for parts in (2, 5):
        train = learning.with_held_out(rows.repartition(parts, "id"), ["id"], 0.3).select("x", "y", learning.HELD_OUT)
        fitted = learning.fit_models(train, "y", stages, {"gbt": learning.boosted_until_steady("y", 12, 2, 0.05)})
        seen.append(fitted.regressors["gbt"].getNumTrees)
        found = learning.fold_metrics(rows.repartition(parts, "id"), "y", stages, learning.elastic_net("y"), ["id"])
        folds.append(sorted((r.fold, r.n) for r in found.collect()))
    assert seen[0] == seen[1] < 12
    assert folds[0] == folds[1] and sum(n for _, n in folds[0]) == 1500
