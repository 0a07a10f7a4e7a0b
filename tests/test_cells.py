from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from granary.functions.draws import uniform
from granary.operators import cells, learning
from granary.sources.tables import load_model, save_model

INPUTS = ["area", "rain"]


@pytest.fixture(scope="module")
def table(spark):
    u = [uniform("id", f"c{i}") for i in range(4)]
    skewed = F.floor(u[0] * u[0] * 41)  # more values than bins, of unlike counts
    drawn = spark.range(9000).select("id", (skewed * 1.7 - 3).alias("area"), F.floor(u[1] * 3).cast("double").alias("rain"), (u[2] < 0.2).alias("held_out"), u[3].alias("u"))
    return drawn.select("*", (F.sin("area") * 40 + F.col("rain") * F.col("area") + F.col("u") * 30).alias("target"))


@pytest.fixture(scope="module")
def whole(table):
    return Pipeline(stages=learning.feature_stages(INPUTS)).fit(table).transform(table)


@pytest.fixture(scope="module")
def models(spark):
    return {
        "boosted": learning.boosted_trees("target", 4, 4),
        "steady": learning.boosted_until_steady("target", 12, 2, 0.2),
        "forest": learning.random_forest("target", 2, 4, bootstrap=False, featureSubsetStrategy="all"),
    }


@pytest.fixture(scope="module")
def trained(table, models):
    return learning.fit_models(table.select(*INPUTS, "target", "held_out"), "target", learning.feature_stages(INPUTS), models)


@pytest.mark.parametrize("name", ["boosted", "steady", "forest"])
def test_a_model_fitted_on_cells_is_that_of_the_rows(table, whole, models, trained, name):
    assert trained.regressors[name].getFeaturesCol() == "binned_features_32"
    plain = models[name].fit(whole)
    assert trained.regressors[name].getNumTrees == plain.getNumTrees
    assert trained.regressors[name].featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), rel=1e-6)
    ours = learning.score(trained.pipeline(name), table, "ours").select("id", "ours")
    both = ours.join(plain.transform(whole).select("id", "prediction"), "id")
    assert both.agg(F.max(F.abs(F.col("ours") - F.col("prediction")) / (1 + F.abs("prediction")))).first()[0] < 1e-9


def test_fits_see_no_more_rows_when_rows_are_repeated(table, whole):
    once, thrice = (cells.cells_of(r, INPUTS, "target", [], 32) for r in (whole, whole.union(whole).union(whole)))
    assert (thrice.n_rows, thrice.n_cells) == (3 * once.n_rows, once.n_cells)
    assert cells._weighted(thrice, thrice.table).count() <= 2 * once.n_cells
    sums = [F.sum(cells.WEIGHT), F.sum(F.col(cells.WEIGHT) * F.col("target")), F.sum(F.col(cells.WEIGHT) * F.col("target") ** 2)]
    told = cells._weighted(thrice, thrice.table).agg(*sums).first()
    assert list(told) == pytest.approx([3 * x for x in table.agg(F.count("id"), F.sum("target"), F.sum(F.col("target") ** 2)).first()], rel=1e-9)


def test_rows_are_drawn_a_poisson_number_of_times_for_each_tree(whole):
    of = cells.cells_of(whole, INPUTS, "target", [], 32)
    drawn = cells.draws(of, 20, 1.0, 7)
    totals = [r["w"] for r in drawn.groupBy("tree").agg(F.sum("n").alias("w")).collect()]
    assert len(totals) == 20 and len(set(totals)) > 10
    assert all(abs(w - of.n_rows) < 5 * of.n_rows**0.5 for w in totals)
    # As often as a cell has rows, on average; the variance is the mean.
    told = drawn.groupBy(*of.bins).agg(F.sum("n").alias("w")).join(of.table, of.bins)
    assert told.count() == of.n_cells
    assert 0.6 < told.agg(F.avg((F.col("w") - 20 * F.col("n")) ** 2 / (20 * F.col("n")))).first()[0] < 1.5


def test_a_forest_with_bootstrap_is_one_model_of_all_trees(spark, table, whole, tmp_path):
    forest = learning.random_forest("target", 12, 5)
    done = learning.fit_models(table.select(*INPUTS, "target"), "target", learning.feature_stages(INPUTS), {"forest": forest})
    made, plain = done.regressors["forest"], forest.fit(whole)
    assert made.getNumTrees == 12 and len({t.toDebugString.split("\n", 1)[1] for t in made.trees}) > 6
    r2 = RegressionEvaluator(labelCol="target", metricName="r2")
    judged = r2.evaluate(done.pipeline("forest").transform(table))
    assert judged == pytest.approx(r2.evaluate(plain.transform(whole)), abs=0.06)
    save_model(done.pipeline("forest"), str(tmp_path / "m"))
    again = learning.score(load_model(str(tmp_path / "m")), table).select("id", "prediction")
    assert again.exceptAll(learning.score(done.pipeline("forest"), table).select("id", "prediction")).isEmpty()


def test_rows_that_gather_in_no_cells_and_missing_labels_are_left_to_mllib(table, whole, models):
    assert cells.cells_of(whole, ["area", "u"], "target", [], 32) is None
    assert cells.cells_of(whole.withColumn("target", F.when(F.col("id") != 3, F.col("target"))), INPUTS, "target", [], 32) is None
    with pytest.raises(Exception, match="(?i)null"):
        broken = table.withColumn("area", F.when(F.col("id") != 3, F.col("area")))
        learning.fit_models(broken.select(*INPUTS, "target"), "target", learning.feature_stages(INPUTS), {"b": models["boosted"]})


def test_a_column_of_many_values_is_cut_by_a_sketch(spark, monkeypatch, whole):
    monkeypatch.setattr(cells, "COUNTED", 20)
    of = cells.cells_of(whole, INPUTS, "target", [], 32)
    splits = of.stages[0].getSplitsArray()
    assert 10 < len(splits[0]) <= 33 and len(splits[1]) == 4
    assert of.table.agg(F.sum("n")).first()[0] == 9000
