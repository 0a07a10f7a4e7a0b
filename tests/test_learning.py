from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from granary.functions.cleaning import lookup
from granary.functions.draws import uniform
from granary.operators import accuracy as acc
from granary.operators import learning, sampling, synth
from granary.plans.modelling import train_and_compare
from granary.sources.tables import load_model, save_model


@pytest.fixture(scope="module")
def table(spark):
    u = [uniform("id", f"f{i}") for i in range(3)]
    drawn = spark.range(4000).select(
        "id",
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("cat"),
        (u[0] * 1000).alias("area"),
        (u[1] * 10).alias("rain"),
        F.lit(7.0).alias("constant"),
    )
    target = synth.with_target(drawn, "target", F.col("area") * 50 + F.col("rain"), lookup("cat", {"a": 2.0}, 1.0), F.lit(2000))
    return target.withColumn("target", F.col("target").cast("double"))


@pytest.fixture(scope="module")
def fitted(table):
    train, test = sampling.split_train_test(table, ["id"])
    models = {
        "forest": learning.random_forest("target", 10, 6),
        "boosted": learning.boosted_trees("target", 10, 5),
        "linear": learning.elastic_net("target"),
    }
    return train_and_compare(train, test, "target", ["area", "rain", "constant"], "cat", ["id", "cat"], models), test


def test_all_models_are_scored_and_the_best_is_named(fitted):
    done, test = fitted
    metrics = {r.model: r for r in done.metrics.collect()}
    assert set(metrics) == {"forest", "boosted", "linear"}
    assert all(m.n == test.count() for m in metrics.values())
    assert done.best == max(metrics, key=lambda k: metrics[k].r2)
    assert metrics[done.best].r2 > 0.95


def test_one_pass_metrics_equal_the_evaluator(fitted):
    done, _ = fitted
    for row in done.metrics.collect():
        own = done.predictions.where(F.col("model") == row.model)
        for name in ("rmse", "mae", "r2"):
            assert row[name] == pytest.approx(learning.evaluate(own, acc.ACTUAL, acc.PREDICTED, name), rel=1e-9)


def test_saved_pipeline_scores_raw_rows_alike(fitted, tmp_path):
    done, test = fitted
    model = done.trained.pipeline("boosted")
    save_model(model, str(tmp_path / "m"))
    a = learning.score(model, test).select("id", "prediction")
    assert a.exceptAll(learning.score(load_model(str(tmp_path / "m")), test).select("id", "prediction")).isEmpty()
    table = done.predictions.where("model = 'boosted'").select("id", F.col("predicted").alias("prediction"))
    assert a.exceptAll(table).isEmpty()


def test_unseen_category_is_scored(fitted, spark):
    done, test = fitted
    unseen = test.limit(5).withColumn("cat", F.lit("new"))
    assert learning.score(done.trained.pipeline("linear"), unseen).where("prediction is not null").count() == 5


def test_importance_ranks_features(fitted, spark, table):
    done, _ = fitted
    names = ["area", "rain", "constant", learning.indexed_name("cat")]
    got = learning.feature_importance(done.trained.pipeline("forest"), names, table).orderBy("rank").collect()
    assert got[0].feature == "area" and got[-1].feature == "constant" and got[-1].importance == 0.0
    assert sum(r.importance for r in got) == pytest.approx(1.0)
    assert learning.feature_importance(done.trained.pipeline("linear"), names, table).isEmpty()


def test_null_feature_is_an_error_not_a_lost_row(spark, table):
    broken = table.withColumn("area", F.when(F.col("id") != 3, F.col("area")))
    with pytest.raises(Exception, match="(?i)null"):
        learning.fit_models(broken, "target", learning.feature_stages(["area"]), {"l": learning.elastic_net("target")})
