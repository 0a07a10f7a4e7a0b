"""Feature pipelines and the three regressors on MLlib."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import InheritableThread
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.aggregates import mae, r_squared, rmse
from granary.functions.draws import uniform

from granary.operators.cells import cells_of, fit_on_cells, scoring, takes_cells
from granary.operators.indexing import CategoryIndexer
from granary.sources.workspace import settle

FEATURES, SCALED, HELD_OUT = "features", "scaled_features", "held_out"
HELD_OUT_SALT, FOLD_SALT = "held-out", "fold"


def indexed_name(category: str) -> str:
    return f"{category}_indexed"


def feature_stages(
    numeric: Sequence[str], category: str | None = None, on_null: str = "error", many_labels: bool = False
) -> list[Estimator]:
    """Index the category, assemble, standardise.

    Categories unseen in training get an index of their own. ``on_null`` is
    the assembler's rule for null features; impute them beforehand. ``many_labels`` keeps the
    index as a table that rows are joined with, for categories that are keys rather than a few names.
    """
    inputs = [*numeric, *([indexed_name(category)] if category else [])]
    stages: list[Estimator] = []
    if category and many_labels:
        stages.append(CategoryIndexer(inputCol=category, outputCol=indexed_name(category)))
    elif category:
        stages.append(
            StringIndexer(inputCol=category, outputCol=indexed_name(category), handleInvalid="keep")
        )
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid=on_null))
    stages.append(StandardScaler(inputCol=FEATURES, outputCol=SCALED, withMean=True, withStd=True))
    return stages


def random_forest(label: str, trees: int = 100, depth: int = 10, **more) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=SCALED, labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=10, seed=42, **more
    )


def boosted_trees(label: str, iterations: int = 50, depth: int = 8, **more) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=SCALED, labelCol=label, maxIter=iterations, maxDepth=depth, minInstancesPerNode=10, seed=42, **more
    )


def elastic_net(label: str, iterations: int = 100, penalty: float = 0.1, mix: float = 0.1, **more) -> LinearRegression:
    return LinearRegression(
        featuresCol=SCALED, labelCol=label, maxIter=iterations, regParam=penalty, elasticNetParam=mix, **more
    )


def regressors(label: str) -> dict[str, Estimator]:
    return {
        "RandomForest": random_forest(label),
        "GBT": boosted_trees(label),
        "LinearRegression": elastic_net(label),
    }


@dataclass(frozen=True)
class Trained:
    """A fitted preparation and the regressors fitted behind it."""

    preparation: PipelineModel
    regressors: dict[str, Model]

    def pipeline(self, name: str) -> PipelineModel:
        """Preparation and one regressor as a single model, to save or to score raw rows with."""
        return PipelineModel(stages=[*self.preparation.stages, self.regressors[name]])


def fit_models(
    train: DataFrame, label: str, stages: Sequence[Estimator], models: Mapping[str, Estimator]
) -> Trained:
    """Fit the preparation on the training rows once, then every regressor on the prepared rows.

    Hand in only the columns needed. The training rows are written once,
    rebalanced to even files of the advisory size: that one shuffle pays off
    over dozens of passes, which would otherwise wait for the largest input
    file, and a lost executor does not send them back to the source. The
    preparation itself is a narrow step and is not stored; the estimators
    keep their own compact form of the rows between passes.

    The regressors are fitted side by side, each from a thread and in a scheduler pool of its own: one
    model's small jobs fill what another leaves free. Under ``spark.scheduler.mode=FAIR`` the pools share evenly.
    A model that names a validation column (``boosted_until_steady``) is given the rows with their ``HELD_OUT`` flag.

    Tree models are fitted on cells of rows that share a bin of every feature (see ``cells``) where these are far fewer than the rows.
    """
    rows = settle(train.hint("rebalance"), "training")
    preparation = Pipeline(stages=list(stages)).fit(rows)
    kept = [HELD_OUT] if HELD_OUT in train.columns else []
    whole = preparation.transform(rows)
    prepared = whole.select(SCALED, label, *kept)
    # An assembler that lets nulls pass or drops their rows is left to MLlib.
    inputs = next((s.getInputCols() for s in preparation.stages if isinstance(s, VectorAssembler) and s.getHandleInvalid() == "error"), [])
    trees = {name: model.getMaxBins() for name, model in models.items() if inputs and takes_cells(model, SCALED)}
    found = {bins: cells_of(whole, inputs, label, kept, bins) for bins in sorted(set(trees.values()))}
    cells = {bins: of for bins, of in found.items() if of}

    def fit(name: str, model: Estimator) -> Model:
        of = cells.get(trees.get(name))
        return (fit_on_cells(model, of) if of else None) or model.fit(prepared)

    fitted = side_by_side({name: partial(fit, name, model) for name, model in models.items()}, train.sparkSession)
    return Trained(scoring(preparation, list(cells.values())), fitted)


def side_by_side(jobs: Mapping[str, Callable[[], object]], spark: SparkSession) -> dict[str, object]:
    """Results of jobs that are run at the same time, each in a scheduler pool named like it; the first fault is raised."""
    done: dict[str, object] = {}
    faults: list[BaseException] = []

    def run(name: str, job: Callable[[], object]) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{name}")
        try:
            done[name] = job()
        except BaseException as fault:  # raised by the caller
            faults.append(fault)

    threads = [InheritableThread(target=run, args=item) for item in jobs.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if faults:
        raise faults[0]
    return {name: done[name] for name in jobs}


def with_held_out(df: DataFrame, keys: Sequence[str], share: float = 0.1) -> DataFrame:
    """Rows with a ``HELD_OUT`` flag drawn from a hash of their keys: the same ones in every run and layout."""
    return df.withColumn(HELD_OUT, uniform(list(keys), HELD_OUT_SALT) < share)


def boosted_until_steady(label: str, iterations: int = 50, depth: int = 8, tolerance: float = 0.01, **more) -> GBTRegressor:
    """Boosted trees that stop when the error on the held-out rows no longer falls by ``tolerance``."""
    return boosted_trees(label, iterations, depth, validationIndicatorCol=HELD_OUT, validationTol=tolerance, **more)


def fold_metrics(
    df: DataFrame, label: str, stages: Sequence[Estimator], model: Estimator, keys: Sequence[str], folds: int = 3
) -> DataFrame:
    """(fold, n, rmse, mae, r2) of a model fitted on the other folds; folds come from a hash of the keys and are fitted side by side."""
    fold = F.floor(uniform(list(keys), FOLD_SALT) * folds).cast("int")
    rows = settle(df.withColumn("fold", fold), "folds")

    def one(i: int) -> DataFrame:
        fitted = Pipeline(stages=[*stages, model]).fit(rows.where(F.col("fold") != i))
        return settle(score(fitted, rows.where(F.col("fold") == i)).select("fold", label, "prediction"), "fold")

    scored = side_by_side({f"fold-{i}": partial(one, i) for i in range(folds)}, df.sparkSession)
    together = reduce(DataFrame.unionByName, scored.values())
    return together.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), rmse(label, "prediction").alias("rmse"), mae(label, "prediction").alias("mae"), r_squared(label, "prediction").alias("r2")
    )


def score(model: PipelineModel, df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Rows with the model's prediction; the helper columns of the pipeline are left out."""
    scored = model.transform(df)
    return scored.select(*df.columns, F.col("prediction").alias(prediction))


def score_all(
    trained: Trained, df: DataFrame, prediction: str = "prediction", label: str = "model"
) -> DataFrame:
    """Predictions of every model in one table, told apart by a model column.

    The rows are read and prepared once; each model adds its prediction, and
    the predictions of a row are unfolded last.
    """
    wide = trained.preparation.transform(df)
    rows = []
    for i, (name, model) in enumerate(trained.regressors.items()):
        own = f"__prediction_{i}"
        wide = model.copy({model.predictionCol: own}).transform(wide)
        rows.append(F.struct(F.lit(name).alias(label), F.col(own).alias(prediction)))
    return wide.select(*df.columns, F.inline(F.array(*rows)))


def evaluate(df: DataFrame, label: str, prediction: str, metric: str) -> float:
    """MLlib's own evaluator, for cross-checks of the one-pass metrics."""
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName=metric).evaluate(df)


def feature_importance(model: PipelineModel, features: Sequence[str], like: DataFrame) -> DataFrame:
    """(rank, feature, importance) of a tree model, empty for others; one row per feature."""
    last = model.stages[-1]
    weights = last.featureImportances.toArray().tolist() if hasattr(last, "featureImportances") else []
    ranked = sorted(zip(features, weights), key=lambda p: (-p[1], p[0]))
    rows = [(i, f, float(w)) for i, (f, w) in enumerate(ranked, start=1)]
    return like.sparkSession.createDataFrame(rows, "rank int, feature string, importance double")


def unpack(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Vector entries as plain columns, for output and for SQL."""
    values = vector_to_array(vector)
    kept = [c for c in df.columns if c not in (FEATURES, SCALED)]
    return df.select(*kept, *[values[i].alias(n) for i, n in enumerate(names)])
