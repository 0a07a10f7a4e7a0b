"""Training, comparing, choosing and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.cleaning import iso_stamp
from granary.operators.accuracy import best_model, model_comparison, with_errors
from granary.operators.learning import Trained, feature_stages, fit_models, regressors, score_all
from granary.sources.tables import publish
from granary.sources.workspace import settle


@dataclass(frozen=True)
class Fitted:
    trained: Trained
    predictions: DataFrame  # test rows of all models
    metrics: DataFrame
    best: str


def prediction_table(
    scored: DataFrame,
    label: str,
    prediction: str,
    keep: Sequence[str],
    actual: str = "actual",
    predicted: str = "predicted",
    error: str = "error",
    error_pct: str = "error_pct",
    model: str = "model",
    dated: str | None = None,
    as_of: datetime | str | None = None,
) -> DataFrame:
    """Features, actual and predicted value, model, optional ISO date of scoring, error columns."""
    out = scored.select(
        *keep, F.col(label).alias(actual), F.col(prediction).alias(predicted), F.col(model)
    )
    if dated:
        moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
        out = out.withColumn(dated, iso_stamp(moment))
    return with_errors(out, actual, predicted, error, error_pct)


def train_and_compare(
    train: DataFrame,
    test: DataFrame,
    label: str,
    numeric: Sequence[str],
    category: str | None,
    keep: Sequence[str],
    models: Mapping[str, Estimator] | None = None,
    place: str | None = None,
    **columns,
) -> Fitted:
    """Fit all models on train, score test with each, judge all in one pass, name the best by R2.

    The prediction table of all models is written once, to ``place`` (by model) if one is given; every later report reads it.
    """
    needed = [*numeric, *([category] if category else []), label]
    stages = feature_stages(numeric, category)
    fitted = fit_models(train.select(*needed), label, stages, models or regressors(label))
    model = columns.get("model", "model")
    scored = score_all(fitted, test, label=model)
    table = prediction_table(scored, label, "prediction", keep, **columns)
    if place:
        table = train.sparkSession.read.schema(table.schema).parquet(publish(table, place, partition_by=[model]))
    else:
        table = settle(table, "predictions")
    names = {c: columns.get(c, c) for c in ("actual", "predicted", "error_pct")}
    metrics = settle(model_comparison(table, model, **names), "metrics")
    return Fitted(fitted, table, metrics, best_model(metrics, model).first()[model])
