"""Sampling and splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.draws import uniform


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def keyed_sample(
    df: DataFrame, fraction: float, keys: Sequence[str], salt: str = "sample"
) -> DataFrame:
    """Sample by a draw on the row's key: the same rows in every run, layout and retry."""
    return df.where(uniform(list(keys), salt) < fraction)


def label_split(
    df: DataFrame, keys: Sequence[str], train: float = 0.8, salt: str = "split-42", name: str = "split"
) -> DataFrame:
    """Each row marked train or test by a draw on its key: the same in every run and layout."""
    return df.withColumn(name, F.when(uniform(list(keys), salt) < train, "train").otherwise("test"))


def split_train_test(
    df: DataFrame, keys: Sequence[str], train: float = 0.8, salt: str = "split-42"
) -> tuple[DataFrame, DataFrame]:
    """Two filters of one table. A lost executor recomputes the very same halves."""
    draw = uniform(list(keys), salt)
    return df.where(draw < train), df.where(draw >= train)


def split_random(
    df: DataFrame, train: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split, for tables without a usable key; depends on the row layout."""
    first, second = df.randomSplit([train, 1.0 - train], seed=seed)
    return first, second


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """(split, n, pct) from one grouped count."""
    counted = df.groupBy(split).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.select(split, "n", (F.col("n") * 100.0 / total.cast("double")).alias("pct"))
