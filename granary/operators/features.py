"""Yearly features and series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.aggregates import Measure
from granary.functions.cleaning import as_column


def with_year(df: DataFrame, date: str, name: str = "year", default: int | None = None) -> DataFrame:
    """Year of the date column; a table without that column gets the default year."""
    if date in df.columns:
        return df.withColumn(name, F.year(date))
    if default is None:
        raise ValueError(f"no column {date} and no default year")
    return df.withColumn(name, F.lit(default))


def grouped_measures(
    df: DataFrame, groups: Sequence[str] | Mapping[str, str | Column], measures: Sequence[Measure]
) -> DataFrame:
    """Measures per group: partial sums per task, one shuffle of group totals."""
    if not measures:
        raise ValueError("no measure to aggregate")
    named = groups if isinstance(groups, Mapping) else {g: g for g in groups}
    return df.groupBy(*[as_column(c).alias(n) for n, c in named.items()]).agg(*[m.direct() for m in measures])


def yearly_features(
    df: DataFrame, category: str, date: str, measures: Sequence[Measure], year: str = "year", default_year: int | None = None
) -> DataFrame:
    """Measures per category and year of the date."""
    return grouped_measures(with_year(df, date, year, default_year), [category, year], measures)
