"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.cleaning import as_column
from granary.operators.shaping import present


def drop_all_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows in which every key column that exists is null."""
    have = present(df, keys)
    return df.na.drop(how="all", subset=have) if have else df


def positive_or_null(df: DataFrame, column: str) -> DataFrame:
    return df.where((F.col(column) > 0) | F.col(column).isNull())


def at_extreme(df: DataFrame, value: str | Column, last: bool = False) -> DataFrame:
    """Rows whose value equals the smallest (or largest) one of the table.

    The extremum is a scalar subquery: one number reaches the filter, nothing is joined.
    """
    pick = F.max if last else F.min
    extreme = df.agg(pick(as_column(value)).alias("extreme")).scalar()
    return df.where(as_column(value) == extreme)
