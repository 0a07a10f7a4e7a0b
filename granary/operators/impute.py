"""Mean imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.aggregates import exact_mean
from granary.operators.shaping import present
from granary.sources.workspace import settle


def _mean(column: str, scale: int | None):
    return F.avg(column) if scale is None else exact_mean(column, scale)


def impute_group_mean(
    df: DataFrame, columns: Sequence[str], by: str, scale: int | None = None
) -> DataFrame:
    """Nulls become the mean of the column's non-null values in the row's group.

    A column that is null throughout a group stays null. All means come from
    one aggregation that combines map-side, so a group holding a third of the
    rows costs no more than others. They are settled as a table of one row
    per group; its written size decides whether the join back broadcasts it,
    and beyond that the planner joins by shuffle and splits skewed groups.
    """
    columns = present(df, columns)
    if not columns:
        return df
    means = settle(
        df.groupBy(F.col(by).alias("__group")).agg(*[_mean(c, scale).alias(f"__mean_{c}") for c in columns]),
        "group-means",
    )
    filled = df.join(means, F.col(by).eqNullSafe(F.col("__group")), "left")
    return filled.select(
        *[F.coalesce(c, f"__mean_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def impute_global_mean(df: DataFrame, columns: Sequence[str], scale: int | None = None) -> DataFrame:
    """Nulls become the mean over the whole table; the means reach the rows as scalar subqueries."""
    columns = present(df, columns)
    if not columns:
        return df
    means = df.agg(*[_mean(c, scale).alias(c) for c in columns])
    return df.withColumns({c: F.coalesce(F.col(c), means.select(c).scalar()) for c in columns})
