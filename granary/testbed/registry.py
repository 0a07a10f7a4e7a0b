"""Named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("files", "shaping", "cleaning", "joining", "profiling", "judging", "drawing", "learning", "stages")


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function (spark, folder) -> DataFrame under its name."""

    def register(run):
        QUERIES[name or run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sql_round(expression: str, digits: int) -> str:
    """Half-up rounding on the decimal value, as Spark rounds doubles."""
    return f"cast(round(cast({expression} as decimal(38,12)), {digits}) as double)"


def sql_mean(column: str) -> str:
    """Mean of a two-decimal column through an exact sum."""
    return f"(cast(sum(cast({column} as decimal(18,2))) as double) / count({column}))"


def sql_sum(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(18,2))) as double)"


def load_all() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"granary.testbed.{module}")
    return QUERIES
