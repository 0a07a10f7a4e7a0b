"""Renaming, projecting, uniting, de-duplicating."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.cleaning import parse_number, standard_name


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def add_literals(df: DataFrame, values: Mapping[str, object], only_missing: bool = False) -> DataFrame:
    """Add constant columns; with ``only_missing`` an existing column is kept."""
    wanted = {n: F.lit(v) for n, v in values.items() if not (only_missing and n in df.columns)}
    return df.withColumns(wanted) if wanted else df


def stamp(df: DataFrame, name: str = "processed_at", as_of: datetime | str | None = None) -> DataFrame:
    """Processing time of the row; a given ``as_of`` makes the output reproducible."""
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumn(name, moment)


def project_required(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Required columns that are present, in that order, and the list of the absent ones."""
    present = [c for c in required if c in df.columns]
    if not present:
        raise ValueError(f"none of the required columns is present: {', '.join(required)}")
    return df.select(*present), [c for c in required if c not in df.columns]


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def clean_numbers(df: DataFrame, names: Sequence[str], **how) -> DataFrame:
    """Parse the text columns among ``names``; columns that are numbers already are only cast."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {
            n: parse_number(n, **how) if kinds[n] == "string" else F.col(n).cast("double")
            for n in present(df, names)
        }
    )


def standardize_keys(
    df: DataFrame, names: Sequence[str], aliases: Mapping[str, str] | None = None
) -> DataFrame:
    return df.withColumns({n: standard_name(n, aliases) for n in present(df, names)})


def first_available(df: DataFrame, options: Sequence[tuple[Sequence[str], Callable[[], Column]]]) -> Column:
    """Expression of the first option whose source columns the table has; decided on the schema."""
    for needed, build in options:
        if all(c in df.columns for c in needed):
            return build()
    raise ValueError("no option has its source columns")


def unite(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column a table lacks is null there. Never by position."""
    first, *others = tables
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def dedupe(df: DataFrame, keys: Sequence[str], keep_first_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key.

    With ``keep_first_by`` the smallest row in that order stays (nulls first), remaining
    columns breaking ties. For a single order column of fixed width, the least value of each key
    is hashed out map-side without any sort, and only the rows that have it are compared further. Other orders
    are one aggregate of whole rows, which sorts but sends one row per key and task.
    """
    if keep_first_by is None:
        return df.dropDuplicates(list(keys))
    order = [F.col(c) if isinstance(c, str) else c for c in keep_first_by]
    kind = df.select(order[0]).schema[0].dataType
    if len(order) == 1 and isinstance(kind, FIXED_WIDTH) and not isinstance(kind, T.DecimalType):
        ordered = df.withColumn("__order", order[0])
        least = ordered.groupBy(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]).agg(
            F.when(F.bool_and(F.col("__order").isNotNull()), F.min("__order")).alias("__least")
        )
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)])
        df = ordered.join(least, same & F.col("__order").eqNullSafe(F.col("__least"))).select(df.columns)
        order = []
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(
        *[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("row")
    )
    kept = df.groupBy(*keys).agg(F.min(ranked).alias("kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"kept.row.{c}") for c in df.columns])


def distinct_rows(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct() if names else df.distinct()


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """First n rows of a stated order; a top-k per partition, never a full sort."""
    return df.orderBy(*order).limit(n)
