"""Integration joins, dimension lookups and key reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.aggregates import Measure
from granary.functions.cleaning import as_column, lookup
from granary.sources.workspace import is_broadcast, settle


def integrate_left(
    facts: DataFrame, features: DataFrame, on: Sequence[str], facts_grouped: bool = False
) -> DataFrame:
    """Every fact row with the features of its key, null where there are none.

    ``facts_grouped`` says that the facts were grouped by the same key: then
    both sides already lie together and join without another shuffle.
    Otherwise the features are settled first. Their written size decides
    whether they are broadcast and the facts stay where they are; beyond that
    both sides are plainly shuffled, where the planner can split a hot key.
    """
    return facts.join(features if facts_grouped else settle(features, "features"), list(on), "left")


def rolled_up(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    groups: Mapping[str, str | Column],
    category: str,
    measures: Sequence[Measure],
    dim_key: str | None = None,
    dim_is_small: bool | None = None,
) -> DataFrame:
    """Aggregate facts by a category that a dimension holds, and by ``groups`` of their own.

    The dimension is settled, and its written size decides (or ``dim_is_small``, where it is known). One that the session
    broadcasts leaves the facts where they are, and only group totals are shuffled. A larger one is met by totals per key: a key with a third
    of all facts shrinks to one row per group before anything is joined.
    Facts whose key the dimension lacks belong to no category and are left out; ``unmatched`` counts them.
    """
    dim_key = dim_key or key
    names = settle(dim.select(F.col(dim_key).alias("__key"), F.col(category)), "dimension")
    own = [as_column(c).alias(n) for n, c in groups.items()]
    if is_broadcast(names) if dim_is_small is None else dim_is_small:
        joined = facts.join(names, F.col(key) == F.col("__key"))
        return joined.groupBy(category, *own).agg(*[m.direct() for m in measures])
    parts = facts.groupBy(F.col(key).alias("__key"), *own).agg(*[p for m in measures for p in m.partials()])
    return parts.join(names, "__key").groupBy(category, *groups).agg(*[m.merged() for m in measures])


def unmatched(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """(n_rows) of the facts whose key the dimension lacks, a null key included."""
    known = dim.select(F.col(dim_key or key).alias("__key"))
    return facts.join(known, F.col(key) == F.col("__key"), "left_anti").agg(F.count("*").alias("n_rows"))


def with_lookup(
    df: DataFrame, name: str, key: str, mapping: Mapping[str, object], default: object
) -> DataFrame:
    return df.withColumn(name, lookup(key, mapping, default))


def reconcile_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """(key, status) over both tables: both, left_only or right_only.

    One grouped union instead of two distincts and a full join: one shuffle,
    and a key's copies collapse map-side.
    """
    sides = left.select(F.col(left_key).alias("key"), F.lit(True).alias("in_left")).unionByName(
        right.select(F.col(right_key).alias("key"), F.lit(False).alias("in_left"))
    )
    seen = sides.groupBy("key").agg(
        F.bool_or("in_left").alias("l"), F.bool_or(~F.col("in_left")).alias("r")
    )
    status = F.when(F.col("l") & F.col("r"), "both").when(F.col("l"), "left_only").otherwise("right_only")
    return seen.select("key", status.alias("status"))
