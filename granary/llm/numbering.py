"""Gapless numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 20_000


def numbered(rows: DataFrame, group: str, order: Sequence[str], name: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Number the rows of every ``group`` from 0 without a gap.

    A group is dealt into chunks of about ``chunk_rows`` rows by a hash of ``order``;
    chunks are numbered apart and moved up by the rows of the chunks before
    them, so a hot group is no task of its own. ``rows`` is read more than once: settle it first.
    """
    chunks = rows.groupBy(group).agg((1 + F.floor(F.count(F.lit(1)) / chunk_rows)).alias("__chunks"))
    dealt = rows.join(chunks, rows[group].eqNullSafe(chunks[group])).drop(chunks[group])
    dealt = dealt.withColumn("__chunk", F.pmod(F.xxhash64(*order), F.col("__chunks")))
    before = Window.partitionBy(group).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(group, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select(F.col(group).alias("__group"), F.col("__chunk").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(group, "__chunk").orderBy(*order)
    placed = dealt.withColumn("__place", F.row_number().over(inside))
    joined = placed.join(counts, placed[group].eqNullSafe(counts["__group"]) & (placed["__chunk"] == counts["__of"]))
    return joined.withColumn(name, F.col("__before") + F.col("__place") - 1).drop("__chunks", "__chunk", "__group", "__of", "__before", "__place", "__n")
