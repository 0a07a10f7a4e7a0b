"""Exact order statistics without gathering or sorting the column.

The built-in exact median keeps every distinct value in one task's memory.
Here each pass counts the values per bucket, which combines map-side and
returns one small row per bucket, then goes on inside the one bucket that
holds the wanted rank until few values are left. The first pass uses a
logarithmic scale, so that far outliers cannot crowd the rest into a single
bucket; later passes divide what is then a narrow interval evenly.
"""

from __future__ import annotations

from math import floor, inf, isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEW_ROWS = 50_000
BUCKETS = 1024


def _log_scale(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def _even_scale(x: Column) -> Column:
    return x


def _neighbours(
    values: DataFrame, rank: int, rows: int, low: float, high: float, few_rows: int
) -> tuple[float, float | None]:
    """The value with ``rank`` values before it in sorted order, and the one that follows."""
    scale, inside, before, following = _log_scale, values, 0, None
    while rows > few_rows and low < high:
        x, a, b = scale(F.col("x")), scale(F.lit(low)), scale(F.lit(high))
        at = F.least(F.floor((x - a) / (b - a) * F.lit(float(BUCKETS))), F.lit(BUCKETS - 1))
        found = (
            inside.groupBy(F.when(b > a, at).otherwise(F.lit(0)).alias("at"))
            .agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
            .orderBy("at")
            .collect()
        )
        for i, bucket in enumerate(found):
            if rank < before + bucket.n:
                break
            before += bucket.n
        if i + 1 < len(found):
            following = found[i + 1].low
        rows, low, high = bucket.n, bucket.low, bucket.high
        inside = values.where(F.col("x").between(low, high))
        scale = _even_scale
    if low == high:
        return low, (low if rank + 1 < before + rows else following)
    few = F.sort_array(F.collect_list("x"))
    pair = inside.agg(few.alias("few")).select(
        F.get("few", F.lit(rank - before)), F.get("few", F.lit(rank - before + 1))
    )
    value, next_value = pair.first()
    return value, (following if next_value is None else next_value)


def exact_quantile(
    df: DataFrame,
    column: str,
    share: float = 0.5,
    few_rows: int = FEW_ROWS,
    known: tuple[int, float, float] | None = None,
) -> float | None:
    """Quantile with linear interpolation between neighbours; nulls and NaN are left out.

    Infinite values take their place at the ends. ``known`` takes count,
    minimum and maximum where an earlier pass found them.
    """
    x = F.col(column).cast("double")
    values = df.where(x.isNotNull() & ~F.isnan(x)).select(x.alias("x"))
    below = above = 0
    if known is None or not all(isfinite(k) for k in known if k is not None):
        finite = F.when(F.abs("x") < inf, F.col("x"))
        *known, below, above = values.agg(
            F.count(finite), F.min(finite), F.max(finite), F.count_if(F.col("x") == -inf), F.count_if(F.col("x") == inf)
        ).first()
        values = values.where(F.abs("x") < inf)
    rows, low, high = known
    if below + rows + above == 0:
        return None
    position = (below + rows + above - 1) * share
    rank = floor(position)
    value = following = inf
    if rank < below:
        value, following = -inf, (-inf if rank + 1 < below else low if rows else inf)
    elif rank < below + rows:
        value, following = _neighbours(values, rank - below, rows, low, high, few_rows)
        following = inf if following is None else following
    if position == rank or value == following:
        return value
    return value + (following - value) * (position - rank)
