"""Quality scores, error measures, ratings and bands as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.cleaning import as_column

# Report labels and their lower/upper limits.
RATING_STEPS = ((0.9, "Excellent"), (0.8, "Good"), (0.7, "Fair"))
RATING_ELSE = "Poor"
BAND_EDGES = (5.0, 10.0, 20.0)
BAND_LABELS = ("< 5%", "5-10%", "10-20%", "> 20%")
RANGE_LABELS = ("Very Low", "Low", "Medium", "High", "Very High")


def quality_flag(columns: Sequence[str], low: float = 0.5, full: float = 1.0) -> Column:
    """``low`` if any of the columns is null, else ``full``."""
    any_null = reduce(or_, [F.col(c).isNull() for c in columns])
    return F.when(any_null, F.lit(low)).otherwise(F.lit(full))


def quality_fraction(columns: Sequence[str]) -> Column:
    """Share of the columns that are present and positive; 1.0 when there are none to judge."""
    if not columns:
        return F.lit(1.0)
    hits = [F.when(F.col(c) > 0, F.lit(1)).otherwise(F.lit(0)) for c in columns]
    return reduce(add, hits).cast("double") / F.lit(float(len(columns)))


def error_of(actual: str | Column, predicted: str | Column) -> Column:
    return as_column(predicted) - as_column(actual)


def error_percentage(actual: str | Column, predicted: str | Column) -> Column:
    """Absolute error as a percentage of the actual value; null where the actual is zero."""
    return F.try_divide(F.abs(error_of(actual, predicted)), as_column(actual)) * F.lit(100.0)


def rating(score: str | Column) -> Column:
    value = as_column(score)
    ladder = F.when(value > RATING_STEPS[0][0], RATING_STEPS[0][1])
    for limit, label in RATING_STEPS[1:]:
        ladder = ladder.when(value > limit, label)
    return F.when(value.isNotNull(), ladder.otherwise(RATING_ELSE))


def band_index(value: str | Column, edges: Sequence[float] = BAND_EDGES) -> Column:
    """0-based half-open band: below the first edge is 0, at or above the last is ``len(edges)``."""
    v = as_column(value)
    ladder = F.when(v < edges[0], F.lit(0))
    for i, edge in enumerate(edges[1:], start=1):
        ladder = ladder.when(v < edge, F.lit(i))
    return F.when(v.isNotNull(), ladder.otherwise(F.lit(len(edges))))


def clamp(value: str | Column, low: float | Column | None, high: float | Column | None) -> Column:
    out = as_column(value)
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return out


def midpoint(low: str | Column, high: str | Column) -> Column:
    return (as_column(low) + as_column(high)) / F.lit(2.0)
