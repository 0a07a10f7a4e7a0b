"""Aggregate expressions that combine map-side, and measures that can be merged in two steps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.cleaning import as_column


LOW_BITS = 20


def fixed_parts(value: str | Column, scale: int) -> tuple[Column, Column]:
    """A fixed-point value as whole units of its last digit, split into high and low bits.

    Adding whole numbers makes a sum independent of the order of rows. As two
    64-bit sums it costs hardly more than adding doubles, a third of adding
    decimals, and holds some 10^12 rows in a group; ANSI mode reports an
    overflow beyond that. A value with more than ``scale`` decimal places fails: it would be rounded unseen.
    """
    x, unit = as_column(value).cast("double"), F.lit(float(10**scale))
    units = F.rint(x * unit)
    more = F.raise_error(F.format_string(f"%s has more than {scale} decimal places", x.cast("string"))).cast("double")
    units = F.when(x.isNull() | (units / unit == x), units).otherwise(more).cast("bigint")
    return F.shiftright(units, LOW_BITS), units.bitwiseAND(F.lit((1 << LOW_BITS) - 1))


def from_parts(high: Column, low: Column, scale: int) -> Column:
    """The double nearest to a total whose high and low parts were summed."""
    total = high.cast("decimal(20,0)") * F.lit(1 << LOW_BITS) + low.cast("decimal(20,0)")
    return total.cast("double") / F.lit(float(10**scale))


def exact_sum(value: str | Column, scale: int) -> Column:
    """Sum of fixed-point values that no row order can change."""
    high, low = fixed_parts(value, scale)
    return from_parts(F.sum(high), F.sum(low), scale)


def exact_mean(value: str | Column, scale: int) -> Column:
    return F.try_divide(exact_sum(value, scale), F.count(as_column(value)).cast("double"))


def both(a: str | Column, b: str | Column) -> tuple[Column, Column]:
    """The two columns, null unless both are present (pairwise-complete rows)."""
    x, y = as_column(a).cast("double"), as_column(b).cast("double")
    return F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)


def pearson(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over pairwise-complete rows; null for a constant column."""
    x, y = both(a, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def rmse(actual: str | Column, predicted: str | Column) -> Column:
    e = as_column(predicted) - as_column(actual)
    return F.sqrt(F.avg(e * e))


def mae(actual: str | Column, predicted: str | Column) -> Column:
    return F.avg(F.abs(as_column(predicted) - as_column(actual)))


def r_squared(actual: str | Column, predicted: str | Column) -> Column:
    """1 - SSE/SST in one pass, SST about the mean of the rows judged; null for a constant actual."""
    y, p = both(actual, predicted)
    residual = p - y
    return F.lit(1.0) - F.try_divide(F.avg(residual * residual), F.var_pop(y))


@dataclass(frozen=True)
class Measure:
    """One aggregated output column.

    ``how`` is mean, sum, min or max. ``scale`` names the decimal places of a
    fixed-point input, which is then summed exactly. ``digits`` rounds the
    result. Every kind splits into partials that merge, so a hot key can be
    shrunk before it is shuffled.
    """

    name: str
    source: str | Column
    how: str = "mean"
    digits: int | None = 2
    scale: int | None = None

    def _parts(self) -> dict[str, tuple[str, Column]]:
        """Partial aggregates by name: the function that builds and merges them, and its input."""
        value = as_column(self.source)
        if self.how in ("min", "max"):
            return {"part": (self.how, value)}
        if self.scale is None:
            parts = {"sum": ("sum", value)}
        else:
            high, low = fixed_parts(value, self.scale)
            parts = {"high": ("sum", high), "low": ("sum", low)}
        return parts | ({"n": ("count", value)} if self.how == "mean" else {})

    def _finish(self, parts: dict[str, Column]) -> Column:
        if "part" in parts:
            result = parts["part"]
        elif self.scale is None:
            result = parts["sum"].cast("double")
        else:
            result = from_parts(parts["high"], parts["low"], self.scale)
        if "n" in parts:
            result = F.try_divide(result, parts["n"].cast("double"))
        return (result if self.digits is None else F.round(result, self.digits)).alias(self.name)

    def direct(self) -> Column:
        """The measure over rows."""
        return self._finish({k: getattr(F, f)(c) for k, (f, c) in self._parts().items()})

    def partials(self) -> list[Column]:
        """Columns of a first grouping, to be merged by a second one."""
        return [getattr(F, f)(c).alias(f"__{self.name}_{k}") for k, (f, c) in self._parts().items()]

    def merged(self) -> Column:
        """The measure over partials; counts are merged by adding."""
        merge = {k: F.sum if f == "count" else getattr(F, f) for k, (f, _) in self._parts().items()}
        return self._finish({k: f(f"__{self.name}_{k}") for k, f in merge.items()})


def moments(value: str | Column, name: str) -> list[Column]:
    """Aggregates ``name``_n, _mean and _m2 (sum of squared distances from the mean), which ``merged_moments`` can put together."""
    x = as_column(value).cast("double")
    n = F.count(x)
    return [n.alias(f"{name}_n"), F.avg(x).alias(f"{name}_mean"), (F.var_pop(x) * n).alias(f"{name}_m2")]


def merged_moments(parts: DataFrame, name: str, by: Sequence[str] = ()) -> tuple[DataFrame, Column, Column, Column]:
    """Parts made ready to be grouped by ``by``, and the aggregates n, mean and sample deviation of the whole.

    Distances are taken from the whole's own mean, so nothing cancels out.
    """
    of = Window.partitionBy(*(by or [F.lit(0)]))
    n, mean = F.col(f"{name}_n"), F.col(f"{name}_mean")
    center = F.try_divide(F.sum(n * mean).over(of), F.sum(n).over(of).cast("double"))
    ready = parts.withColumn(f"{name}_center", center)
    gap = mean - F.col(f"{name}_center")
    square = F.sum(F.col(f"{name}_m2") + n * gap * gap)
    return ready, F.sum(n), F.first(f"{name}_center"), F.sqrt(F.try_divide(square, F.nullif(F.sum(n) - 1, F.lit(0)).cast("double")))
