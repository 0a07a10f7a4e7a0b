"""Judging a prediction table: error columns, metrics, bands, ranges, extremes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.functions.aggregates import mae, r_squared, rmse
from granary.functions.cleaning import as_column
from granary.functions.scoring import (
    BAND_EDGES,
    BAND_LABELS,
    RANGE_LABELS,
    band_index,
    error_of,
    error_percentage,
)
from granary.operators.grouped_quantiles import QUARTILES, grouped_quantiles
from granary.operators.quantiles import exact_quantile
from granary.sources.workspace import settle

ACTUAL, PREDICTED, ERROR, ERROR_PCT, MODEL = "actual", "predicted", "error", "error_pct", "model"


def with_errors(
    df: DataFrame,
    actual: str = ACTUAL,
    predicted: str = PREDICTED,
    error: str = ERROR,
    error_pct: str = ERROR_PCT,
) -> DataFrame:
    """Signed error and absolute percentage error; the latter null where the actual is zero."""
    return df.withColumns(
        {error: error_of(actual, predicted), error_pct: error_percentage(actual, predicted)}
    )


def _told(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def metric_columns(
    actual: str = ACTUAL, predicted: str = PREDICTED, error_pct: str | None = ERROR_PCT, digits: int | None = None
) -> list[Column]:
    """Aggregates n, rmse, mae, r2 and, if the column is named, mean_error_pct."""
    out = [
        F.count(F.lit(1)).alias("n"),
        _told(rmse(actual, predicted), digits).alias("rmse"),
        _told(mae(actual, predicted), digits).alias("mae"),
        _told(r_squared(actual, predicted), digits).alias("r2"),
    ]
    return out + ([_told(F.avg(error_pct), digits).alias("mean_error_pct")] if error_pct else [])


def regression_metrics(df: DataFrame, by: Sequence[str] = (), **how) -> DataFrame:
    """RMSE, MAE, R2 and mean error percentage in one pass, per group if asked."""
    return df.groupBy(*by).agg(*metric_columns(**how))


def model_comparison(df: DataFrame, model: str = MODEL, **how) -> DataFrame:
    """One row of metrics per model of a table that holds the predictions of all of them."""
    return regression_metrics(df, [model], **how)


def best_model(metrics: DataFrame, model: str = MODEL) -> DataFrame:
    """The model with the largest R2; names break ties."""
    return metrics.orderBy(F.col("r2").desc_nulls_last(), model).limit(1)


def error_by(
    df: DataFrame,
    group: str | Column,
    name: str,
    error_pct: str = ERROR_PCT,
    actual: str | None = None,
    digits: int | None = None,
    half_even: bool = False,
) -> DataFrame:
    """Mean error percentage and count per group; with ``actual`` also its mean."""

    def told(value: Column) -> Column:
        if digits is None:
            return value
        return F.bround(value, digits) if half_even else F.round(value, digits)

    out = [told(F.avg(error_pct)).alias("mean_error_pct"), F.count(error_pct).alias("n")]
    if actual:
        out.append(told(F.avg(actual)).alias("mean_actual"))
    return df.groupBy(as_column(group).alias(name)).agg(*out)


def best_and_worst(
    df: DataFrame, category: str, error_pct: str = ERROR_PCT, digits: int | None = None
) -> DataFrame:
    """(which, category, mean_error_pct) of the best and worst group; first in key order on ties.

    Both come from one grouped pass: the extremes are two more minima over group means.
    """
    means = df.groupBy(category).agg(_told(F.avg(error_pct), digits).alias("m")).where(F.col("m").isNotNull())
    ends = means.agg(
        F.min(F.struct(F.col("m").alias("rank"), F.col(category).alias("c"))).alias("best"),
        F.min(F.struct((-F.col("m")).alias("rank"), F.col(category).alias("c"))).alias("worst"),
    )
    rows = [
        F.struct(
            F.lit(which).alias("which"),
            F.col(f"{which}.c").alias(category),
            (F.col(f"{which}.rank") * F.lit(sign)).alias("mean_error_pct"),
        )
        for which, sign in (("best", 1.0), ("worst", -1.0))
    ]
    return ends.select(F.inline(F.array(*rows)))


def band_columns(error_pct: str = ERROR_PCT, edges: Sequence[float] = BAND_EDGES) -> list[Column]:
    """Aggregates band_0, band_1, ...: rows per half-open band."""
    at = band_index(error_pct, edges)
    return [F.count_if(at == i).alias(f"band_{i}") for i in range(len(edges) + 1)]


def band_share(band: int, total: str) -> Column:
    """Percentage of a band counted by ``band_columns``."""
    return F.try_divide(F.col(f"band_{band}") * F.lit(100.0), F.col(total).cast("double"))


def error_bands(
    df: DataFrame,
    error_pct: str = ERROR_PCT,
    edges: Sequence[float] = BAND_EDGES,
    labels: Sequence[str] = BAND_LABELS,
) -> DataFrame:
    """Count and share per band; a band without rows is there with 0.

    The share is of all rows, also those whose error percentage is null.
    """
    return band_table(df.agg(F.count(F.lit(1)).alias("total"), *band_columns(error_pct, edges)), labels)


def band_table(counted: DataFrame, labels: Sequence[str] = BAND_LABELS) -> DataFrame:
    """Bands from one row of their counts."""
    rows = [
        F.struct(
            F.lit(i).alias("band"),
            F.lit(label).alias("label"),
            F.col(f"band_{i}").alias("n"),
            band_share(i, "total").alias("pct"),
        )
        for i, label in enumerate(labels)
    ]
    return counted.select(F.inline(F.array(*rows)))


def range_index(value: Column, low: Column, high: Column, parts: int) -> Column:
    """1-based equal-width range, closed on the right; the minimum belongs to the first range.

    If all values are equal they fall into the middle range.
    """
    ladder = F.when(low == high, F.lit((parts + 1) // 2))
    for i in range(1, parts):
        edge = low + F.lit(float(i)) * ((high - low) / F.lit(float(parts)))
        ladder = ladder.when(value <= edge, F.lit(i))
    return F.when(value.isNotNull(), ladder.otherwise(F.lit(parts)))


def error_by_range(
    df: DataFrame,
    actual: str = ACTUAL,
    error_pct: str = ERROR_PCT,
    labels: Sequence[str] = RANGE_LABELS,
    digits: int | None = 2,
) -> DataFrame:
    """Error statistics in equal-width ranges of the actual value; empty ranges have n = 0."""
    x = F.col(actual).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    placed = df.where(x.isNotNull()).select(
        x.alias("x"),
        F.col(error_pct).alias("e"),
        ends.select("lo").scalar().alias("lo"),
        ends.select("hi").scalar().alias("hi"),
    )
    at = range_index(F.col("x"), F.col("lo"), F.col("hi"), len(labels))
    stats = placed.groupBy(at.alias("range")).agg(
        _told(F.avg("e"), digits).alias("error_mean"),
        _told(F.stddev_samp("e"), digits).alias("error_std"),
        F.count("e").alias("n"),
        _told(F.avg("x"), digits).alias("actual_mean"),
        _told(F.min("x"), digits).alias("actual_min"),
        _told(F.max("x"), digits).alias("actual_max"),
    )
    return labelled_ranges(stats, labels)


def labelled_ranges(stats: DataFrame, labels: Sequence[str] = RANGE_LABELS) -> DataFrame:
    """All ranges with their labels; those without rows have n = 0."""
    names = stats.sparkSession.createDataFrame(list(enumerate(labels, start=1)), "range int, label string")
    return names.join(stats, "range", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


def error_distribution(
    df: DataFrame, error_pct: str = ERROR_PCT, digits: int | None = None
) -> DataFrame:
    """Mean, exact median, sample deviation and the mean +/- 1 and 2 deviation limits, as one row."""
    x = F.col(error_pct).cast("double")
    found = df.agg(F.count(x), F.min(x), F.max(x), F.avg(x), F.stddev_samp(x)).first()
    n, low, high, mean, std = found
    median = exact_quantile(df, error_pct, known=(n, low, high))
    return distribution_row(df.sparkSession, n, mean, median, std, digits)


def distribution_row(spark: SparkSession, n: int, mean: float | None, median: float | None, std: float | None, digits: int | None = None) -> DataFrame:
    """The distribution and its limits as one row."""
    row = spark.createDataFrame([(n, mean, median, std)], "n bigint, mean double, median double, std double")
    m, s = F.col("mean"), F.col("std")
    limits = {"minus_1_std": m - s, "plus_1_std": m + s, "two_std": s * 2.0}
    out = row.withColumns(limits)
    return out.select("n", *[_told(F.col(c), digits).alias(c) for c in out.columns if c != "n"])


def error_distribution_by(
    df: DataFrame, by: Sequence[str], error_pct: str = ERROR_PCT, digits: int | None = None
) -> DataFrame:
    """(by..., n, mean, std, min, q1, median, q3, max) of the error percentage of every group; hand in a settled table.

    Quartiles are exact, in passes whose number does not depend on the number of groups. A group without values is there with n = 0.
    """
    x = F.col(error_pct).cast("double")
    usable = F.when(~F.isnan(x), x)
    stats = df.groupBy(*by).agg(
        F.count(usable).alias("n"), F.avg(usable).alias("mean"), F.stddev_samp(usable).alias("std"), F.min(usable).alias("min"), F.max(usable).alias("max")
    )
    quartiles = grouped_quantiles(df, by, error_pct, QUARTILES).drop("n").withColumnsRenamed({c: f"__{i}" for i, c in enumerate(by)})
    on = [F.col(c).eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(by)]
    joined = stats.join(quartiles, on, "left") if by else stats.join(quartiles, F.lit(True), "left")
    return joined.select(*by, "n", *[_told(F.col(c), digits).alias(c) for c in ("mean", "std", "min", "q1", "median", "q3", "max")])


def extreme_predictions(
    df: DataFrame, columns: Sequence[str], error_pct: str = ERROR_PCT, n: int = 10, worst: bool = True
) -> DataFrame:
    """The n largest (or smallest) errors; the shown columns break ties, nulls never rank."""
    first = F.col(error_pct).desc() if worst else F.col(error_pct).asc()
    ranked = df.where(F.col(error_pct).isNotNull()).select(*columns, error_pct)
    return ranked.orderBy(first, *[c for c in columns if c != error_pct]).limit(n)


def both_extremes(
    df: DataFrame, columns: Sequence[str], error_pct: str, n: int, parts: DataFrame, least: str, most: str
) -> DataFrame:
    """The written rows (which, shown columns, error) of the n best and the n worst predictions, from one pass.

    ``parts`` has the smallest and largest error of each of many groups that the rows fall into. The n-th
    smallest of the minima is no smaller than the n-th smallest error, so rows beyond it are passed over, likewise at the other end.
    """
    e = F.col(error_pct)
    ends = {}
    for name, column, first in (("low", least, F.col(least).asc()), ("high", most, F.col(most).desc())):
        edge = parts.where(F.col(column).isNotNull()).orderBy(first).limit(n).select(F.col(column).alias("e"))
        last = F.max("e") if name == "low" else F.min("e")
        ends[name] = edge.agg(F.when(F.count(F.lit(1)) == n, last).alias("end")).select("end").scalar()
    near = df.select(*columns, error_pct, ends["low"].alias("__low"), ends["high"].alias("__high")).where(e.isNotNull())
    is_best = F.col("__low").isNull() | (e <= F.col("__low"))
    is_worst = F.col("__high").isNull() | (e >= F.col("__high"))
    sides = F.filter(F.array(F.when(is_best, "best"), F.when(is_worst, "worst")), lambda w: w.isNotNull())
    told = near.select(F.explode(sides).alias("which"), *columns, error_pct)
    order = F.when(F.col("which") == "best", e).otherwise(-e)
    place = F.row_number().over(Window.partitionBy("which").orderBy(order, *[c for c in columns if c != error_pct]))
    return settle(told.withColumn("place", place).where(F.col("place") <= n), "extremes")


def residual_points(
    df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED, residual: str = "residual"
) -> DataFrame:
    return df.select(predicted, error_of(actual, predicted).alias(residual))
