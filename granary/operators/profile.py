"""Profiling: counts, describe, correlation, trend, histograms, growth.

Each function is one aggregation pass. Long-form results are unfolded from
the one result row, so k columns never cost k scans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.aggregates import Measure, both, exact_mean, pearson
from granary.functions.cleaning import as_column


def unfold(df: DataFrame, rows: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Aggregate once into structs and turn them into rows, per group if ``by`` is given."""
    return df.groupBy(*by).agg(F.array(*rows).alias("rows")).select(*by, F.inline("rows"))


def global_mean(df: DataFrame, means: Mapping[str, str | Column], scale: int | None = None) -> DataFrame:
    """One row of means; ``scale`` names the decimal places of fixed-point columns, which are then summed exactly."""
    mean = F.avg if scale is None else lambda c: exact_mean(c, scale)
    return df.agg(*[mean(as_column(c)).alias(n) for n, c in means.items()])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, n_rows); parquet counts come from footers."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def volume_summary(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """(dataset, n_rows, ratio_to_real) for real, synthetic and combined rows."""
    return volumes(row_counts({"real": real, "synthetic": synthetic}))


def volumes(n: DataFrame) -> DataFrame:
    """The same from (dataset, n_rows) of the real and the synthetic rows."""
    total = n.agg(
        F.sum(F.when(F.col("dataset") == "real", F.col("n_rows"))).alias("r"),
        F.sum(F.when(F.col("dataset") == "synthetic", F.col("n_rows"))).alias("s"),
    )
    rows = [
        F.struct(F.lit(name).alias("dataset"), count.alias("n_rows"))
        for name, count in (
            ("real", F.col("r")),
            ("synthetic", F.col("s")),
            ("combined", F.col("r") + F.col("s")),
        )
    ]
    out = total.select("r", F.inline(F.array(*rows)))
    ratio = F.try_divide(F.col("n_rows").cast("double"), F.col("r").cast("double"))
    return out.select("dataset", "n_rows", ratio.alias("ratio_to_real"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_distinct), nulls not counted; hand in a table.

    Every column is grouped on its own, so a columnar table is read once in all, no row is expanded, and what is shuffled are the
    distinct values that each task has found.
    """
    one = [
        df.select(F.col(c).alias("value")).where(F.col("value").isNotNull()).distinct()
        .agg(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_distinct"))
        for c in columns
    ]
    return reduce(DataFrame.unionAll, one)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_nulls) for all columns in one pass."""
    return unfold(
        df,
        [
            F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("n_nulls"))
            for c in columns or df.columns
        ],
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """(ordinal, column, type, n_rows, n_nulls) for every column."""
    return unfold(
        df,
        [
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(name).alias("column"),
                F.lit(kind).alias("type"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col(name).isNull()).alias("n_nulls"),
            )
            for i, (name, kind) in enumerate(df.dtypes, start=1)
        ],
    )


def describe_numeric(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), digits: int | None = None
) -> DataFrame:
    """(column, n, mean, stddev, min, max), typed, sample standard deviation."""

    def told(value: Column) -> Column:
        return value if digits is None else F.round(value, digits)

    rows = []
    for c in columns:
        x = F.col(c).cast("double")
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("n"),
                told(F.avg(x)).alias("mean"),
                told(F.stddev_samp(x)).alias("stddev"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            )
        )
    return unfold(df, rows, by)


def value_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``min_c`` and ``max_c`` of every column."""
    return df.agg(
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    )


def joint_extent(df: DataFrame, a: str | Column, b: str | Column) -> DataFrame:
    """Smallest and largest value over both columns."""
    x, y = as_column(a), as_column(b)
    return df.agg(
        F.least(F.min(x), F.min(y)).alias("low"), F.greatest(F.max(x), F.max(y)).alias("high")
    )


def value_counts(df: DataFrame, value: str | Column, name: str = "value") -> DataFrame:
    return df.groupBy(as_column(value).alias(name)).agg(F.count("*").alias("n"))


FLAT = 1e-14  # a spread below this share of its squares is that of a constant column


def correlation_columns(columns: Sequence[str]) -> list[Column]:
    """Aggregates r_i_j (i <= j); each unordered pair is computed once."""
    pairs = combinations_with_replacement(enumerate(columns), 2)
    return [pearson(a, b).alias(f"r_{i}_{j}") for (i, a), (j, b) in pairs]


def correlation_pairs(columns: Sequence[str]) -> list[tuple[str, str, Column]]:
    """(row, col, r) for all ordered pairs over the aggregates of ``correlation_columns``."""
    return [
        (a, b, F.col(f"r_{min(i, j)}_{max(i, j)}"))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """(row, col, r) for all ordered pairs."""
    rows = [
        F.struct(
            F.lit(a).alias("row"),
            F.lit(b).alias("col"),
            (r if digits is None else F.round(r, digits)).alias("r"),
        )
        for a, b, r in correlation_pairs(columns)
    ]
    return df.agg(*correlation_columns(columns)).select(F.inline(F.array(*rows)))


def wide_correlations(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """(row, col, r) for all ordered pairs of many columns, over the rows where both are there; null for a constant one.

    Two passes, whatever the number of columns: one for their means, one for the product of the matrix [x, x * x, there] with itself,
    which MLlib adds up in a tree. The result has nine numbers a pair, so the driver holds what the answer itself takes.
    """
    names, k = list(columns), len(columns)
    numbers = [F.col(c).cast("double") for c in names]
    means = df.agg(*[F.avg(F.when(~F.isnan(x), x)).alias(f"m{i}") for i, x in enumerate(numbers)]).first()
    usable = [x.isNotNull() & ~F.isnan(x) for x in numbers]
    centered = [F.when(ok, x - F.lit(float(m or 0.0))).otherwise(0.0) for x, ok, m in zip(numbers, usable, means)]
    parts = [*centered, *[c * c for c in centered], *[ok.cast("double") for ok in usable]]
    rows = MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(F.array(*parts)).alias("v")), "v")
    gram = RowMatrix(rows).computeGramianMatrix().toArray()
    x, square, there = slice(0, k), slice(k, 2 * k), slice(2 * k, 3 * k)
    n, product = gram[there, there], gram[x, x]
    total, squares = gram[x, there], gram[square, there]  # of column i over the rows where column j is there
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = squares - total * total / n
        spread = np.where(spread > squares * FLAT, spread, 0.0)
        r = (product - total * total.T / n) / np.sqrt(spread * spread.T)
    told = [(a, b, float(r[i, j]) if np.isfinite(r[i, j]) else None) for i, a in enumerate(names) for j, b in enumerate(names)]
    out = df.sparkSession.createDataFrame(told, "row string, col string, r double")
    return out if digits is None else out.withColumn("r", F.round("r", digits))


def feature_target_correlation(
    df: DataFrame, features: Sequence[str], target: str, digits: int | None = None
) -> DataFrame:
    def told(value: Column) -> Column:
        return value if digits is None else F.round(value, digits)

    return unfold(
        df,
        [F.struct(F.lit(f).alias("feature"), told(pearson(f, target)).alias("r")) for f in features],
    )


def trend_columns(feature: str, target: str) -> tuple[Column, Column]:
    """Aggregates slope and intercept of the target on the feature."""
    x, y = both(feature, target)
    return F.regr_slope(y, x), F.regr_intercept(y, x)


def linear_trend(
    df: DataFrame, feature: str, target: str, by: Sequence[str] = (), digits: int | None = None
) -> DataFrame:
    """Slope and intercept of the target on the feature; null where the feature is constant."""
    slope, intercept = trend_columns(feature, target)
    if digits is not None:
        slope, intercept = F.round(slope, digits), F.round(intercept, digits)
    return df.groupBy(*by).agg(slope.alias("slope"), intercept.alias("intercept"))


def with_trend(df: DataFrame, feature: str, target: str, name: str = "trend") -> DataFrame:
    """Each row with the value of the table's linear trend at its feature."""
    line = linear_trend(df, feature, target)
    slope, intercept = line.select("slope").scalar(), line.select("intercept").scalar()
    return df.withColumn(name, intercept + slope * F.col(feature))


def histogram(df: DataFrame, column: str, bins: int, density: bool = False) -> DataFrame:
    """(bin, lower, upper, n[, density]) over equal widths; empty bins are there with 0.

    Bins include their lower end, the last one its upper end too. A constant
    column gets a range of width one around its value.
    """
    x = F.col(column).cast("double")
    ends = histogram_ends(df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n")), "lo", "hi", "n")
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    placed = df.where(x.isNotNull()).select(bin_index(x, lo, hi, bins).alias("bin"))
    return histogram_table(ends, placed.groupBy("bin").agg(F.count("*").alias("n")), bins, density)


def histogram_ends(row: DataFrame, low: str, high: str, n: str) -> DataFrame:
    """One row (lo, hi, n) of a histogram from a row of aggregates."""
    lo, hi = F.col(low).cast("double"), F.col(high).cast("double")
    return row.select(
        F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"), F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi"), F.col(n).alias("n")
    )


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    return F.least(F.floor((x - lo) / ((hi - lo) / F.lit(float(bins)))).cast("int") + 1, F.lit(bins))


def bin_counts(df: DataFrame, wanted: Mapping[str, tuple[str, int, DataFrame]]) -> DataFrame:
    """(name, bin, n) of many histograms from one pass: for each name its column, its bins and its ends."""
    rows = [
        F.struct(
            F.lit(name).alias("name"),
            bin_index(F.col(c).cast("double"), ends.select("lo").scalar(), ends.select("hi").scalar(), bins).alias("bin"),
        )
        for name, (c, bins, ends) in wanted.items()
    ]
    placed = df.select(F.inline(F.array(*rows))).where(F.col("bin").isNotNull())
    return placed.groupBy("name", "bin").agg(F.count("*").alias("n"))


def histogram_table(ends: DataFrame, counted: DataFrame, bins: int, density: bool = False) -> DataFrame:
    """All bins of a histogram from its ends and the counts (bin, n) of the bins that have rows."""
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    frame = ends.sparkSession.range(1, bins + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    frame = frame.withColumns({"lo": lo, "hi": hi})
    edge = lambda i: F.col("lo") + i * width
    out = frame.join(counted, "bin", "left").select(
        "bin",
        edge(F.col("bin") - 1).alias("lower"),
        edge(F.col("bin")).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        width.alias("width"),
    )
    if not density:
        return out.drop("width")
    total = ends.select("n").scalar()
    return out.withColumn(
        "density", F.try_divide(F.col("n").cast("double"), total.cast("double") * F.col("width"))
    ).drop("width")


def growth_rate(df: DataFrame, year: str, amount: Measure) -> DataFrame:
    """First and last year, their totals, and the compound yearly growth between them in percent."""
    totals = df.groupBy(year).agg(amount.direct())
    pair = F.struct(F.col(year).alias("year"), F.col(amount.name).alias("total"))
    ends = totals.where(F.col(year).isNotNull()).agg(F.min(pair).alias("first"), F.max(pair).alias("last"))
    years = (F.col("last.year") - F.col("first.year")).cast("double")
    rate = F.pow(F.try_divide(F.col("last.total"), F.col("first.total")), F.try_divide(F.lit(1.0), years))
    return ends.select(
        F.col("first.year").alias("first_year"),
        F.col("last.year").alias("last_year"),
        F.col("first.total").alias("first_total"),
        F.col("last.total").alias("last_total"),
        ((rate - 1.0) * 100.0).alias("growth_pct"),
    )
