"""Synthetic rows drawn on the executors from ranges observed in real rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.functions.cleaning import as_column
from granary.functions.draws import integer_between, normal, uniform, uniform_between
from granary.functions.scoring import clamp
from granary.operators.profile import describe_numeric
from granary.operators.shaping import unite
from granary.sources.workspace import settle

INDEX_BUCKETS_HEX = 3  # 4096 buckets
ROWS_PER_TASK = 4_000_000


@dataclass(frozen=True)
class RangeRule:
    """Widening of an observed range: the ends are scaled, then kept within floor and ceiling."""

    column: str
    low_factor: float
    high_factor: float
    floor: float | None = None
    ceiling: float | None = None
    whole: bool = False  # drawn values are cut to whole numbers


def derive_ranges(df: DataFrame, rules: Sequence[RangeRule]) -> DataFrame:
    """One row with ``<column>_low`` and ``<column>_high`` per rule, from one min/max pass."""
    out = []
    for r in rules:
        x = F.col(r.column).cast("double")
        out.append(clamp(F.min(x) * F.lit(r.low_factor), r.floor, None).alias(f"{r.column}_low"))
        out.append(clamp(F.max(x) * F.lit(r.high_factor), None, r.ceiling).alias(f"{r.column}_high"))
    return df.agg(*out)


def number_values(df: DataFrame, column: str, index: str = "index") -> tuple[DataFrame, int]:
    """Distinct values numbered 1..k in the order of (md5 prefix, value), and k.

    Numbers run within hash buckets, each offset by the buckets before it.
    Only the counts of the 4096 buckets pass through the driver, never the values.
    """
    bucket = F.substring(F.md5(F.col(column).cast("string")), 1, INDEX_BUCKETS_HEX)
    distinct = df.where(F.col(column).isNotNull()).select(column).distinct()
    values = settle(distinct.withColumn("__bucket", bucket), "values")
    offsets, total = [], 0
    for row in values.groupBy("__bucket").agg(F.count("*").alias("n")).orderBy("__bucket").collect():
        offsets.append((row["__bucket"], total))
        total += row.n
    before = df.sparkSession.createDataFrame(offsets, "__bucket string, __offset bigint")
    within = F.row_number().over(Window.partitionBy("__bucket").orderBy(column))
    numbered = values.withColumn("__at", within).join(before, "__bucket")
    return numbered.select((F.col("__offset") + F.col("__at")).cast("bigint").alias(index), column), total


def draw_rows(
    spark: SparkSession,
    n: int,
    ranges: DataFrame,
    rules: Sequence[RangeRule],
    categories: DataFrame,
    category: str,
    year: str = "year",
    years: tuple[int, int] = (1990, 2025),
    salt: str = "42",
    id_column: str = "id",
) -> DataFrame:
    """n rows: a uniform category, a whole year (upper end excluded) and a uniform value per rule.

    Rows come from ``spark.range`` and hashes of their id, so they need no
    driver memory and a retried task draws the same rows. The range ends are
    scalar subqueries. The numbered categories are settled, so their true size
    has them broadcast and the rows stay where they are made; both sides are
    shuffled only where the categories are too many for that.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    named, k = number_values(categories, category, "__pick")
    named = settle(named, "numbered")
    ident = F.col(id_column)
    slices = max(spark.sparkContext.defaultParallelism, n // ROWS_PER_TASK + 1)
    drawn = spark.range(0, n, 1, slices).withColumnRenamed("id", id_column).select(
        ident,
        (F.lit(1) + F.floor(uniform(ident, f"{salt}:row", 0) * float(k))).cast("bigint").alias("__pick"),
        integer_between(uniform(ident, f"{salt}:row", 1), *years).alias(year),
        *[
            _drawn(r, uniform(ident, f"{salt}:values{i // 2}", i % 2), ranges)
            for i, r in enumerate(rules)
        ],
    )
    out = drawn.join(named, "__pick")
    return out.select(id_column, category, year, *[r.column for r in rules])


def _drawn(rule: RangeRule, unit: Column, ranges: DataFrame) -> Column:
    low, high = (ranges.select(f"{rule.column}_{end}").scalar() for end in ("low", "high"))
    value = uniform_between(unit, low, high)
    return (value.cast("bigint") if rule.whole else value).alias(rule.column)


def noise_for(id_column: str, salt: str = "42") -> Column:
    return normal(uniform(id_column, f"{salt}:noise", 0), uniform(id_column, f"{salt}:noise", 1))


def yield_base(
    area: str | Column, rain: str | Column, humidity: str | Column, temperature: str | Column
) -> Column:
    """Expected harvest of an area before category, trend and noise."""
    # Yield per area, rain effect above 1500, humidity optimum 82, temperature optimum 27.
    return (
        as_column(area) * 4.5
        + (as_column(rain) - 1500.0) * 0.8
        + (F.lit(85.0) - F.abs(as_column(humidity) - 82.0)) * 50.0
        + (F.lit(28.0) - F.abs(as_column(temperature) - 27.0)) * 1000.0
    )


def with_target(
    df: DataFrame,
    name: str,
    base: Column,
    multiplier: Column,
    year: str | Column,
    noise: Column | None = None,
    noise_share: float = 0.1,
    year_step: float = 500.0,
    base_year: int = 2000,
    minimum: int = 1000,
) -> DataFrame:
    """Target = whole part of base * multiplier + yearly trend + noise, at least the minimum.

    The noise, if any, is scaled to a share of the base.
    """
    trend = (as_column(year) - F.lit(base_year)) * F.lit(year_step)
    raw = base * multiplier + trend
    if noise is not None:
        raw = raw + noise * (base * F.lit(noise_share))
    return df.withColumn(name, F.greatest(raw.cast("bigint"), F.lit(minimum).cast("bigint")))


def combine_with_real(real: DataFrame, synthetic: DataFrame, source: str | None = None) -> DataFrame:
    """Union by column name; ``source`` adds a column telling real from synthetic rows."""
    if source:
        real = real.withColumn(source, F.lit("real"))
        synthetic = synthetic.withColumn(source, F.lit("synthetic"))
    return unite([real, synthetic])


def compare_sources(
    combined: DataFrame, columns: Sequence[str], source: str = "source", digits: int | None = None
) -> DataFrame:
    """Describe statistics of real and synthetic rows side by side, from one pass."""
    return describe_numeric(combined, columns, by=[source], digits=digits)
