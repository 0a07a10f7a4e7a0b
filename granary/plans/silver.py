"""Bronze to silver: cleaning of measurements and facts, and validation of the outcome."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.cleaning import code_to_name, parse_day
from granary.functions.scoring import quality_flag, quality_fraction
from granary.operators.filters import drop_all_null, positive_or_null
from granary.operators.impute import impute_group_mean
from granary.operators.joins import reconcile_keys
from granary.operators.shaping import clean_numbers, present, rename, stamp, standardize_keys

SCORE, STAMP = "data_quality_score", "processed_at"


@dataclass(frozen=True)
class MeasurementSpec:
    """How dated measurements of many sources are cleaned."""

    names: Mapping[str, str]
    code: str
    category: str
    code_names: Mapping[str, str]
    date: str | None
    numeric: Sequence[str]
    score_on: Sequence[str]
    keep_if_any: Sequence[str]
    decimal: str = "."
    group: str | None = None
    score_before_fill: bool = False
    scale: int | None = None


def clean_measurements(
    df: DataFrame, spec: MeasurementSpec, as_of: datetime | str | None = None
) -> DataFrame:
    """Name, rename, parse, impute per source, score, stamp, drop rows without any key value.

    Order matters: the score judges the values after imputation (unless the
    spec asks otherwise), and rows are dropped last.
    """
    out = rename(df, spec.names)
    out = out.withColumn(spec.category, code_to_name(spec.code, spec.code_names))
    if spec.date and spec.date in out.columns and dict(out.dtypes)[spec.date] == "string":
        out = out.withColumn(spec.date, parse_day(spec.date))
    out = clean_numbers(out, spec.numeric, decimal=spec.decimal, group=spec.group)
    judged = present(out, spec.score_on)
    flag = quality_flag(judged) if len(judged) == len(spec.score_on) else F.lit(0.5)
    if spec.score_before_fill:
        out = out.withColumn(SCORE, flag)
    out = impute_group_mean(out, spec.numeric, spec.code, spec.scale)
    if not spec.score_before_fill:
        out = out.withColumn(SCORE, flag)
    return drop_all_null(stamp(out, STAMP, as_of), spec.keep_if_any)


@dataclass(frozen=True)
class FactSpec:
    """How yearly facts of one source are cleaned."""

    names: Mapping[str, str]
    key: str
    numeric: Sequence[str]
    positive: str
    decimal: str = ","
    group: str | None = None
    signed: bool = False
    aliases: Mapping[str, str] = field(default_factory=dict)
    leave_out: Sequence[str] = ()  # standard names of rows that are no category of their own, such as totals


def clean_facts(df: DataFrame, spec: FactSpec, as_of: datetime | str | None = None) -> DataFrame:
    """Rename, standardise keys, parse, drop non-positive rows, score, stamp. Narrow throughout."""
    out = standardize_keys(rename(df, spec.names), [spec.key], spec.aliases)
    if spec.leave_out:
        out = out.where(F.col(spec.key).isNull() | ~F.col(spec.key).isin(*spec.leave_out))
    out = clean_numbers(out, spec.numeric, decimal=spec.decimal, group=spec.group, signed=spec.signed)
    if spec.positive in out.columns:
        out = positive_or_null(out, spec.positive)
    out = out.withColumn(SCORE, quality_fraction(present(out, spec.numeric)))
    return stamp(out, STAMP, as_of)


def table_checks(df: DataFrame, dataset: str, category: str | None, nulls_of: Sequence[str]) -> DataFrame:
    """(dataset, metric, value) of one table from a single aggregation."""
    checks = {"n_rows": F.count(F.lit(1))}
    if category and category in df.columns:
        checks["n_categories"] = F.count_distinct(category)
    checks["n_columns"] = F.lit(len(df.columns))
    for c in present(df, nulls_of):
        checks[f"nulls_{c}"] = F.count_if(F.col(c).isNull())
    if SCORE in df.columns:
        checks["mean_quality"] = F.avg(SCORE)
    row = df.agg(*[c.cast("double").alias(n) for n, c in checks.items()])
    rows = [
        F.struct(F.lit(dataset).alias("dataset"), F.lit(n).alias("metric"), F.col(n).alias("value"))
        for n in checks
    ]
    return row.select(F.inline(F.array(*rows)))


def validate_silver(
    measurements: DataFrame,
    facts: DataFrame,
    category: str,
    fact_key: str,
    nulls_of: Sequence[str] = (),
    fact_nulls_of: Sequence[str] = (),
) -> DataFrame:
    """Checks of both tables plus how many of their keys agree, as (dataset, metric, value)."""
    status = reconcile_keys(measurements, category, facts, fact_key)
    agreed = status.agg(
        *[
            F.count_if(F.col("status") == s).cast("double").alias(s)
            for s in ("both", "left_only", "right_only")
        ]
    )
    rows = [
        F.struct(
            F.lit("keys").alias("dataset"),
            F.lit(f"keys_{s}").alias("metric"),
            F.col(s).alias("value"),
        )
        for s in ("both", "left_only", "right_only")
    ]
    return reduce(
        DataFrame.unionByName,
        [
            table_checks(measurements, "measurements", category, nulls_of),
            table_checks(facts, "facts", fact_key, fact_nulls_of),
            agreed.select(F.inline(F.array(*rows))),
        ],
    )
