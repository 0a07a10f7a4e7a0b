"""The analysis pack and the summary report, as tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.aggregates import Measure, merged_moments, moments
from granary.functions.cleaning import as_column
from granary.functions.scoring import BAND_LABELS, RANGE_LABELS, rating
from granary.operators import accuracy as acc
from granary.operators.profile import (
    bin_counts,
    bin_index,
    correlation_columns,
    correlation_pairs,
    growth_rate,
    histogram_ends,
    histogram_table,
    joint_extent,
    trend_columns,
    volumes,
)
from granary.operators.quantiles import exact_quantile
from granary.sources.workspace import settle

BINS, TOP, SPREAD = 50, 10, 64  # bins of the error histogram, extremes shown, parts of a category and year


def accuracy_pack(
    predictions: DataFrame,
    category: str,
    year: str | Column,
    shown: Sequence[str],
    actual: str = acc.ACTUAL,
    error_pct: str = acc.ERROR_PCT,
) -> dict[str, DataFrame]:
    """The accuracy tables of one prediction set; hand in a settled table.

    Three passes over the predictions, those for the exact median aside. The first groups by category, year and a hash of the
    shown columns, which gives all sums, ends and bands; the second, knowing the ends, groups by range of the actual value and
    bin of the error; the third picks the extremes, most rows being out of the question by the ends of the groups.
    """
    spark, e, x = predictions.sparkSession, F.col(error_pct).cast("double"), F.col(actual).cast("double")
    sums = {"e": F.sum(error_pct), "n": F.count(error_pct), "a": F.sum(actual), "an": F.count(actual), "total": F.count(F.lit(1)),
            "low": F.min(e), "high": F.max(e), "actual_low": F.min(x), "actual_high": F.max(x)}
    groups = settle(
        predictions.groupBy(F.col(category).alias("category"), as_column(year).alias("year"), F.pmod(F.xxhash64(*shown), F.lit(SPREAD)).alias("part"))
        .agg(*[c.alias(n) for n, c in sums.items()], *moments(e, "error"), *acc.band_columns(error_pct)),
        "error-groups",
    )
    mean_error = F.try_divide(F.sum("e").cast("double"), F.sum("n").cast("double")).alias("mean_error_pct")
    mean_actual = F.round(F.try_divide(F.sum("a").cast("double"), F.sum("an").cast("double")), 2).alias("mean_actual")
    by_category = groups.groupBy(F.col("category").alias(category)).agg(mean_error, F.sum("n").alias("n"), mean_actual)
    bands = [f"band_{i}" for i in range(len(BAND_LABELS))]
    ready, _, mean, std = merged_moments(groups, "error")
    ends = [F.min("low").alias("low"), F.max("high").alias("high"), F.min("actual_low").alias("actual_low"), F.max("actual_high").alias("actual_high")]
    counts = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "total", *bands)]
    whole = settle(ready.agg(*counts, *ends, mean.alias("mean"), std.alias("std")), "whole")
    found = whole.first()
    median = exact_quantile(predictions, error_pct, known=(found.n, found.low, found.high))
    bin_ends = histogram_ends(whole, "low", "high", "n")
    placed = predictions.select(
        x.alias("x"), e.alias("e"),
        acc.range_index(x, whole.select("actual_low").scalar(), whole.select("actual_high").scalar(), len(RANGE_LABELS)).alias("range"),
        bin_index(e, bin_ends.select("lo").scalar(), bin_ends.select("hi").scalar(), BINS).alias("bin"),
    )
    cells = settle(placed.groupBy("range", "bin").agg(*moments("e", "error"), *moments("x", "actual"), F.min("x").alias("low"), F.max("x").alias("high")), "error-cells")
    ready, n, mean, std = merged_moments(cells.where("range is not null"), "error", ["range"])
    ready, _, actual_mean, _ = merged_moments(ready, "actual", ["range"])
    ranges = ready.groupBy("range").agg(
        F.round(mean, 2).alias("error_mean"), F.round(std, 2).alias("error_std"), n.alias("n"), F.round(actual_mean, 2).alias("actual_mean"),
        F.round(F.min("low"), 2).alias("actual_min"), F.round(F.max("high"), 2).alias("actual_max"),
    )
    bins = cells.where("bin is not null").groupBy("bin").agg(F.sum("error_n").alias("n"))
    extremes = acc.both_extremes(predictions, shown, error_pct, TOP, groups, "low", "high")
    pick = lambda which: extremes.where(F.col("which") == which).orderBy("place").select(*shown, error_pct)
    return {
        "accuracy_by_range": acc.labelled_ranges(ranges),
        "accuracy_by_year": groups.groupBy("year").agg(mean_error, F.sum("n").alias("n")).orderBy("year"),
        "accuracy_by_category": by_category.withColumn("mean_error_pct", F.round("mean_error_pct", 2)).orderBy("mean_error_pct", category),
        "error_distribution": acc.distribution_row(spark, found.n, found["mean"], median, found["std"]),
        "error_histogram": histogram_table(bin_ends, bins, BINS),
        "error_bands": acc.band_table(whole),
        "worst_predictions": pick("worst"),
        "best_predictions": pick("best"),
        "best_and_worst_category": acc.best_and_worst(by_category, category, "mean_error_pct"),
    }


def plot_data(
    predictions: DataFrame,
    gold: DataFrame,
    synthetic: DataFrame,
    features: Sequence[str],
    target: str,
    category: str,
    year: str,
    actual: str = acc.ACTUAL,
    predicted: str = acc.PREDICTED,
) -> dict[str, DataFrame]:
    """Tables behind the overview, distribution, trend and residual charts.

    Passes: over the gold rows one for all aggregates of the whole, one for all histograms and one by year and
    category; over the synthetic rows the first two; the results are settled and every chart table is cut from them.
    """
    names = [*features, target]
    sums = [Measure(c, c, "sum", None) for c in (target, features[0])]
    means = [Measure(c, c, "mean", None) for c in features[1:]]
    series = settle(
        gold.groupBy(year, category).agg(*[m.direct() for m in [*sums, *means]], F.count(F.lit(1)).alias("__rows")), "series"
    )
    out = {
        "year_coverage": series.groupBy(year).agg(F.sum("__rows").alias("n")),
        "category_counts": series.groupBy(category).agg(F.sum("__rows").alias("n")),
        "yearly_series": series.drop("__rows"),
        "extent": joint_extent(predictions, actual, predicted),
        "residuals": acc.residual_points(predictions, actual, predicted),
    }
    rows: dict[str, DataFrame] = {}
    for source, df in (("real", gold), ("synthetic", synthetic)):
        trends = [c.alias(f"{n}_{i}") for i, f in enumerate(features) for n, c in zip(("slope", "intercept"), trend_columns(f, target))]
        ends = [f(c).alias(f"{n}_{i}") for i, c in enumerate(names) for n, f in (("low", F.min), ("high", F.max), ("count", F.count))]
        whole = rows[source] = settle(df.agg(F.count(F.lit(1)).alias("n_rows"), *correlation_columns(names), *trends, *ends), "whole")
        pairs = [F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), r.alias("r")) for a, b, r in correlation_pairs(names)]
        out[f"correlation_{source}"] = whole.select(F.inline(F.array(*pairs)))
        wanted = {f"density_{source}_{c}": (c, 20, histogram_ends(whole, f"low_{i}", f"high_{i}", f"count_{i}")) for i, c in enumerate(names)}
        last = len(names) - 1
        wanted[f"histogram_{source}_{target}"] = (target, 30, histogram_ends(whole, f"low_{last}", f"high_{last}", f"count_{last}"))
        counted = settle(bin_counts(df, wanted), "bins")
        for name, (_, bins, own) in wanted.items():
            mine = counted.where(F.col("name") == name).select("bin", "n")
            out[name] = histogram_table(own, mine, bins, density=name.startswith("density"))
    told = [F.struct(F.lit(f).alias("feature"), F.col(f"r_{i}_{len(features)}").alias("r")) for i, f in enumerate(features)]
    out["feature_target"] = rows["real"].select(F.inline(F.array(*told)))
    for i, f in enumerate(features):
        out[f"trend_{f}"] = rows["real"].select(F.col(f"slope_{i}").alias("slope"), F.col(f"intercept_{i}").alias("intercept"))
    counts = [rows[s].select(F.lit(s).alias("dataset"), "n_rows") for s in ("real", "synthetic")]
    out["volume"] = volumes(counts[0].union(counts[1]))
    return out


def report_table(
    predictions: DataFrame,
    gold: DataFrame,
    synthetic: DataFrame,
    category: str,
    year: str,
    target: str,
    features: Sequence[str],
    model: str,
    actual: str = acc.ACTUAL,
    predicted: str = acc.PREDICTED,
    error_pct: str = acc.ERROR_PCT,
    target_scale: int | None = None,
) -> DataFrame:
    """The summary report as (section, metric, value); values are text rounded as in a printed report.

    Two passes over the predictions (whole and per category), two over the
    gold rows (whole and per year), a row count of the synthetic ones.
    """
    judged = predictions.agg(
        *acc.metric_columns(actual, predicted, error_pct), *acc.band_columns(error_pct)
    )
    names = [*features, target]
    overview = gold.agg(
        F.count(F.lit(1)).alias("n_real"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
        F.count_distinct(category).alias("n_categories"),
        *correlation_columns(names),
    ).withColumn("n_synthetic", synthetic.agg(F.count(F.lit(1))).scalar())
    growth = growth_rate(gold, year, Measure("total", target, "sum", None, target_scale))
    by_category = acc.error_by(predictions, category, category, error_pct, actual)

    ratio = F.try_divide(F.col("n_synthetic").cast("double"), F.col("n_real").cast("double"))
    performance = {
        "model": F.lit(model),
        "r2": _fixed("r2", 4),
        "rating": rating("r2"),
        "rmse": _fixed("rmse", 2),
        "mae": _fixed("mae", 2),
        "mean_error_pct": _fixed("mean_error_pct", 2),
        "test_predictions": F.col("n"),
    }
    bands = {}
    for i, label in enumerate(BAND_LABELS):
        bands[f"n {label}"] = F.col(f"band_{i}")
        bands[f"pct {label}"] = _fixed(acc.band_share(i, "n"), 1)
    data = {
        "rows_real": F.col("n_real"),
        "rows_synthetic": F.col("n_synthetic"),
        "rows_combined": F.col("n_real") + F.col("n_synthetic"),
        "augmentation_factor": _fixed(ratio, 0),
        "first_year": F.col("first_year"),
        "last_year": F.col("last_year"),
        "categories": F.col("n_categories"),
    }
    correlation = {f"r {a} {b}": _fixed(r, 3) for a, b, r in correlation_pairs(names)}
    trend = {
        "first_total": _fixed("first_total", 0),
        "last_total": _fixed("last_total", 0),
        "growth_pct": _fixed("growth_pct", 2),
    }
    per_category = {
        "mean_error_pct": _fixed("mean_error_pct", 2),
        "n": F.col("n"),
        "mean_actual": _fixed("mean_actual", 2),
    }
    parts = [
        _long(judged, {"performance": performance, "error_bands": bands}),
        _long(overview, {"data": data, "correlation": correlation}),
        _long(by_category, {"by_category": per_category}, F.col(category)),
        _long(growth, {"trend": trend}),
    ]
    return reduce(DataFrame.unionByName, parts)


def _fixed(value: str | Column, digits: int) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(f"decimal(28,{digits})")


def _long(df: DataFrame, sections: dict[str, dict[str, Column]], of: Column | None = None) -> DataFrame:
    """All metrics of a row as (section, metric, value); ``of`` is added to the metric's name.

    Sections that share a source row are unfolded together, so it is computed once.
    """
    rows = [
        F.struct(
            F.lit(section).alias("section"),
            (F.lit(name) if of is None else F.concat_ws(" ", F.lit(name), of)).alias("metric"),
            value.cast("string").alias("value"),
        )
        for section, metrics in sections.items()
        for name, value in metrics.items()
    ]
    return df.select(F.inline(F.array(*rows)))
