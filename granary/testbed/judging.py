"""Accuracy analysis of a closed-form prediction on lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import accuracy as acc
from granary.operators.grouped_quantiles import grouped_quantiles
from granary.plans.modelling import prediction_table as build_table
from granary.sources.workspace import settle
from granary.testbed.registry import query, sql_round, table

# name, prediction from the quantity as (factor, constant)
CLOSED_FORMS = {"closed_form": (1500.0, 0.0), "steep": (2000.0, 1000.0), "flat": (0.0, 50000.0)}

SQL_KEEP = "l_orderkey, l_linenumber, l_returnflag, cast(year(l_shipdate) as int) as year"


def sql_predictions(model="closed_form"):
    factor, constant = CLOSED_FORMS[model]
    p = f"(l_quantity * {factor}::double + {constant}::double)"
    return (
        f"(select {SQL_KEEP}, l_extendedprice as actual, {p} as predicted, '{model}' as model, "
        f"{p} - l_extendedprice as error, abs({p} - l_extendedprice) / nullif(l_extendedprice, 0) * 100 as error_pct "
        "from lineitem)"
    )


PREDICTIONS = sql_predictions()
ALL_MODELS = "(" + " union all ".join(f"select * from {sql_predictions(m)}" for m in CLOSED_FORMS) + ")"


def predictions(spark, folder, model="closed_form"):
    factor, constant = CLOSED_FORMS[model]
    scored = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.year("l_shipdate").alias("year"),
        "l_extendedprice",
        (F.col("l_quantity") * factor + F.lit(constant)).alias("prediction"),
        F.lit(model).alias("model"),
    )
    return build_table(
        scored, "l_extendedprice", "prediction", ["l_orderkey", "l_linenumber", "l_returnflag", "year"]
    )


def all_models(spark, folder):
    """Predictions of all closed forms, unfolded from one scan."""
    forms = [
        F.struct(F.lit(name).alias("model"), (F.col("l_quantity") * factor + F.lit(constant)).alias("prediction"))
        for name, (factor, constant) in CLOSED_FORMS.items()
    ]
    rows = table(spark, folder, "lineitem").select("l_extendedprice", F.inline(F.array(*forms)))
    return build_table(rows, "l_extendedprice", "prediction", [])


@query(f"select * from {PREDICTIONS}")
def prediction_table(spark, folder):
    return predictions(spark, folder)


@query("select l_quantity * 1500 as predicted, l_quantity * 1500 - l_extendedprice as residual from lineitem")
def residual_points(spark, folder):
    return acc.residual_points(predictions(spark, folder))


SQL_METRICS = (
    f"count(*) as n, {sql_round('sqrt(avg(error * error))', 4)} as rmse, {sql_round('avg(abs(error))', 4)} as mae, "
    f"{sql_round('1 - avg(error * error) / var_pop(actual)', 6)} as r2, "
    f"{sql_round('avg(error_pct)', 4)} as mean_error_pct"
)


@query(f"select {SQL_METRICS} from {PREDICTIONS}")
def regression_metrics(spark, folder):
    return _rounded(acc.regression_metrics(predictions(spark, folder)))


def _rounded(metrics):
    four = {c: F.round(c, 4) for c in ("rmse", "mae", "mean_error_pct")}
    return metrics.withColumns({**four, "r2": F.round("r2", 6)})


def _compared(spark, folder):
    return _rounded(acc.model_comparison(all_models(spark, folder)))


@query(f"select model, {SQL_METRICS} from {ALL_MODELS} group by 1")
def model_comparison(spark, folder):
    return _compared(spark, folder)


@query(f"select model, {SQL_METRICS} from {ALL_MODELS} group by 1 order by r2 desc, model limit 1")
def best_model(spark, folder):
    return acc.best_model(_compared(spark, folder))


@query(
    f"select l_returnflag, {sql_round('avg(error_pct)', 4)} as mean_error_pct, count(error_pct) as n "
    f"from {PREDICTIONS} group by 1"
)
def error_by_category(spark, folder):
    return acc.error_by(predictions(spark, folder), "l_returnflag", "l_returnflag", digits=4)


@query(
    f"select l_returnflag, {sql_round('avg(error_pct)', 2)} as mean_error_pct, count(error_pct) as n, "
    f"{sql_round('avg(actual)', 2)} as mean_actual from {PREDICTIONS} group by 1"
)
def error_by_category_detail(spark, folder):
    return acc.error_by(
        predictions(spark, folder), "l_returnflag", "l_returnflag", actual="actual", digits=2, half_even=True
    )


@query(
    f"select year, {sql_round('avg(error_pct)', 4)} as mean_error_pct, count(error_pct) as n from {PREDICTIONS} group by 1"
)
def error_by_year(spark, folder):
    return acc.error_by(predictions(spark, folder), "year", "year", digits=4)


@query(
    f"with p as (select * from {PREDICTIONS}), s as (select min(actual) as lo, max(actual) as hi, "
    "(max(actual) - min(actual)) / 5.0::double as w from p), "
    "b as (select case when lo = hi then 3 when actual <= lo + 1.0::double * w then 1 when actual <= lo + 2.0::double * w then 2 "
    "when actual <= lo + 3.0::double * w then 3 when actual <= lo + 4.0::double * w then 4 else 5 end as range, actual, error_pct "
    "from p, s), l as (select * from (values (1, 'Very Low'), (2, 'Low'), (3, 'Medium'), (4, 'High'), (5, 'Very High')) "
    "as t(range, label)) select l.range, l.label, "
    f"{sql_round('avg(error_pct)', 2)} as error_mean, {sql_round('stddev_samp(error_pct)', 2)} as error_std, "
    f"count(error_pct) as n, {sql_round('avg(actual)', 2)} as actual_mean, {sql_round('min(actual)', 2)} as actual_min, "
    f"{sql_round('max(actual)', 2)} as actual_max from l left join b on l.range = b.range group by 1, 2"
)
def error_by_range(spark, folder):
    return acc.error_by_range(predictions(spark, folder))


@query(
    f"select count(error_pct) as n, {sql_round('avg(error_pct)', 4)} as mean, {sql_round('median(error_pct)', 4)} as median, "
    f"{sql_round('stddev_samp(error_pct)', 4)} as std, "
    f"{sql_round('avg(error_pct) - stddev_samp(error_pct)', 4)} as minus_1_std, "
    f"{sql_round('avg(error_pct) + stddev_samp(error_pct)', 4)} as plus_1_std, "
    f"{sql_round('2 * stddev_samp(error_pct)', 4)} as two_std from {PREDICTIONS}"
)
def error_distribution(spark, folder):
    return acc.error_distribution(predictions(spark, folder), digits=4)


SQL_SPREAD = ", ".join(
    f"{sql_round(e, 4)} as {n}"
    for n, e in (
        ("mean", "avg(error_pct)"), ("std", "stddev_samp(error_pct)"), ("min", "min(error_pct)"), ("q1", "quantile_cont(error_pct, 0.25)"),
        ("median", "quantile_cont(error_pct, 0.5)"), ("q3", "quantile_cont(error_pct, 0.75)"), ("max", "max(error_pct)"),
    )
)


@query(f"select l_returnflag, year, count(error_pct) as n, {SQL_SPREAD} from {PREDICTIONS} group by 1, 2")
def error_distribution_by_category(spark, folder):
    """Spread of the errors by category and year."""
    return acc.error_distribution_by(settle(predictions(spark, folder), "judged"), ["l_returnflag", "year"], digits=4)


@query(
    "select l_suppkey, count(*) as n, "
    + ", ".join(f"{sql_round(f'quantile_cont(l_extendedprice, {share})', 4)} as {name}" for name, share in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)))
    + " from (select l_suppkey % 3 as l_suppkey, l_extendedprice from lineitem "
    + "union all select 100 + l_suppkey, l_extendedprice from lineitem) group by 1"
)
def grouped_price_quantiles(spark, folder):
    """Price quantiles of three groups with a third of all rows each, and of many small ones."""
    items = table(spark, folder, "lineitem").select("l_suppkey", "l_extendedprice")
    both = items.withColumn("l_suppkey", F.col("l_suppkey") % 3).union(items.withColumn("l_suppkey", F.col("l_suppkey") + 100))
    found = grouped_quantiles(settle(both, "prices"), ["l_suppkey"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, few_rows=1000)
    return found.withColumns({c: F.round(c, 4) for c in ("p10", "p50", "p99")})


@query(
    f"with p as (select error_pct as e from {PREDICTIONS}), b as (select * from (values (0, '< 5%', -1.0, 5.0), "
    "(1, '5-10%', 5.0, 10.0), (2, '10-20%', 10.0, 20.0), (3, '> 20%', 20.0, 1e30)) as t(band, label, lo, hi)) "
    "select band, label, count(e) as n, count(e) * 100.0::double / (select count(*) from p) as pct "
    "from b left join p on e >= lo and e < hi group by 1, 2"
)
def error_bands(spark, folder):
    return acc.error_bands(predictions(spark, folder))


@query(
    f"with m as (select year, {sql_round('avg(error_pct)', 4)} as m from {PREDICTIONS} group by 1) "
    "(select 'best' as which, year, m as mean_error_pct from m order by m, year limit 1) union all "
    "(select 'worst', year, m from m order by m desc, year limit 1)"
)
def best_worst_category(spark, folder):
    return acc.best_and_worst(predictions(spark, folder), "year", digits=4)


SHOWN = ["l_returnflag", "year", "l_orderkey", "l_linenumber"]


@query(
    f"select {', '.join(SHOWN)}, error_pct from {PREDICTIONS} where error_pct is not null "
    f"order by error_pct desc, {', '.join(SHOWN)} limit 10"
)
def worst_predictions(spark, folder):
    return acc.extreme_predictions(predictions(spark, folder), SHOWN)


@query(
    f"select {', '.join(SHOWN)}, error_pct from {PREDICTIONS} where error_pct is not null "
    f"order by error_pct, {', '.join(SHOWN)} limit 10"
)
def best_predictions(spark, folder):
    return acc.extreme_predictions(predictions(spark, folder), SHOWN, worst=False)
