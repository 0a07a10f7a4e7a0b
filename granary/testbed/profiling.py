"""Counts, describe, correlation, trend, histograms, growth on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.aggregates import Measure
from granary.operators import profile
from granary.testbed.registry import query, sql_mean, sql_round, sql_sum, table
from granary.testbed.shaping import NULLED_EVENTS, nulled_events

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts):
    return " union all ".join(parts)


@query(f"select {sql_mean('l_extendedprice')} as mean_price, {sql_mean('l_quantity')} as mean_quantity from lineitem")
def global_mean(spark, folder):
    return profile.global_mean(
        table(spark, folder, "lineitem"), {"mean_price": "l_extendedprice", "mean_quantity": "l_quantity"}, scale=2
    )


@query(_union(f"select '{n}' as dataset, count(*) as n_rows from {n}" for n in ("lineitem", "orders", "events")))
def row_counts(spark, folder):
    return profile.row_counts({n: table(spark, folder, n) for n in ("lineitem", "orders", "events")})


@query(
    _union(
        f"select '{c}' as \"column\", count(distinct {c}) as n_distinct from customer"
        for c in ("c_nationkey", "c_mktsegment", "c_acctbal")
    )
)
def distinct_counts(spark, folder):
    return profile.distinct_counts(table(spark, folder, "customer"), ["c_nationkey", "c_mktsegment", "c_acctbal"])


ITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query(_union(f"select '{c}' as \"column\", count(distinct {c}) as n_distinct from lineitem" for c in ITEM_COLUMNS))
def distinct_counts_all(spark, folder):
    """Distinct values of all columns of a table."""
    return profile.distinct_counts(table(spark, folder, "lineitem"), ITEM_COLUMNS)


@query(
    _union(
        f"select '{c}' as \"column\", count(*) filter (where {c} is null) as n_nulls from {NULLED_EVENTS}"
        for c in ("event_id", "event_type", "value", "props")
    )
)
def null_counts(spark, folder):
    return profile.null_counts(nulled_events(spark, folder))


@query(
    _union(
        f"select '{c}' as \"column\", count({c}) as n, {sql_round(f'avg({c})', 4)} as mean, "
        f"{sql_round(f'stddev_samp({c})', 4)} as stddev, min({c}) as min, max({c}) as max from lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_tax")
    )
)
def describe_numeric(spark, folder):
    return profile.describe_numeric(
        table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"], digits=4
    )


@query(
    "select min(o_orderdate) as min_o_orderdate, max(o_orderdate) as max_o_orderdate, "
    "min(o_totalprice) as min_o_totalprice, max(o_totalprice) as max_o_totalprice from orders"
)
def value_range(spark, folder):
    return profile.value_range(table(spark, folder, "orders"), ["o_orderdate", "o_totalprice"])


@query(
    "select least(min(l_extendedprice), min(l_quantity * 1500)) as low, "
    "greatest(max(l_extendedprice), max(l_quantity * 1500)) as high from lineitem"
)
def joint_extent(spark, folder):
    return profile.joint_extent(table(spark, folder, "lineitem"), "l_extendedprice", F.col("l_quantity") * 1500)


@query("select event_type as value, count(*) as n from events group by 1")
def value_counts(spark, folder):
    return profile.value_counts(table(spark, folder, "events"), "event_type")


@query("select cast(year(o_orderdate) as int) as year, count(*) as n from orders group by 1")
def year_coverage(spark, folder):
    return profile.value_counts(table(spark, folder, "orders"), F.year("o_orderdate"), "year")


@query(
    _union(
        f"select '{a}' as \"row\", '{b}' as col, "
        + (f"{sql_round(f'corr({a}, {b})', 6)} as r from lineitem" if a != b else "1.0::double as r")
        for a in NUMBERS
        for b in NUMBERS
    )
)
def correlation_matrix(spark, folder):
    return profile.correlation_matrix(table(spark, folder, "lineitem"), NUMBERS, digits=6)


WIDE = {f"c{i}": f"case when l_orderkey % {i + 3} <> 0 then l_quantity * {i % 4} + l_suppkey % {i + 2} + 1000 * {i} end" for i in range(12)}
SQL_WIDE = f"(select {', '.join(f'{e} as {c}' for c, e in WIDE.items())} from lineitem)"


@query(
    "with wide as " + SQL_WIDE + ", r as (select "
    + ", ".join(f"corr({a}, {b}) as {a}_{b}" for a in WIDE for b in WIDE)
    + " from wide) "
    + _union(f"select '{a}' as \"row\", '{b}' as col, {sql_round(f'{a}_{b}', 6)} as r from r" for a in WIDE for b in WIDE)
)
def wide_correlations(spark, folder):
    """All pairs of many columns with gaps, from one matrix product."""
    wide = table(spark, folder, "lineitem").select(*[F.expr(e).alias(c) for c, e in WIDE.items()])
    return profile.wide_correlations(wide, list(WIDE), digits=6)


@query(
    _union(
        f"select '{c}' as feature, {sql_round(f'corr(l_extendedprice, {c})', 6)} as r from lineitem"
        for c in ("l_quantity", "l_discount", "l_tax")
    )
)
def feature_target_corr(spark, folder):
    return profile.feature_target_correlation(
        table(spark, folder, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", digits=6
    )


@query(
    f"select l_returnflag, {sql_round('regr_slope(l_extendedprice, l_quantity)', 4)} as slope, "
    f"{sql_round('regr_intercept(l_extendedprice, l_quantity)', 4)} as intercept from lineitem group by 1"
)
def linear_trend(spark, folder):
    return profile.linear_trend(
        table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", by=["l_returnflag"], digits=4
    )


@query(
    "select l_orderkey, l_linenumber, " + sql_round("i + s * l_quantity", 4) + " as trend from lineitem, "
    "(select regr_slope(l_extendedprice, l_quantity) as s, regr_intercept(l_extendedprice, l_quantity) as i from lineitem)"
)
def trend_values(spark, folder):
    lineitem = profile.with_trend(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")
    return lineitem.select("l_orderkey", "l_linenumber", F.round("trend", 4).alias("trend"))


def _sql_histogram(column, source, bins, density=False):
    extra = ", n / ((select sum(n) from c) * w) as density" if density else ""
    return (
        f"with s as (select cast(min({column}) as double) as lo, cast(max({column}) as double) as hi, "
        f"(cast(max({column}) as double) - cast(min({column}) as double)) / {bins}.0::double as w from {source}), "
        f"c as (select least(cast(floor(({column} - lo) / w) as int) + 1, {bins}) as bin, count(*) as n "
        f"from {source}, s group by 1), "
        f"f as (select cast(i as int) as bin from range(1, {bins} + 1) t(i)), "
        "j as (select f.bin, lo, w, coalesce(c.n, 0) as n from f left join c on f.bin = c.bin, s) "
        f"select bin, lo + (bin - 1) * w as lower, lo + bin * w as upper, cast(n as bigint) as n{extra} from j"
    )


@query(_sql_histogram("l_extendedprice", "lineitem", 30))
def histogram_counts(spark, folder):
    return profile.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 30)


@query(_sql_histogram("o_totalprice", "orders", 20, density=True))
def histogram_density(spark, folder):
    return profile.histogram(table(spark, folder, "orders"), "o_totalprice", 20, density=True)


@query(
    f"with y as (select cast(year(o_orderdate) as int) as year, {sql_sum('o_totalprice')} as total from orders group by 1), "
    "e as (select min(year) as first_year, max(year) as last_year, min_by(total, year) as first_total, "
    "max_by(total, year) as last_total from y) select first_year, last_year, first_total, last_total, "
    + sql_round("(pow(last_total / first_total, 1.0::double / (last_year - first_year)) - 1) * 100", 6)
    + " as growth_pct from e"
)
def growth_rate(spark, folder):
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    grown = profile.growth_rate(orders, "year", Measure("total", "o_totalprice", "sum", None, 2))
    return grown.withColumn("growth_pct", F.round("growth_pct", 6))


@query(
    "with n as (select (select count(*) from orders) as r, (select count(*) from lineitem) as s), "
    "v as (select 'real' as dataset, r as n_rows, r from n union all select 'synthetic', s, r from n "
    "union all select 'combined', r + s, r from n) select dataset, cast(n_rows as bigint) as n_rows, "
    "cast(n_rows as double) / r as ratio_to_real from v"
)
def volume_summary(spark, folder):
    return profile.volume_summary(table(spark, folder, "orders"), table(spark, folder, "lineitem"))
