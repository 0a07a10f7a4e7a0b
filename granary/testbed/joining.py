"""Yearly features, integration joins, lookups and key reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.aggregates import Measure
from granary.operators import features, joins
from granary.testbed.registry import query, sql_mean, sql_round, sql_sum, table

SEGMENT_FACTORS = {"BUILDING": 1.2, "FURNITURE": 0.9, "MACHINERY": 1.1}

# Daily measurements stand in for weather: one row of three means per supplier nation and ship year.
MEASURES = (
    Measure("rain", "l_quantity", scale=2),
    Measure("humidity", "l_extendedprice", scale=2),
    Measure("temperature", "l_tax", scale=2),
)
FACTS = (
    Measure("production", "o_totalprice", "sum", None, 2),
    Measure("area", "o_totalprice", "mean", 2, 2),
)

SQL_FEATURES = (
    "(select n_name as category, cast(year(l_shipdate) as int) as year, "
    f"{sql_round(sql_mean('l_quantity'), 2)} as rain, {sql_round(sql_mean('l_extendedprice'), 2)} as humidity, "
    f"{sql_round(sql_mean('l_tax'), 2)} as temperature from lineitem join supplier on l_suppkey = s_suppkey "
    "join nation on s_nationkey = n_nationkey group by 1, 2)"
)
SQL_FACTS = (
    f"(select n_name as category, cast(year(o_orderdate) as int) as year, {sql_sum('o_totalprice')} as production, "
    f"{sql_round(sql_mean('o_totalprice'), 2)} as area from orders join customer on o_custkey = c_custkey "
    "join nation on c_nationkey = n_nationkey group by 1, 2)"
)


def named_nation(spark, folder, owner, owner_key, nation_key):
    """(owner key, nation name)."""
    nation = table(spark, folder, "nation")
    owners = table(spark, folder, owner).select(owner_key, nation_key)
    return owners.join(nation, F.col(nation_key) == F.col("n_nationkey")).select(
        owner_key, F.col("n_name").alias("category")
    )


def nation_features(spark, folder, **how):
    return joins.rolled_up(
        table(spark, folder, "lineitem"),
        named_nation(spark, folder, "supplier", "s_suppkey", "s_nationkey"),
        "l_suppkey",
        {"year": F.year("l_shipdate")},
        "category",
        MEASURES,
        dim_key="s_suppkey",
        **how,
    )


def nation_facts(spark, folder, **how):
    return joins.rolled_up(
        table(spark, folder, "orders"),
        named_nation(spark, folder, "customer", "c_custkey", "c_nationkey"),
        "o_custkey",
        {"year": F.year("o_orderdate")},
        "category",
        FACTS,
        dim_key="c_custkey",
        **how,
    )


@query(f"select * from {SQL_FEATURES}")
def yearly_features(spark, folder):
    return nation_features(spark, folder)


@query(f"select * from {SQL_FEATURES}")
def yearly_features_large_dim(spark, folder):
    """The same through the way taken when the dimension is too large to broadcast."""
    return nation_features(spark, folder, dim_is_small=False)


@query(
    f"select l_returnflag, cast(year(l_shipdate) as int) as year, {sql_round(sql_mean('l_quantity'), 2)} as rain, "
    f"{sql_round(sql_mean('l_extendedprice'), 2)} as humidity, {sql_round(sql_mean('l_tax'), 2)} as temperature "
    "from lineitem group by 1, 2"
)
def yearly_features_own_category(spark, folder):
    """Features of a category the measurements hold themselves."""
    return features.yearly_features(table(spark, folder, "lineitem"), "l_returnflag", "l_shipdate", MEASURES)


@query(
    f"select category, year, production, area, rain, humidity, temperature from {SQL_FACTS} "
    f"left join (select * from {SQL_FEATURES} where year % 3 <> 0) using (category, year)"
)
def integrate_left_join(spark, folder):
    known = nation_features(spark, folder).where(F.col("year") % 3 != 0)
    return joins.integrate_left(nation_facts(spark, folder), known, ["category", "year"])


@query(
    "select c_custkey, case c_mktsegment when 'BUILDING' then 1.2::double when 'FURNITURE' then 0.9::double "
    "when 'MACHINERY' then 1.1::double when 'AUTOMOBILE' then null else 1.0::double end as factor, "
    "case when c_custkey % 90 < 70 then case when c_custkey % 7 = 0 then null else c_custkey % 90 * 2 end else -1 end as many "
    "from customer"
)
def lookup_default(spark, folder):
    """Few entries and many, a key mapped to null among them."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    few = joins.with_lookup(customer, "factor", "c_mktsegment", SEGMENT_FACTORS | {"AUTOMOBILE": None}, 1.0)
    keyed = few.withColumn("key", F.when(F.col("c_custkey") % 7 == 0, F.lit("seven")).otherwise((F.col("c_custkey") % 90).cast("string")))
    keyed = keyed.withColumn("key", F.when(F.col("c_custkey") % 90 >= 70, "none").otherwise(F.col("key")))
    many = {str(i): 2 * i for i in range(70)} | {"seven": None}
    return joins.with_lookup(keyed, "many", "key", many, -1).select("c_custkey", "factor", F.col("many").cast("bigint"))


@query(
    "select key, case when l and r then 'both' when l then 'left_only' else 'right_only' end as status from "
    "(select key, bool_or(s) as l, bool_or(not s) as r from (select l_orderkey as key, true as s from lineitem "
    "where l_orderkey % 10 <> 1 union all select o_orderkey, false from orders where o_orderkey % 10 <> 2) group by 1)"
)
def reconcile_keys(spark, folder):
    lineitem = table(spark, folder, "lineitem").where(F.col("l_orderkey") % 10 != 1)
    orders = table(spark, folder, "orders").where(F.col("o_orderkey") % 10 != 2)
    return joins.reconcile_keys(lineitem, "l_orderkey", orders, "o_orderkey")


@query(
    "select c_mktsegment, cast(year(o_orderdate) as int) as year, "
    f"{sql_sum('o_totalprice')} as total, {sql_round(sql_mean('o_totalprice'), 4)} as mean_price, "
    f"max(o_totalprice) as top_price from orders join customer on o_custkey = c_custkey group by 1, 2"
)
def yearly_series(spark, folder):
    return joins.rolled_up(
        table(spark, folder, "orders"),
        table(spark, folder, "customer"),
        "o_custkey",
        {"year": F.year("o_orderdate")},
        "c_mktsegment",
        [
            Measure("total", "o_totalprice", "sum", None, 2),
            Measure("mean_price", "o_totalprice", "mean", 4, 2),
            Measure("top_price", "o_totalprice", "max", None),
        ],
        dim_key="c_custkey",
    )
