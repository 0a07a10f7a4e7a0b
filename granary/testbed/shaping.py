"""Projections, filters, unions and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.cleaning import code_to_name, iso_stamp
from granary.functions.scoring import clamp, midpoint, quality_flag, quality_fraction, rating
from granary.operators import filters, profile, shaping
from granary.operators.accuracy import with_errors
from granary.operators.features import with_year
from granary.testbed.registry import query, sql_round, table

CODE_NAMES = {"view": "PAGE VIEW", "click": "LINK CLICK", "purchase": "SALE"}
NULLED_EVENTS = (
    "(select event_id, event_type, case when event_id % 7 = 0 or event_id % 35 = 5 then null else value end as value, "
    "case when event_id % 5 = 0 then null else props end as props from events)"
)


def nulled_events(spark, folder):
    """Events with some values and some properties blanked, both at once in places."""
    k = F.col("event_id")
    return table(spark, folder, "events").select(
        "event_id",
        "event_type",
        F.when(~((k % 7 == 0) | (k % 35 == 5)), F.col("value")).alias("value"),
        F.when(k % 5 != 0, F.col("props")).alias("props"),
    )


@query("select s_suppkey as id, s_name as name, s_nationkey, s_acctbal as balance from supplier")
def rename_map(spark, folder):
    names = {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance", "absent": "nothing"}
    return shaping.rename(table(spark, folder, "supplier"), names)


@query("select p_partkey, 2023 as year, 'parts' as source from part")
def add_literals(spark, folder):
    part = table(spark, folder, "part").select("p_partkey")
    return shaping.add_literals(part, {"year": 2023, "source": "parts"})


@query(
    "select event_id, case event_type when 'view' then 'PAGE VIEW' when 'click' then 'LINK CLICK' "
    "when 'purchase' then 'SALE' else upper(event_type) end as name from events"
)
def map_codes(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", code_to_name("event_type", CODE_NAMES).alias("name")
    )


@query("select event_id, timestamp '2024-02-01 00:00:00' as processed_at from events")
def stamp_rows(spark, folder):
    events = table(spark, folder, "events").select("event_id")
    stamped = shaping.stamp(events, as_of="2024-02-01 00:00:00")
    return stamped.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


@query("select l_orderkey, l_linenumber, l_extendedprice as actual, l_quantity * 1500 as predicted from lineitem")
def project_alias(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("actual"),
        (F.col("l_quantity") * 1500).alias("predicted"),
    )


@query("select c_mktsegment, c_custkey, c_acctbal from customer")
def project_required(spark, folder):
    required = ["c_mktsegment", "c_custkey", "c_rainfall", "c_acctbal"]
    projected, absent = shaping.project_required(table(spark, folder, "customer"), required)
    if absent != ["c_rainfall"]:
        raise ValueError(f"unexpected absent columns {absent}")
    return projected


@query(
    "select l_orderkey, l_linenumber, l_quantity * 1500 - l_extendedprice as error, "
    "abs(l_quantity * 1500 - l_extendedprice) / nullif(l_extendedprice, 0) * 100 as error_pct from lineitem"
)
def error_columns(spark, folder):
    judged = with_errors(project_alias(spark, folder))
    return judged.select("l_orderkey", "l_linenumber", "error", "error_pct")


@query(
    f"select l_returnflag, {sql_round('avg((l_discount + l_tax) / 2)', 4)} as mid from lineitem group by 1"
)
def midpoint_fallback(spark, folder):
    """There is no ready-made mean column, so the midpoint of two columns stands in."""
    lineitem = table(spark, folder, "lineitem")
    value = shaping.first_available(
        lineitem,
        [
            (["l_mean"], lambda: F.avg("l_mean")),
            (["l_discount", "l_tax"], lambda: F.avg(midpoint("l_discount", "l_tax"))),
        ],
    )
    return lineitem.groupBy("l_returnflag").agg(F.round(value, 4).alias("mid"))


@query(
    "select ordinal, name as \"column\", type, (select count(*) from supplier) as n_rows, "
    "cast(0 as bigint) as n_nulls from (values (1, 's_suppkey', 'bigint'), (2, 's_name', 'string'), "
    "(3, 's_nationkey', 'int'), (4, 's_acctbal', 'double')) as t(ordinal, name, type)"
)
def schema_profile(spark, folder):
    return profile.schema_profile(table(spark, folder, "supplier"))


@query(f"select * from {NULLED_EVENTS} where value is not null or props is not null")
def drop_all_null(spark, folder):
    return filters.drop_all_null(nulled_events(spark, folder), ["value", "props", "absent"])


@query(
    "select c_custkey, case when c_custkey % 7 = 0 then null else c_acctbal - 500 end as c_acctbal from customer "
    "where c_custkey % 7 = 0 or c_acctbal - 500 > 0"
)
def filter_positive_or_null(spark, folder):
    shifted = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal") - 500).alias("c_acctbal")
    )
    return filters.positive_or_null(shifted, "c_acctbal")


@query(
    "select o_orderkey, cast(year(o_orderdate) as int) as year from orders "
    "where year(o_orderdate) = (select max(year(o_orderdate)) from orders)"
)
def filter_extreme_year(spark, folder):
    orders = with_year(table(spark, folder, "orders"), "o_orderdate")
    return filters.at_extreme(orders.select("o_orderkey", "year"), "year", last=True)


@query("select o_orderkey, cast(year(o_orderdate) as int) as year from orders")
def extract_year(spark, folder):
    return with_year(table(spark, folder, "orders"), "o_orderdate").select("o_orderkey", "year")


@query(
    "select l_returnflag, greatest(10.0::double, min(l_quantity) * 0.5) as low, "
    "least(60.0::double, max(l_quantity) * 1.5) as high from lineitem group by 1"
)
def clamp_ranges(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        clamp(F.min("l_quantity") * 0.5, 10.0, None).alias("low"),
        clamp(F.max("l_quantity") * 1.5, None, 60.0).alias("high"),
    )


@query(
    "select event_id, case when value is null or props is null then 0.5::double else 1.0::double end as score "
    f"from {NULLED_EVENTS}",
    name="quality_flag",
)
def quality_flag_(spark, folder):
    return nulled_events(spark, folder).select("event_id", quality_flag(["value", "props"]).alias("score"))


@query(
    "select c_custkey, cast((case when b > 0 then 1 else 0 end) + (case when c_nationkey > 0 then 1 else 0 end) "
    "+ (case when c_custkey > 0 then 1 else 0 end) as double) / 3.0::double as score from "
    "(select *, case when c_custkey % 7 = 0 then null else c_acctbal - 500 end as b from customer)",
    name="quality_fraction",
)
def quality_fraction_(spark, folder):
    shifted = table(spark, folder, "customer").withColumn(
        "b", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal") - 500)
    )
    return shifted.select("c_custkey", quality_fraction(["b", "c_nationkey", "c_custkey"]).alias("score"))


@query(
    "select l_linenumber, case when r > 0.9 then 'Excellent' when r > 0.8 then 'Good' when r > 0.7 then 'Fair' "
    "else 'Poor' end as rating from (select l_linenumber, regr_r2(l_extendedprice, l_quantity) + l_linenumber / 10.0 "
    "as r from lineitem group by 1)"
)
def rate_metric(spark, folder):
    scores = table(spark, folder, "lineitem").groupBy("l_linenumber").agg(
        F.regr_r2("l_extendedprice", "l_quantity").alias("r")
    )
    return scores.select("l_linenumber", rating(F.col("r") + F.col("l_linenumber") / 10.0).alias("rating"))


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as stamp from events", name="iso_stamp")
def iso_stamp_(spark, folder):
    return table(spark, folder, "events").select("event_id", iso_stamp("ts").alias("stamp"))


@query(
    "select name, nation, balance, segment from (select c_name as name, c_nationkey as nation, c_acctbal as balance, "
    "c_mktsegment as segment from customer union all select s_name, s_nationkey, s_acctbal, null from supplier)"
)
def union_by_name_missing(spark, folder):
    customer = shaping.rename(
        table(spark, folder, "customer").drop("c_custkey"),
        {"c_name": "name", "c_nationkey": "nation", "c_acctbal": "balance", "c_mktsegment": "segment"},
    )
    supplier = shaping.rename(
        table(spark, folder, "supplier").select("s_acctbal", "s_nationkey", "s_name"),
        {"s_name": "name", "s_nationkey": "nation", "s_acctbal": "balance"},
    )
    return shaping.unite([customer, supplier])


@query("select distinct c_nationkey, c_mktsegment from customer")
def distinct_pairs(spark, folder):
    return shaping.distinct_rows(table(spark, folder, "customer"), "c_nationkey", "c_mktsegment")


@query(
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from (select *, row_number() over ("
    "partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice) as rn from lineitem) "
    "where rn = 1"
)
def dedupe_exact(spark, folder):
    lineitem = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return shaping.dedupe(lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query(
    "select o_orderkey, o_totalprice, o_orderpriority from orders order by o_totalprice desc, o_orderkey limit 20"
)
def preview_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return shaping.preview(orders, [F.col("o_totalprice").desc(), "o_orderkey"], 20)
