"""Dirty text made from clean columns, cleaned again, and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.cleaning import parse_day, parse_number, standard_name
from granary.operators.impute import impute_global_mean, impute_group_mean
from granary.testbed.registry import query, sql_mean, table
from granary.testbed.shaping import NULLED_EVENTS, nulled_events

ALIASES = {"SMALL RING": "RING (SMALL)", "RED WIDGET": "WIDGET (RED)"}


def _money(column):
    return F.col(column).cast("decimal(18,2)").cast("string")


@query("select l_orderkey, l_linenumber, l_extendedprice as price from lineitem")
def clean_numeric_dot(spark, folder):
    dirty = F.concat(F.lit(" Rp "), _money("l_extendedprice"), F.lit(" ,ha"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", parse_number(dirty).alias("price")
    )


@query("select l_orderkey, l_linenumber, l_extendedprice as price from lineitem")
def clean_numeric_comma(spark, folder):
    dirty = F.concat(F.lit(" Rp "), F.replace(_money("l_extendedprice"), F.lit("."), F.lit(",")), F.lit(" ton"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", parse_number(dirty, decimal=",", signed=False).alias("price")
    )


@query(
    "select event_id, case event_id % 5 when 3 then 25.0::double when 4 then -value else null end as number from events"
)
def clean_numeric_malformed(spark, folder):
    k = F.col("event_id") % 5
    dirty = (
        F.when(k == 0, "-").when(k == 1, "").when(k == 2, "1.2.3").when(k == 3, "25 mm")
        .otherwise(F.concat(F.lit("-"), _money("value")))
    )
    return table(spark, folder, "events").select("event_id", parse_number(dirty).alias("number"))


@query(
    "select o_orderkey, case when o_orderkey % 7 = 0 or o_orderkey % 11 = 0 then null "
    "else cast(cast(o_orderdate as date) as varchar) end as day from orders"
)
def parse_date_dmy(spark, folder):
    k = F.col("o_orderkey")
    text = (
        F.when(k % 7 == 0, "31/02/2023").when(k % 11 == 0, "1/2/2023")
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    )
    day = parse_day(text).cast("string")  # as text, which every engine shows alike when null
    return table(spark, folder, "orders").select("o_orderkey", day.alias("day"))


@query(
    "select p_partkey, case upper(p_name) when 'SMALL RING' then 'RING (SMALL)' when 'RED WIDGET' then "
    "'WIDGET (RED)' else upper(p_name) end as name from part"
)
def standardize_names(spark, folder):
    messy = F.concat(F.lit("  "), F.initcap("p_name"), F.lit(" "))
    return table(spark, folder, "part").select("p_partkey", standard_name(messy, ALIASES).alias("name"))


@query(
    f"select e.event_id, e.event_type, coalesce(e.value, m.mean) as value from {NULLED_EVENTS} e join "
    f"(select event_type, {sql_mean('value')} as mean from {NULLED_EVENTS} group by 1) m using (event_type)",
    name="impute_group_mean",
)
def impute_group(spark, folder):
    events = nulled_events(spark, folder).drop("props")
    return impute_group_mean(events, ["value"], by="event_type", scale=2)


@query(
    f"select event_id, coalesce(value, (select {sql_mean('value')} from {NULLED_EVENTS})) as value "
    f"from {NULLED_EVENTS}",
    name="impute_global_mean",
)
def impute_global(spark, folder):
    return impute_global_mean(nulled_events(spark, folder).select("event_id", "value"), ["value"], scale=2)
