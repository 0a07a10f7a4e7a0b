"""The whole stages on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.aggregates import Measure
from granary.plans import analysis, gold, silver
from granary.sources.workspace import settle
from granary.testbed.drawing import SQL_REAL, SQL_TARGETS, drawn_targets, real_rows
from granary.testbed.joining import SQL_FACTS, SQL_FEATURES, nation_facts, nation_features
from granary.testbed.judging import PREDICTIONS, predictions
from granary.testbed.registry import query, sql_mean, sql_round, sql_sum, table

AS_OF = "2024-02-01 00:00:00"
EVENT_NAMES = {"view": "PAGE VIEW", "click": "LINK CLICK", "purchase": "SALE"}
MEASUREMENTS = silver.MeasurementSpec(
    names={"ID": "event_id", "STATION": "station", "DAY": "day", "T": "temp", "R": "rain", "NONE": "none"},
    code="code",
    category="category",
    code_names=EVENT_NAMES,
    date="day",
    numeric=["temp", "rain", "wind"],
    score_on=["rain", "temp"],
    keep_if_any=["temp", "rain"],
    scale=2,
)
FACTS = silver.FactSpec(
    names={"Customer": "customer", "Balance (Rp)": "balance", "Nation": "nation"},
    key="customer",
    numeric=["balance", "nation", "absent"],
    positive="balance",
)


def bronze_events(spark, folder):
    """Events as the text a station file would hold; signups lack rain, errors lack everything."""
    k, kind = F.col("event_id"), F.col("event_type")
    money = F.col("value").cast("decimal(18,2)").cast("string")
    temp = F.when(k % 7 == 0, "").when(k % 11 == 0, "-").otherwise(F.concat(money, F.lit(" C")))
    rain = F.when(k % 5 != 0, F.concat(F.lit("Rr "), money))
    return table(spark, folder, "events").select(
        F.col("event_id").alias("ID"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("STATION"),
        F.when(k % 13 == 0, "31/02/2023").otherwise(F.date_format("ts", "dd/MM/yyyy")).alias("DAY"),
        F.when(kind != "error", temp).alias("T"),
        F.when(~kind.isin("error", "signup"), rain).alias("R"),
        kind.alias("code"),
    )


SQL_BRONZE = (
    "(select event_id, 'U' || cast(user_id as varchar) as station, case when event_id % 13 = 0 then null "
    "else cast(ts as date) end as day, case when event_type = 'error' or event_id % 7 = 0 or event_id % 11 = 0 "
    "then null else value end as temp, case when event_type in ('error', 'signup') or event_id % 5 = 0 then null "
    "else value end as rain, event_type as code from events)"
)


def _mean_or_null(column):
    return f"case when count({column}) > 0 then {sql_mean(column)} end"


SQL_SILVER = (
    "(select event_id, station, day, coalesce(temp, mt) as temp, coalesce(rain, mr) as rain, code, "
    "case code when 'view' then 'PAGE VIEW' when 'click' then 'LINK CLICK' when 'purchase' then 'SALE' "
    "else upper(code) end as category, case when coalesce(temp, mt) is null or coalesce(rain, mr) is null "
    "then 0.5::double else 1.0::double end as data_quality_score, timestamp '2024-02-01 00:00:00' as processed_at "
    f"from {SQL_BRONZE} join (select code, {_mean_or_null('temp')} as mt, {_mean_or_null('rain')} as mr from {SQL_BRONZE} "
    "group by 1) using (code) where coalesce(temp, mt) is not null or coalesce(rain, mr) is not null)"
)

def _silver(spark, folder):
    return silver.clean_measurements(bronze_events(spark, folder), MEASUREMENTS, AS_OF)


@query(f"select * replace (cast(day as varchar) as day) from {SQL_SILVER}")
def silver_measurements(spark, folder):
    return _silver(spark, folder).withColumns(
        {"processed_at": F.col("processed_at").cast("timestamp_ntz"), "day": F.col("day").cast("string")}
    )


def bronze_customers(spark, folder):
    money = F.replace(
        F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")
    )
    k = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        F.concat(F.lit(" "), F.lower("c_name"), F.lit("  ")).alias("Customer"),
        F.when(k % 7 == 0, "").when(k % 11 == 0, "0,00 Rp").otherwise(F.concat(money, F.lit(" Rp"))).alias("Balance (Rp)"),
        F.col("c_nationkey").cast("string").alias("Nation"),
    )


SQL_SILVER_FACTS = (
    "(select customer, balance, nation, cast((case when balance > 0 then 1 else 0 end) + "
    "(case when nation > 0 then 1 else 0 end) as double) / 2.0::double as data_quality_score, "
    "timestamp '2024-02-01 00:00:00' as processed_at from (select upper(c_name) as customer, "
    "case when c_custkey % 7 = 0 then null when c_custkey % 11 = 0 then 0.0::double else abs(c_acctbal) end as balance, "
    "cast(c_nationkey as double) as nation from customer) where balance > 0 or balance is null)"
)


def _silver_facts(spark, folder):
    return silver.clean_facts(bronze_customers(spark, folder), FACTS, AS_OF)


@query(f"select * from {SQL_SILVER_FACTS}")
def silver_facts(spark, folder):
    return _silver_facts(spark, folder).withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


@query(
    f"with m as (select * from {SQL_SILVER}), f as (select * from {SQL_SILVER_FACTS}), "
    "k as (select 'CUSTOMER#' || lpad(cast(event_id as varchar), 9, '0') as k from m) "
    "select 'measurements' as dataset, 'n_rows' as metric, cast(count(*) as double) as value from m "
    "union all select 'measurements', 'n_categories', count(distinct category) from m "
    "union all select 'measurements', 'n_columns', 10 "
    "union all select 'measurements', 'nulls_temp', count(*) filter (where temp is null) from m "
    "union all select 'measurements', 'nulls_rain', count(*) filter (where rain is null) from m "
    "union all select 'measurements', 'mean_quality', avg(data_quality_score) from m "
    "union all select 'facts', 'n_rows', count(*) from f "
    "union all select 'facts', 'n_categories', count(distinct customer) from f "
    "union all select 'facts', 'n_columns', 5 "
    "union all select 'facts', 'nulls_balance', count(*) filter (where balance is null) from f "
    "union all select 'facts', 'mean_quality', avg(data_quality_score) from f "
    "union all select 'keys', 'keys_both', count(*) from k where k in (select customer from f) "
    "union all select 'keys', 'keys_left_only', count(*) from k where k not in (select customer from f) "
    "union all select 'keys', 'keys_right_only', count(*) from f where customer not in (select k from k)"
)
def validate_silver(spark, folder):
    """Checks of both silver tables; event numbers in the customers' spelling serve as keys to reconcile."""
    key = F.concat(F.lit("CUSTOMER#"), F.lpad(F.col("event_id").cast("string"), 9, "0"))
    measured = settle(_silver(spark, folder), "silver").withColumn("key", key)
    facts = settle(_silver_facts(spark, folder), "silver")
    checks = silver.validate_silver(
        measured, facts, "key", "customer", nulls_of=["temp", "rain", "none"], fact_nulls_of=["balance"]
    ).where("metric <> 'n_categories' or dataset <> 'measurements'")
    kinds = silver.table_checks(measured, "measurements", "category", []).where("metric = 'n_categories'")
    return checks.unionByName(kinds)


HISTORY_NAMES = {"Segment": "category", "Year": "year", "Total": "production"}
FACT_NAMES = {"segment": "category", "total": "production", "mean": "yield"}


def _segment_totals(spark, folder, names):
    customer = table(spark, folder, "customer")
    return customer.groupBy(F.col("c_mktsegment").alias(names[0])).agg(
        Measure(names[1], "c_acctbal", "sum", None, 2).direct(), Measure(names[2], "c_acctbal", scale=2).direct()
    )


@query(
    f"select c_mktsegment as category, 2020 as year, {sql_sum('c_acctbal')} as production, "
    f"{sql_round(sql_mean('c_acctbal'), 2)} as \"Mean\" from customer group by 1"
)
def integrate_primary(spark, folder):
    history = _segment_totals(spark, folder, ["Segment", "Total", "Mean"]).withColumn("Year", F.lit(2020))
    facts = _segment_totals(spark, folder, ["segment", "total", "mean"])
    return gold.integrate_sources(history, facts, "Segment", HISTORY_NAMES, FACT_NAMES, "year", 2023)


@query(
    f"select c_mktsegment as category, 2023 as year, {sql_sum('c_acctbal')} as production, "
    f"{sql_round(sql_mean('c_acctbal'), 2)} as yield from customer group by 1"
)
def integrate_fallback(spark, folder):
    """The history lacks its key column, so the facts stand in with the default year."""
    history = table(spark, folder, "region")
    facts = _segment_totals(spark, folder, ["segment", "total", "mean"])
    return gold.integrate_sources(history, facts, "Segment", HISTORY_NAMES, FACT_NAMES, "year", 2023)


@query(
    "select category as nation, year, production, area, rain, humidity, temperature "
    f"from {SQL_FACTS} left join {SQL_FEATURES} using (category, year)"
)
def gold_features(spark, folder):
    return gold.gold_features(
        nation_facts(spark, folder),
        nation_features(spark, folder),
        ["category", "year"],
        ["rain", "humidity", "temperature"],
        ["category", "year", "production", "area", "rain", "humidity", "temperature"],
        {"category": "nation"},
        facts_grouped=True,
    )


@query(
    "select category, year, production, area, rain, humidity, temperature "
    f"from {SQL_FACTS} left join {SQL_FEATURES} using (category, year)"
)
def integrate_mixed_case(spark, folder):
    """A history that spells its keys its own way meets features under the standard names."""
    facts = nation_facts(spark, folder)
    history = facts.withColumn("category", F.concat(F.lit("  "), F.initcap(F.lower("category"))))
    history = history.withColumn("category", F.when(F.trim("category") == "China", "Prc").otherwise(F.col("category")))
    integrated = gold.integrate_sources(history, None, "category", {}, {}, "year", 2023, "category", {"PRC": "CHINA"})
    names = ["category", "year", "production", "area", "rain", "humidity", "temperature"]
    return gold.gold_features(integrated, nation_features(spark, folder), ["category", "year"], names[4:], names)


@query(
    "select category, year, production, round(production / 1000) as rain, humidity, temperature "
    f"from {SQL_FACTS} left join (select category, year, humidity, temperature from {SQL_FEATURES}) using (category, year)"
)
def gold_partial_features(spark, folder):
    """Facts that hold one of the features themselves: theirs stays, the others are joined."""
    facts = nation_facts(spark, folder).drop("area").withColumn("rain", F.round(F.col("production") / 1000))
    names = ["category", "year", "production", "rain", "humidity", "temperature"]
    return gold.gold_features(facts, nation_features(spark, folder), ["category", "year"], names[3:], names)


@query(
    f"select 'category' as part, l_returnflag as key, {sql_round('avg(error_pct)', 2)} as value, count(error_pct) as n from {PREDICTIONS} group by 2 "
    f"union all select 'year', cast(year as varchar), {sql_round('avg(error_pct)', 4)}, count(error_pct) from {PREDICTIONS} group by 2 "
    f"union all select 'histogram', 'all', null, count(error_pct) from {PREDICTIONS} "
    "union all select 'worst', cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar), round(error_pct, 4), 1 from "
    f"(select * from {PREDICTIONS} order by error_pct desc, l_orderkey, l_linenumber limit 10)"
)
def accuracy_pack(spark, folder):
    """Four tables of the pack, one below the other."""
    judged = settle(predictions(spark, folder), "judged")
    pack = analysis.accuracy_pack(judged, "l_returnflag", "year", ["l_orderkey", "l_linenumber"])
    spot = F.concat_ws("-", "l_orderkey", "l_linenumber")
    parts = [
        pack["accuracy_by_category"].select(F.lit("category").alias("part"), F.col("l_returnflag").alias("key"), F.col("mean_error_pct").alias("value"), "n"),
        pack["accuracy_by_year"].select(F.lit("year"), F.col("year").cast("string"), F.round("mean_error_pct", 4), "n"),
        pack["error_histogram"].agg(F.sum("n").alias("n")).select(F.lit("histogram"), F.lit("all"), F.lit(None).cast("double"), "n"),
        pack["worst_predictions"].select(F.lit("worst"), spot, F.round("error_pct", 4), F.lit(1).cast("bigint")),
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(
    "select 'volume' as part, 'real' as key, cast(count(*) as double) as value from orders where o_orderkey % 2 = 0 "
    "union all select 'volume', 'synthetic', count(*) from orders where o_orderkey % 2 <> 0 "
    "union all select 'volume', 'combined', count(*) from orders "
    f"union all select 'trend', 'slope', {sql_round('regr_slope(o_totalprice, o_custkey)', 6)} from orders where o_orderkey % 2 = 0 "
    "union all select 'year', cast(year(o_orderdate) as varchar), count(*) from orders where o_orderkey % 2 = 0 group by 2 "
    "union all select 'density', 'rows', 1"
)
def chart_pack(spark, folder):
    """Chart tables of orders, even keys taken for real rows and odd ones for synthetic ones."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"), F.col("o_custkey").cast("double").alias("customer"), "o_totalprice"
    )
    real, synthetic = orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 <> 0")
    judged = predictions(spark, folder)
    pack = analysis.plot_data(judged, real, synthetic, ["customer"], "o_totalprice", "o_orderstatus", "year")
    density = pack["density_synthetic_o_totalprice"].agg(F.round(F.sum(F.col("density") * (F.col("upper") - F.col("lower"))), 9))
    parts = [
        pack["volume"].select(F.lit("volume").alias("part"), F.col("dataset").alias("key"), F.col("n_rows").cast("double").alias("value")),
        pack["trend_customer"].select(F.lit("trend"), F.lit("slope"), F.round("slope", 6)),
        pack["year_coverage"].select(F.lit("year"), F.col("year").cast("string"), F.col("n").cast("double")),
        density.select(F.lit("density"), F.lit("rows"), density.columns[0]),
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def _sql_report():
    def row(section, metric, value, source):
        return f"select '{section}' as section, {metric} as metric, cast({value} as varchar) as value from {source}"

    def fixed(expression, digits):
        return f"cast({expression} as decimal(28,{digits}))"

    names = ("area", "rain", "target")
    m = (
        "(select sqrt(avg(error * error)) as rmse, avg(abs(error)) as mae, 1 - avg(error * error) / var_pop(actual) as r2, "
        "avg(error_pct) as pct, count(*) as n from p)"
    )
    parts = [
        row("performance", "'model'", "'closed_form'", "(select 1)"),
        row("performance", "'r2'", fixed("r2", 4), m),
        row(
            "performance", "'rating'",
            "case when r2 > 0.9 then 'Excellent' when r2 > 0.8 then 'Good' when r2 > 0.7 then 'Fair' else 'Poor' end", m,
        ),
        row("performance", "'rmse'", fixed("rmse", 2), m),
        row("performance", "'mae'", fixed("mae", 2), m),
        row("performance", "'mean_error_pct'", fixed("pct", 2), m),
        row("performance", "'test_predictions'", "n", m),
        row("data", "'rows_real'", "count(*)", "g"),
        row("data", "'rows_synthetic'", "count(*)", "y"),
        row("data", "'rows_combined'", "(select count(*) from g) + (select count(*) from y)", "(select 1)"),
        row(
            "data", "'augmentation_factor'",
            fixed("cast((select count(*) from y) as double) / (select count(*) from g)", 0), "(select 1)",
        ),
        row("data", "'first_year'", "min(year)", "g"),
        row("data", "'last_year'", "max(year)", "g"),
        row("data", "'categories'", "count(distinct category)", "g"),
    ]
    for label, test in (
        ("< 5%", "error_pct < 5"), ("5-10%", "error_pct >= 5 and error_pct < 10"),
        ("10-20%", "error_pct >= 10 and error_pct < 20"), ("> 20%", "error_pct >= 20"),
    ):
        hits = f"count(*) filter (where {test})"
        parts.append(row("error_bands", f"'n {label}'", hits, "p"))
        parts.append(row("error_bands", f"'pct {label}'", fixed(f"{hits} * 100.0::double / count(*)", 1), "p"))
    for metric, value in (
        ("mean_error_pct", fixed("avg(error_pct)", 2)), ("n", "count(error_pct)"), ("mean_actual", fixed("avg(actual)", 2)),
    ):
        parts.append(row("by_category", f"'{metric} ' || l_returnflag", value, "p group by l_returnflag"))
    for a in names:
        for b in names:
            parts.append(row("correlation", f"'r {a} {b}'", fixed(f"corr({a}, {b})", 3), "g"))
    t = f"(select year, {sql_sum('target')} as total from g group by 1)"
    first, last = f"(select min_by(total, year) from {t})", f"(select max_by(total, year) from {t})"
    years = "(select max(year) - min(year) from g)"
    parts += [
        row("trend", "'first_total'", fixed(first, 0), "(select 1)"),
        row("trend", "'last_total'", fixed(last, 0), "(select 1)"),
        row("trend", "'growth_pct'", fixed(f"(pow({last} / {first}, 1.0::double / {years}) - 1) * 100", 2), "(select 1)"),
    ]
    return f"with p as (select * from {PREDICTIONS}), g as (select * from {SQL_REAL}), y as (select * from {SQL_TARGETS}) " + (
        " union all ".join(parts)
    )


@query(_sql_report())
def report_table(spark, folder):
    return analysis.report_table(
        predictions(spark, folder).withColumnRenamed("l_returnflag", "category"),
        settle(real_rows(spark, folder), "gold"),
        drawn_targets(spark, folder),
        "category",
        "year",
        "target",
        ["area", "rain"],
        "closed_form",
        target_scale=2,
    )
