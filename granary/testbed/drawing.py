"""Sampling, splitting and synthetic rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.cleaning import lookup
from granary.operators import sampling, synth
from granary.testbed.registry import query, sql_round, table

SPAN = "4503599627370496.0::double"
FACTORS = {"NATION_1": 1.2, "NATION_2": 0.9, "NATION_3": 0.8, "NATION_4": 1.3}
YEARS = (1990, 2025)
RULES = (
    synth.RangeRule("area", 0.5, 1.5, floor=10000.0, whole=True),
    synth.RangeRule("rain", 0.8, 1.2, floor=800.0, ceiling=3000.0),
    synth.RangeRule("humidity", 0.95, 1.05, floor=70.0, ceiling=95.0),
    synth.RangeRule("temperature", 0.95, 1.05, floor=24.0, ceiling=32.0),
)
SQL_REAL = (
    "(select n_name as category, cast(year(l_shipdate) as int) as year, l_extendedprice * 10.0::double as area, "
    "l_quantity * 50.0::double as rain, l_discount * 200.0::double + 70.0::double as humidity, "
    "l_tax * 100.0::double + 24.0::double as temperature, cast(l_partkey * 1000 as bigint) as target "
    "from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey)"
)


def sql_uniform(key, salt, half=0):
    digits = f"substr(md5(cast({key} as varchar) || ':{salt}'), {1 + 13 * half}, 13)"
    return f"(cast(cast('0x' || {digits} as bigint) as double) / {SPAN})"


def measures():
    """Lineitem's numbers in the roles of harvest measures."""
    return [
        (F.col("l_extendedprice") * 10.0).alias("area"),
        (F.col("l_quantity") * 50.0).alias("rain"),
        (F.col("l_discount") * 200.0 + 70.0).alias("humidity"),
        (F.col("l_tax") * 100.0 + 24.0).alias("temperature"),
    ]


def observed_ranges(spark, folder):
    return synth.derive_ranges(table(spark, folder, "lineitem").select(*measures()), RULES)


def real_rows(spark, folder):
    """Lineitem in the roles of yearly harvest rows; the supplier's nation is the category."""
    nation = table(spark, folder, "nation")
    supplier = table(spark, folder, "supplier")
    owners = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("category")
    )
    return table(spark, folder, "lineitem").join(owners, "l_suppkey").select(
        "category",
        F.year("l_shipdate").alias("year"),
        *measures(),
        (F.col("l_partkey") * 1000).alias("target"),
    )


def drawn_rows(spark, folder):
    """As many synthetic rows as there are orders."""
    n = table(spark, folder, "orders").count()
    nations = table(spark, folder, "nation").withColumnRenamed("n_name", "category")
    return synth.draw_rows(
        spark, n, observed_ranges(spark, folder), RULES, nations, "category", years=YEARS
    )


def drawn_targets(spark, folder, noisy=False):
    return synth.with_target(
        drawn_rows(spark, folder),
        "target",
        synth.yield_base("area", "rain", "humidity", "temperature"),
        lookup("category", FACTORS, 1.0),
        "year",
        noise=synth.noise_for("id") if noisy else None,
    )


SQL_RANGES = (
    f"(select greatest(min(area) * 0.5::double, 10000.0::double) as area_low, max(area) * 1.5::double as area_high, "
    "greatest(min(rain) * 0.8::double, 800.0::double) as rain_low, least(max(rain) * 1.2::double, 3000.0::double) as rain_high, "
    "greatest(min(humidity) * 0.95::double, 70.0::double) as humidity_low, "
    "least(max(humidity) * 1.05::double, 95.0::double) as humidity_high, "
    "greatest(min(temperature) * 0.95::double, 24.0::double) as temperature_low, "
    f"least(max(temperature) * 1.05::double, 32.0::double) as temperature_high from {SQL_REAL})"
)
SQL_DRAWS = (
    "(with ids as (select row_number() over () - 1 as id from orders), "
    "cats as (select n_name, row_number() over (order by substr(md5(n_name), 1, 3), n_name) as pick, "
    "count(*) over () as k from nation), "
    f"picked as (select id, 1 + cast(floor({sql_uniform('id', '42:row')} * (select count(*) from nation)) as bigint) as pick, "
    f"cast(1990 + floor({sql_uniform('id', '42:row', 1)} * 35) as int) as year from ids) "
    "select id, n_name as category, year, "
    f"cast(trunc(area_low + {sql_uniform('id', '42:values0')} * (area_high - area_low)) as bigint) as area, "
    f"rain_low + {sql_uniform('id', '42:values0', 1)} * (rain_high - rain_low) as rain, "
    f"humidity_low + {sql_uniform('id', '42:values1')} * (humidity_high - humidity_low) as humidity, "
    f"temperature_low + {sql_uniform('id', '42:values1', 1)} * (temperature_high - temperature_low) as temperature "
    f"from picked join cats using (pick), {SQL_RANGES})"
)
SQL_BASE = (
    "(area * 4.5::double + (rain - 1500.0::double) * 0.8::double + (85.0::double - abs(humidity - 82.0::double)) "
    "* 50.0::double + (28.0::double - abs(temperature - 27.0::double)) * 1000.0::double)"
)
SQL_RAW = (
    f"{SQL_BASE} * (case category when 'NATION_1' then 1.2::double when 'NATION_2' then 0.9::double "
    "when 'NATION_3' then 0.8::double when 'NATION_4' then 1.3::double else 1.0::double end) "
    "+ (year - 2000) * 500.0::double"
)
SQL_NOISE = (
    f"sqrt(-2.0::double * ln(1.0::double - {sql_uniform('id', '42:noise')})) "
    f"* cos(2.0::double * pi() * {sql_uniform('id', '42:noise', 1)})"
)
SQL_TARGETS = f"(select *, greatest(1000, cast(trunc({SQL_RAW}) as bigint)) as target from {SQL_DRAWS})"


@query(
    "select o_orderkey, o_totalprice from orders where "
    f"{sql_uniform('o_orderkey', 'sample')} < 0.01::double"
)
def sample_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sampling.keyed_sample(orders, 0.01, ["o_orderkey"])


@query()
def sample_bernoulli(spark, folder):
    return sampling.bernoulli_sample(table(spark, folder, "lineitem"), 0.01, seed=42)


@query(
    f"with s as (select case when {sql_uniform('o_orderkey', 'split-42')} < 0.8::double then 'train' else 'test' end as split, "
    "o_totalprice from orders) select split, count(*) as n, "
    "cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total from s group by 1"
)
def split_train_test(spark, folder):
    train, test = sampling.split_train_test(table(spark, folder, "orders"), ["o_orderkey"])
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )


@query(
    f"with s as (select case when {sql_uniform('o_orderkey', 'split-42')} < 0.8::double then 'train' else 'test' end as split "
    "from orders) select split, count(*) as n, count(*) * 100.0::double / (select count(*) from s) as pct from s group by 1"
)
def split_sizes(spark, folder):
    return sampling.split_sizes(sampling.label_split(table(spark, folder, "orders"), ["o_orderkey"]))


@query(f"select * from {SQL_RANGES}")
def synthetic_ranges(spark, folder):
    return observed_ranges(spark, folder)


@query(f"select * from {SQL_DRAWS}")
def synthetic_draws(spark, folder):
    return drawn_rows(spark, folder)


@query(f"select id, category, year, target from {SQL_TARGETS}")
def synthetic_target(spark, folder):
    return drawn_targets(spark, folder).select("id", "category", "year", "target")


@query(
    f"select id, category, year, greatest(1000, cast(trunc({SQL_RAW} + {SQL_NOISE} * ({SQL_BASE} * 0.1::double)) as bigint)) "
    f"as target from {SQL_DRAWS}"
)
def synthetic_target_noisy(spark, folder):
    return drawn_targets(spark, folder, noisy=True).select("id", "category", "year", "target")


SQL_COMBINED = (
    "(select 'real' as source, category, year, target, area, rain, humidity, temperature from "
    f"{SQL_REAL} union all select 'synthetic', category, year, target, area, rain, humidity, temperature from {SQL_TARGETS})"
)


@query(f"select * from {SQL_COMBINED}")
def union_real_synthetic(spark, folder):
    """Columns meet by name although the two tables order them differently."""
    return synth.combine_with_real(
        real_rows(spark, folder), drawn_targets(spark, folder).drop("id"), source="source"
    )


@query(
    " union all ".join(
        f"select source, '{c}' as \"column\", count({c}) as n, {sql_round(f'avg({c})', 4)} as mean, "
        f"{sql_round(f'stddev_samp({c})', 4)} as stddev, cast(min({c}) as double) as min, cast(max({c}) as double) as max "
        f"from {SQL_COMBINED} group by 1"
        for c in ("area", "rain", "target")
    )
)
def real_vs_synthetic_stats(spark, folder):
    combined = union_real_synthetic(spark, folder)
    return synth.compare_sources(combined, ["area", "rain", "target"], digits=4)
