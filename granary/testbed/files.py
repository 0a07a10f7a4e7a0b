"""Scans and sinks on files written from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.sources import delimited, landing, tables
from granary.sources.workspace import scratch_path
from granary.testbed.registry import query, table

LISTED = ("customer", "nation", "orders", "supplier")


def _as_csv(df, spark, label, sep, partition_by=None):
    path = scratch_path(spark, label)
    writer = df.write.option("header", True).option("sep", sep)
    (writer.partitionBy(partition_by) if partition_by else writer).csv(path)
    return path


@query(" union all ".join(f"select '{n}.parquet' as name, count(*) as n_rows, true as has_bytes from {n}" for n in LISTED))
def landing_manifest(spark, folder):
    """Listed files with the rows that are read from them."""
    listed = landing.manifest(spark, folder, "*.parquet").select("name", (F.col("length") > 0).alias("has_bytes"))
    read = table(spark, folder, LISTED[0]).select(F.col("_metadata.file_name").alias("name"))
    for n in LISTED[1:]:
        read = read.union(table(spark, folder, n).select(F.col("_metadata.file_name")))
    rows = read.groupBy("name").agg(F.count("*").alias("n_rows"))
    return listed.join(rows, "name").select("name", "n_rows", "has_bytes")


@query("select 'customer' as copied, count(*) as n_rows, cast(sum(c_custkey) as bigint) as keys from customer")
def landing_copy(spark, folder):
    """The customer file copied byte for byte and read from where it landed."""
    files = landing.manifest(spark, folder, "customer.parquet")
    target = scratch_path(spark, "landed")
    done = landing.landing_summary(landing.land_files(files, target)).first()
    if done.failed or not done.succeeded:
        raise OSError("landing failed")
    back = spark.read.parquet(f"{target}/customer.parquet")
    return back.agg(
        F.lit("customer").alias("copied"), F.count("*").alias("n_rows"), F.sum("c_custkey").alias("keys")
    )


@query(
    "select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, "
    "cast(cast(c_acctbal as decimal(18,2)) as varchar) as c_acctbal, c_mktsegment from customer"
)
def scan_csv_semicolon(spark, folder):
    customer = table(spark, folder, "customer")
    text = customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    return delimited.scan_delimited(spark, _as_csv(text, spark, "semicolon", ";"), ";")


@query(
    "select cast(s_suppkey as int) as s_suppkey, s_name, cast(s_nationkey as int) as s_nationkey, s_acctbal "
    "from supplier"
)
def scan_csv_inferred(spark, folder):
    path = _as_csv(table(spark, folder, "supplier"), spark, "inferred", ",")
    return delimited.scan_delimited_inferred(spark, path)


@query(
    "select cast(p_partkey as varchar) as p_partkey, p_name, p_brand, p_type, "
    "cast(p_size as varchar) as p_size from part"
)
def scan_csv_sniff(spark, folder):
    part = table(spark, folder, "part").drop("p_retailprice")
    return delimited.scan_sniffed(spark, _as_csv(part, spark, "sniff", ";"))


@query(
    "select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, "
    "o_orderstatus as code from orders"
)
def scan_tagged_files(spark, folder):
    """Orders split into one folder of files per status; the status is recovered from the path."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = _as_csv(orders, spark, "tagged", ";", "o_orderstatus")
    return delimited.scan_tagged_files(spark, path, pattern=r"o_orderstatus=([^/]+)/")


@query(
    "select cast(c_custkey as varchar) as c_custkey, c_name, case when c_custkey % 2 = 0 then 'even' else 'odd' end as code "
    "from customer"
)
def scan_mixed_headers(spark, folder):
    """Two sets of files below one root, the columns of one in the other order."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    root = scratch_path(spark, "mixed")
    customer.where("c_custkey % 2 = 0").write.option("header", True).csv(f"{root}/even")
    customer.where("c_custkey % 2 <> 0").select("c_name", "c_custkey").write.option("header", True).csv(f"{root}/odd")
    return delimited.scan_tagged_files(spark, root, ",", pattern=r"/([^/]+)/[^/]+\.csv$").select("c_custkey", "c_name", "code")


ODD_NAMES = ("a[1]", "b{2}", "c d+e%20")


@query(
    "select cast(c_custkey as varchar) as c_custkey, c_name, "
    "case c_custkey % 3 when 0 then 'a[1]' when 1 then 'b{2}' else 'c d+e%20' end as code from customer"
)
def scan_odd_names(spark, folder):
    """Folders whose names would be patterns or escapes in a list of paths; one of them has another header."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    root = scratch_path(spark, "odd")
    for i, name in enumerate(ODD_NAMES):
        part = customer.where(F.col("c_custkey") % 3 == i)
        (part.select("c_name", "c_custkey") if i == 1 else part).write.option("header", True).csv(f"{root}/{name}")
    rows = delimited.scan_tagged_files(spark, root, ",", pattern=r"/([^/]+)/[^/]+\.csv$")
    return rows.select("c_custkey", "c_name", "code")


KINDS = {
    "line0": ("l_orderkey", "l_linenumber", "note"),
    "line1": ("note", "l_linenumber", "l_orderkey", "l_quantity"),
    "line2": ("l_linenumber", "l_orderkey"),
    "line3": ("l_shipdate", "note", "l_quantity", "l_orderkey", "l_linenumber"),
    "line4": ("l_orderkey", "note", "l_linenumber", "l_shipdate"),
}


def _sql_kinds() -> str:
    held = lambda name: ", ".join(f"'{k}'" for k, names in KINDS.items() if name in names)
    optional = {"note": "l_returnflag || ';' || l_linestatus || ' \"of\" ' || l_suppkey", "l_quantity": "cast(cast(l_quantity as int) as varchar)",
                "l_shipdate": "strftime(l_shipdate, '%Y-%m-%d')"}
    columns = [f"case when code in ({held(n)}) then {e} end as {n}" for n, e in optional.items()]
    return (
        f"select code, cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber, {', '.join(columns)} "
        "from (select *, 'line' || (l_linenumber % 5) as code from lineitem)"
    )


@query(_sql_kinds())
def scan_many_headers(spark, folder):
    """Line items in files by line number, each with other columns in another order, quotes and separators in one of them: one scan."""
    note = F.concat("l_returnflag", F.lit(";"), "l_linestatus", F.lit(' "of" '), "l_suppkey")
    items = table(spark, folder, "lineitem").withColumns(
        {"note": note, "l_quantity": F.col("l_quantity").cast("int"), "l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd")}
    )
    root = scratch_path(spark, "kinds")
    for i, (code, names) in enumerate(KINDS.items()):
        part = items.where(F.col("l_linenumber") % len(KINDS) == i).select(*names)
        part.write.options(header=True, sep=";", escape='"').csv(f"{root}/{code}")
    rows = delimited.scan_tagged_files(spark, root, ";", pattern=r"/([^/]+)/[^/]+\.csv$", options={"escape": '"'})
    return rows.select("code", "l_orderkey", "l_linenumber", "note", "l_quantity", "l_shipdate")


@query(
    "select 'read' as status, count(distinct c_nationkey) as n_files, count(*) as n_rows from customer "
    "union all select 'repeated column', 1, 0"
)
def scan_report(spark, folder):
    """Customers in a file for each nation and one file that repeats a column: what is read, what is left out, and the rows."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    root = scratch_path(spark, "reported")
    customer.repartition(1).write.option("header", True).partitionBy("c_nationkey").csv(root)
    spark.createDataFrame([("c_custkey,C_custkey",), ("1,2",)], "value string").coalesce(1).write.text(f"{root}/twice")
    read = delimited.scan_tagged_files(spark, root, ",", pattern=r"/([^/]+)/[^/]+$", glob="part-*").groupBy("code").agg(F.count("*").alias("n"))
    report = delimited.scan_report(spark, root, ",", "part-*").withColumn("code", F.regexp_extract("relative_path", "([^/]+)/[^/]+$", 1))
    return report.join(read, "code", "left").groupBy("status").agg(
        F.count("*").alias("n_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")
    )


@query("select * from orders")
def scan_parquet(spark, folder):
    return tables.scan_table(spark, f"{folder}/orders.parquet")


@query(
    "select 'labels' as dataset, count(*) as n_rows, true as is_primary from labels "
    "union all select 'events', count(*), false from events"
)
def scan_optional(spark, folder):
    names = ("missing", "labels", "events")
    return tables.availability(tables.scan_available(spark, {n: f"{folder}/{n}.parquet" for n in names}))


@query("select * from part")
def sink_parquet_roundtrip(spark, folder):
    path = scratch_path(spark, "part")
    tables.write_table(table(spark, folder, "part"), path, partition_by=["p_brand"])
    back = spark.read.parquet(path)
    return back.select(table(spark, folder, "part").columns)


@query("select count(*) as written, count(*) as read_back, true as ok from orders")
def sink_verify(spark, folder):
    return tables.write_verified(table(spark, folder, "orders"), scratch_path(spark, "verified"))


@query("select * from part where p_partkey % 2 = 1")
def publish_versions(spark, folder):
    """A table published twice, then once more by a job that fails on its way: readers still find the second version whole."""
    part, path = table(spark, folder, "part"), scratch_path(spark, "published")
    tables.publish(part, path)
    tables.publish(part.where("p_partkey % 2 = 1"), path)
    broken = part.withColumn("p_size", F.when(F.col("p_partkey") > 100, F.raise_error("no such part").cast("int")).otherwise(F.col("p_size")))
    try:
        tables.publish(broken.repartition(4, "p_partkey"), path)
    except Exception as expected:
        if "no such part" not in str(expected):
            raise
    return tables.published(spark, path)


@query("select * from supplier")
def export_copy(spark, folder):
    """A written table exported to another place and read from there."""
    source, target = scratch_path(spark, "supplier"), scratch_path(spark, "exported")
    tables.write_table(table(spark, folder, "supplier"), source)
    if not tables.export_table(spark, source, target):
        raise OSError("export failed")
    return spark.read.parquet(target)


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE")


@query(
    " union all ".join(
        f"select '{p}' as dataset, not exists (select 1 from orders where o_orderpriority = '{p}' and o_orderkey % 3 = 1) as is_empty" for p in PRIORITIES
    )
)
def empty_guard(spark, folder):
    """Which priorities have no order of a kind, by the guard that stages ask before they go on: one job for all."""
    orders = table(spark, folder, "orders").where("o_orderkey % 3 = 1")
    return tables.which_are_empty({p: orders.where(F.col("o_orderpriority") == p) for p in PRIORITIES})


@query("select o_orderpriority, cast(count(*) as int) as n from orders group by 1")
def sink_csv_roundtrip(spark, folder):
    report = table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    path = scratch_path(spark, "report")
    tables.write_report(report, path)
    return delimited.scan_delimited(spark, path, schema="o_orderpriority string, n int")


@query(
    "select d.label, d.weight, count(e.event_id) as n from "
    "(values ('view', 1), ('click', 2), ('purchase', 3), ('refund', 4)) as d(label, weight) "
    "left join events e on e.event_type = d.label group by 1, 2"
)
def literal_table(spark, folder):
    rows = [("view", 1), ("click", 2), ("purchase", 3), ("refund", 4)]
    labels = tables.literal_table(spark, rows, "label string, weight int")
    seen = table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    joined = labels.join(seen, labels.label == seen.event_type, "left")
    return joined.select("label", "weight", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
