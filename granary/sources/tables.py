"""Parquet tables, report files and fitted models."""

from __future__ import annotations

import time
import uuid
import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """A plain or a published table."""
    return published(spark, path)


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (a file, folder or glob) is there and holds at least one file that a reader would not pass over."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    todo = list(store.globStatus(place) or [])
    while todo:
        status = todo.pop()
        if not status.getPath().getName().startswith((".", "_")):
            if not status.isDirectory():
                return True
            todo += list(store.listStatus(status.getPath()))
    return False


def scan_available(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The named tables that are there, in the order given; the first one is the primary.

    A path that is absent or holds no files is passed over (``left_out`` tells which); a table that is there and cannot be
    read is an error. Only listing and footers are touched. Fails if none is there.
    """
    found = {name: spark.read.parquet(path) for name, path in paths.items() if holds_files(spark, path)}
    if not found:
        raise FileNotFoundError(f"none of the tables is there: {', '.join(paths)}")
    return found


def left_out(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(dataset, path) of the tables that ``scan_available`` passes over."""
    absent = [(name, path) for name, path in paths.items() if not holds_files(spark, path)]
    return spark.createDataFrame(absent, "dataset string, path string")


def labelled_union(tables: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Union by name of the tables, each row carrying its table's name."""
    parts = [df.withColumn(label, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def availability(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, n_rows, is_primary) of the tables found; counts come from footers."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(i == 0).alias("is_primary")
        )
        for i, (name, df) in enumerate(tables.items())
    ]
    return reduce(DataFrame.unionAll, parts)


def is_empty(df: DataFrame | None) -> bool:
    return df is None or df.isEmpty()


def which_are_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, is_empty) of the named tables in one job that looks for one row of each."""
    one = [df.select(F.lit(1)).limit(1).agg(F.lit(name).alias("dataset"), (F.count(F.lit(1)) == 0).alias("is_empty")) for name, df in tables.items()]
    return reduce(DataFrame.unionAll, one)


def write_table(
    df: DataFrame,
    path: str,
    num_files: int | None = None,
    partition_by: Sequence[str] = (),
    compression: str = "snappy",
) -> None:
    """Replace a parquet table.

    By default every task writes what it holds. A fixed file count costs a
    shuffle, but unlike ``coalesce`` leaves the work before it parallel.
    Partition columns bring their rows together first, or each task would
    leave a small file per value; the rebalancing splits a value that holds
    too many rows for one task.
    """
    if num_files:
        out = df.repartition(num_files)
    else:
        out = df.hint("rebalance", *partition_by) if partition_by else df
    writer = out.write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


POINTER, VERSION = "_current", "v-"


def publish(df: DataFrame, path: str, keep: int = 2, **how) -> str:
    """Replace a table in one step; returns the folder of the new version.

    Rows go to a version folder of their own, which nobody reads until it is whole; then a file that names it takes the place of the
    old one by an atomic rename. A job that fails before leaves the old rows as they are, and a reader that began before the swap
    reads on in its version. The last ``keep`` versions stay, older and broken ones are cleared. One writer a table at a time.
    """
    spark = df.sparkSession
    before = current(spark, path).rsplit("/", 1)[1]
    name = f"{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write_table(df, f"{path}/{name}", **how)
    place, store = _store(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(place, f"{POINTER}.{uuid.uuid4().hex}")
    out = store.create(fresh, True)
    out.write(bytearray(name.encode()))
    out.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    files.rename(store.makeQualified(fresh), store.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(place, POINTER)), over)
    found = versions(spark, path)
    whole = [v for v in found if store.exists(spark._jvm.org.apache.hadoop.fs.Path(place, f"{v}/_SUCCESS"))]
    for old in {*found} - {*whole[-keep:], before, name}:
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(place, old), True)
    return f"{path}/{name}"


def _store(spark: SparkSession, path: str):
    """The path, as the session's file systems know it, and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of a published table's version folders, oldest first; unfinished ones among them."""
    place, store = _store(spark, path)
    names = [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []
    return sorted(n for n in names if n.startswith(VERSION))


def current(spark: SparkSession, path: str) -> str:
    """The folder with a table's rows: that of the published version, or the path itself for a plain table."""
    place, store = _store(spark, path)
    pointer = spark._jvm.org.apache.hadoop.fs.Path(place, POINTER)
    if not store.exists(pointer):
        return path
    source = store.open(pointer)
    name = bytes(source.readAllBytes()).decode()
    source.close()
    return f"{path}/{name}"


def published(spark: SparkSession, path: str) -> DataFrame:
    """A table as it was last published, or a plain one."""
    return spark.read.parquet(current(spark, path))


def write_verified(df: DataFrame, path: str, num_files: int | None = None, versioned: bool = False) -> DataFrame:
    """Write (or publish), then compare the rows counted while writing with the footers of what lies there."""
    seen = Observation()
    out = (df.repartition(num_files) if num_files else df).observe(seen, F.count(F.lit(1)).alias("rows"))
    publish(out, path) if versioned else write_table(out, path)
    written = int(seen.get["rows"])
    back = df.sparkSession.read.schema(df.schema).parquet(current(df.sparkSession, path))
    return back.agg(F.count("*").alias("read_back")).select(
        F.lit(written).cast("bigint").alias("written"),
        "read_back",
        (F.col("read_back") == F.lit(written)).alias("ok"),
    )


def export_table(spark: SparkSession, source: str, target: str) -> bool:
    """Copy a table to another place; a target that cannot be written yields False and a warning with the cause."""
    table = published(spark, source)
    try:
        write_table(table, target)
        return True
    except (Py4JJavaError, PySparkException) as problem:
        warnings.warn(f"{source} was not exported to {target}: {problem}", stacklevel=2)
        return False


def write_report(df: DataFrame, path: str) -> None:
    """Small result as CSV with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Small fixed table such as a label dimension."""
    return spark.createDataFrame(list(rows), schema)


def save_model(model: PipelineModel, path: str) -> None:
    """The whole fitted pipeline, preparation included, replacing an older one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
