"""Where intermediate tables live, and how to settle one there."""

from __future__ import annotations

import gc
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a fresh local one only for local runs that name none."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    return _local_folder(spark.conf.get("spark.app.id", "session"))


@lru_cache
def _local_folder(owner: str) -> str:
    return tempfile.mkdtemp(prefix=f"granary-{owner}-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, grouped by application so that old ones can be cleared."""
    owner = spark.conf.get("spark.app.id", "session")
    return f"{shared_folder(spark)}/granary/{owner}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a table once to the shared folder and go on from the written copy.

    Cuts the lineage in a way that outlives executors, and gives the planner
    the table's true size: a later join broadcasts it only when it is small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*written: DataFrame) -> None:
    """Remove settled tables that nothing reads any more."""
    for table in written:
        jvm, files = table.sparkSession._jvm, table.inputFiles()
        for folder in {f.rpartition("/")[0] for f in files}:
            place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of queries that have ended; it does so once the driver has collected their plans."""
    gc.collect()
    spark._jvm.System.gc()


def clear_scratch(spark: SparkSession) -> None:
    """Remove the tables this application has settled; call it when no result of theirs is read any more."""
    owner = spark.conf.get("spark.app.id", "session")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/granary/{owner}")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def is_broadcast(written: DataFrame) -> bool:
    """Whether a settled table is small enough, in bytes, for the session to broadcast it."""
    spark = written.sparkSession
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    text = str(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most)) if not most.startswith("-") else "-1"
    return int(str(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= int(text)
