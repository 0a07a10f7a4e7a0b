"""Landing raw files: what is there, and copying it byte for byte, one task per file group."""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote, unquote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COPY_SCHEMA = "relative_path string, target string, ok boolean, message string"
FILES_PER_TASK = 8
CHUNK = 8 << 20

# The task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_store(uri: str):
    """Arrow file system and path of a Spark path (``file:/x``, ``hdfs://..``, ``s3a://..``)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(quote(uri.replace("s3a://", "s3://", 1), safe="/:@"))


def below(glob: str | None) -> dict[str, object]:
    """Reader options for all files below a folder whose names match."""
    return {"recursiveFileLookup": True, "pathGlobFilter": glob} if glob else {}


def manifest(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """One row per file below ``root``: path, relative_path, name, length, modified.

    The ``content`` column is never selected, so no file is opened. The scan
    passes over empty files; they are added from the reader's own listing.
    """
    files = spark.read.format("binaryFile").options(**below(glob)).load(root)
    listed = [(_plain(p),) for p in files.inputFiles()]
    seen = files.select("path", "length", F.col("modificationTime").alias("modified"))
    return (
        spark.createDataFrame(listed, "path string")
        .join(seen, "path", "left")
        .select(
            "path",
            relative_to(F.col("path"), root).alias("relative_path"),
            F.element_at(F.split("path", "/"), -1).alias("name"),
            F.coalesce("length", F.lit(0)).cast("bigint").alias("length"),
            "modified",
        )
    )


def _plain(uri: str) -> str:
    """A listed, percent-encoded URI in the spelling of the ``path`` column."""
    return unquote(uri.replace("file:///", "file:/", 1) if uri.startswith("file:///") else uri)


def relative_to(path: Column, root: str) -> Column:
    """Part of a file path below ``root``, whatever scheme and authority the reader put in front."""
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root)
    absolute = bare != root or root.startswith("/")
    front = r"^([A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?)?/" if absolute else "^.*?/"
    below = bare.strip("/") + "/" if bare.strip("/") else ""
    return F.regexp_replace(path, rf"{front}\Q{below}\E", "")


def require_folders(files: DataFrame, names: Sequence[str]) -> None:
    """Fail unless each named first-level folder holds at least one file of the manifest."""
    top = F.split("relative_path", "/")
    present = files.where(F.size(top) > 1).select(F.get(top, 0).alias("top"))
    found = {r.top for r in present.where(F.col("top").isin(*names)).distinct().collect()}
    absent = [n for n in names if n not in found]
    if absent:
        raise FileNotFoundError(f"expected folders without files: {', '.join(absent)}")


def _spread(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """A few file names for each task: by their few bytes they would all end in one."""
    return files.repartition(tasks or 1 + files.count() // FILES_PER_TASK, "path")


def _copy_files(target_root: str):
    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = []
            for path, relative in zip(batch["path"], batch["relative_path"]):
                target = f"{target_root}/{relative}"
                try:
                    source_fs, source = open_store(path)
                    target_fs, final = open_store(target)
                    target_fs.create_dir(final.rsplit("/", 1)[0], recursive=True)
                    # a private name, then a rename: a retried or doubled task leaves one whole file
                    part = f"{final}.{uuid.uuid4().hex}.part"
                    with source_fs.open_input_stream(source) as src:
                        with target_fs.open_output_stream(part) as dst:
                            while chunk := src.read(CHUNK):
                                dst.write(chunk)
                    target_fs.move(part, final)
                    done.append((relative, target, True, None))
                except Exception as problem:  # a failed file is reported, the others go on
                    done.append((relative, target, False, str(problem)))
            yield pd.DataFrame(done, columns=["relative_path", "target", "ok", "message"])

    return copy


def land_files(files: DataFrame, target_root: str, tasks: int | None = None) -> DataFrame:
    """Copy every file of a manifest under the same relative path, replacing what is there.

    Only file names are shuffled; each task streams its files in small chunks.
    Returns one row per file; written once, so reading the result copies nothing again.
    """
    from granary.sources.workspace import settle

    spread = _spread(files.select("path", "relative_path"), tasks)
    copied = spread.mapInPandas(_copy_files(target_root.rstrip("/")), COPY_SCHEMA)
    return settle(copied, "landing")


def landing_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("total"),
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
    )
