"""Delimited text with a header line.

Messy files are read with an all-string schema and cast on purpose later:
inferring doubles first and cleaning them as text afterwards destroys values
that print in scientific notation. It also saves the extra pass of inference.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.sources.landing import below, manifest
from granary.sources.workspace import scratch_path, settle

BOM = "\ufeff"

# The task function travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def header_names(line: str, sep: str) -> list[str]:
    return [n.strip() for n in next(csv.reader([line.lstrip(BOM)], delimiter=sep), [])]


def string_schema(names: Sequence[str], corrupt: str | None = None) -> T.StructType:
    """All-string schema; ``corrupt`` adds a column for the text of lines that do not fit it."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, *([corrupt] if corrupt else [])]])


def _header_line(spark: SparkSession, path: str, glob: str | None = None) -> str | None:
    """The first line of the first file, through the reader itself."""
    row = spark.read.options(**below(glob)).text(path).first()
    return None if row is None else row.value.lstrip(BOM)


def _reader(spark: SparkSession, sep: str, corrupt: str | None = None):
    """Every file's header is held against the schema; another order or name fails instead of mixing columns up."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8").option("enforceSchema", False)
    return reader.option("columnNameOfCorruptRecord", corrupt) if corrupt else reader


def _raw_names(line: str, sep: str) -> list[str]:
    """Header names as they are written, blanks around them included."""
    return next(csv.reader([line.lstrip(BOM)], delimiter=sep), [])


def scan_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: str | T.StructType | None = None,
    corrupt: str | None = None,
    glob: str | None = None,
    first: str | None = None,
    skip_unreadable: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files that share one header; a file whose header differs fails. Without a schema every column is a string.

    ``first`` gives the header line where it is known, ``options`` go to the parser. A line with too few or too many fields keeps what fits; ``corrupt`` names
    a column to hold such a line's text. Spark parses only the columns a query
    uses, so write the table before asking for that column alone.
    """
    reader = _reader(spark, sep, corrupt).options(**below(glob), ignoreCorruptFiles=skip_unreadable, **(options or {}))
    if schema is not None:
        return reader.schema(schema).csv(path)
    raw = _raw_names(first or _header_line(spark, path, glob) or "", sep)
    rows = reader.schema(string_schema(raw, corrupt)).csv(path)
    return rows.withColumnsRenamed({n: n.strip() for n in raw if n != n.strip()})


def scan_delimited_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Types inferred from all values, at the price of a pass over the text."""
    return _reader(spark, sep).option("inferSchema", True).csv(path)


def sniff_separator(spark: SparkSession, path: str, preferred: str = ",", other: str = ";") -> str:
    """``other`` if the header has only one column under ``preferred``; reads one line."""
    line = _header_line(spark, path)
    return preferred if line and len(header_names(line, preferred)) > 1 else other


def scan_sniffed(spark: SparkSession, path: str, preferred: str = ",", other: str = ";") -> DataFrame:
    return scan_delimited(spark, path, sniff_separator(spark, path, preferred, other))


def file_tag(pattern: str, uri: str = "_metadata.file_path") -> Column:
    """Tag of a row taken from its file's path by the first group of ``pattern``."""
    tag = F.regexp_extract(F.col(uri), pattern, 1)
    return F.try_url_decode(F.replace(tag, F.lit("+"), F.lit("%2B")))


def file_headers(spark: SparkSession, root: str, glob: str = "*.csv", skip_unreadable: bool = False) -> DataFrame:
    """(uri, header) of every file below ``root`` that has a line; a written table.

    Lines come from Spark's own text reader, so any store a session can read will do. Every split is
    a task of its own that ends after its first line, so no text is read for its header's sake.
    """
    own = spark.newSession()  # with settings of its own: one split a task, small batches
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    meta = [F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("block")]
    lines = own.read.options(**below(glob), ignoreCorruptFiles=skip_unreadable).text(root).select(*meta, "value")
    path = scratch_path(spark, "headers")
    first = lines.mapInArrow(_first_row, lines.schema).where("block = 0")
    first.select("uri", F.regexp_replace("value", f"^{BOM}|\\r$", "").alias("header")).write.parquet(path)
    return spark.read.schema("uri string, header string").parquet(path)


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def scan_report(spark: SparkSession, root: str, sep: str = ";", glob: str = "*.csv") -> DataFrame:
    """(relative_path, status, header) of every file below ``root``: read, or why it is left out."""
    heads = file_headers(spark, root, glob, skip_unreadable=True)
    listed = manifest(spark, root, glob).select("path", "relative_path", "length")
    found = heads.select(_spelled("uri").alias("path"), "header")
    names = F.transform(F.split("header", F.lit(f"\\Q{sep}\\E")), lambda n: F.lower(F.trim(F.replace(n, F.lit('"'), F.lit("")))))
    status = (
        F.when(F.col("header").isNull() & (F.col("length") > 0), "unreadable")
        .when(F.coalesce(F.trim("header"), F.lit("")) == "", "empty")
        .when(F.size(F.array_distinct(names)) < F.size(names), "repeated column")
        .otherwise("read")
    )
    return listed.join(found, "path", "left").select("relative_path", status.alias("status"), "header")


def _spelled(uri: str) -> Column:
    """A percent-encoded URI in the spelling of a listed path."""
    return F.regexp_replace(F.try_url_decode(F.replace(F.col(uri), F.lit("+"), F.lit("%2B"))), "^file:///", "file:/")


def scan_tagged_files(
    spark: SparkSession,
    root: str,
    sep: str = ";",
    tag: str = "code",
    pattern: str = r"([^/]+)\.csv$",
    glob: str = "*.csv",
    codes: Sequence[str] | None = None,
    same_header: bool = False,
    corrupt: str | None = None,
    skip_unreadable: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame | None:
    """All files below ``root``, each row tagged from its path; columns meet by name.

    One scan of the text, whatever the number of headers. Where all headers agree it is a plain read. Otherwise
    lines are read as text, meet their file's header by a join on the path, and are parsed at the width of that
    header; every column is then taken from where the file has it, absent ones are null, and lines equal to the header are dropped.
    File names are never put together to a list of paths, so they may hold any character. Files that are empty or repeat a
    column name are left out; ``scan_report`` tells which. Codes without a file are simply not there; None if nothing is left.
    ``same_header`` promises one header for all and saves looking at first lines; a file that breaks the promise fails.
    ``options`` go to the parser (quote, escape, ...). ``skip_unreadable`` passes over files that cannot be read, and over the rest of a file that breaks off; ``scan_report`` names the former.
    """
    wanted = None if codes is None else F.col(tag).isin(*codes)
    chosen = F.lit(True) if wanted is None else wanted
    if not same_header:
        heads = file_headers(spark, root, glob, skip_unreadable).withColumn(tag, file_tag(pattern, "uri")).where(chosen)
        distinct = [r.header for r in heads.select("header").distinct().orderBy("header").collect()]  # headers, not files
        sound = {h: header_names(h, sep) for h in distinct if h.strip()}
        sound = {h: names for h, names in sound.items() if len({n.lower() for n in names}) == len(names)}
        if not sound:
            return None
        if len(distinct) > 1:
            return _parsed(spark, root, glob, heads, sound, sep, tag, corrupt, skip_unreadable, dict(options or {}))
    elif not _header_line(spark, root, glob):
        return None
    else:
        distinct = None
    rows = scan_delimited(spark, root, sep, corrupt=corrupt, glob=glob, first=distinct and distinct[0], skip_unreadable=skip_unreadable, options=options)
    return rows.withColumn(tag, file_tag(pattern)).where(chosen)


def _struct(width: int, corrupt: str | None) -> str:
    """Schema of a line with ``width`` fields."""
    names = [*(f"c{i}" for i in range(width)), *([f"`{corrupt.replace('`', '``')}`"] if corrupt else [])]
    return ", ".join(f"{n} string" for n in names)


def _parsed(
    spark: SparkSession, root: str, glob: str, heads: DataFrame, sound: Mapping[str, Sequence[str]], sep: str, tag: str,
    corrupt: str | None, skip_unreadable: bool, options: dict[str, str],
) -> DataFrame:
    """Rows of the files whose header is among ``sound``, parsed from their lines in one scan."""
    spelled = {n.lower(): n for names in reversed(sound.values()) for n in names}  # columns meet whatever their case, as tables do
    columns = [spelled[k] for k in dict.fromkeys(n.lower() for names in sound.values() for n in names)]
    kinds = spark.createDataFrame(
        [(h, len(names), [{n.lower(): i for i, n in enumerate(names)}.get(c.lower()) for c in columns]) for h, names in sound.items()],
        "header string, width int, at array<int>",
    )
    files = settle(heads.join(kinds, "header").select("uri", tag, "header", "width", "at"), "files")
    lines = spark.read.options(**below(glob), ignoreCorruptFiles=skip_unreadable).text(root)
    lines = lines.select(F.col("_metadata.file_path").alias("uri"), F.regexp_replace("value", f"^{BOM}|\\r$", "").alias("value"))
    lines = lines.join(files, "uri").where((F.col("value") != F.col("header")) & (F.trim("value") != ""))
    options |= {"sep": sep} | ({"columnNameOfCorruptRecord": corrupt} if corrupt else {})
    fields = None
    for width in sorted({len(names) for names in sound.values()}):
        row = F.array(F.from_csv("value", F.lit(_struct(width, corrupt)), options))
        parsed = F.get(F.transform(row, _told(width, corrupt)), 0)
        fields = F.when(F.col("width") == width, parsed) if fields is None else fields.when(F.col("width") == width, parsed)
    parsed = lines.select(tag, "at", fields.alias("row"))
    out = [F.get(F.col("row.values"), F.get("at", i)).alias(n) for i, n in enumerate(columns)]
    return parsed.select(*out, *([F.col("row.raw").alias(corrupt)] if corrupt else []), tag)


def _told(width: int, corrupt: str | None) -> Callable[[Column], Column]:
    """A parsed line as its values, and the line itself if it does not fit."""

    def told(row: Column) -> Column:
        values = F.array(*[row[f"c{i}"] for i in range(width)])
        return F.struct(values.alias("values"), (row[corrupt] if corrupt else F.lit(None).cast("string")).alias("raw"))

    return told
