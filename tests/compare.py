"""Runs the registered queries next to their SQL in DuckDB and compares all rows.

    python tests/compare.py [scale] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("granary-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns, value kinds and rows, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected_kinds = {d[0]: str(d[1]) for d in cursor.description}
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != expected_kinds[name]:
            return f"{name}: {kind} != {expected_kinds[name]}"
    found_rows = [tuple(r) for r in df.collect()]
    found, expected = _rows(df.columns, found_rows), _rows(names, expected_rows)
    if len(found) != len(expected):
        return f"{len(found)} rows != {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(scale: str = "0.01", *wanted: str) -> int:
    sys.path.insert(0, str(Path(__file__).parents[1]))
    from granary.testbed import load_all

    spark, folder, bad = local_session(), str(DATA / f"sf{scale}"), 0
    con = oracle(folder)
    for name, q in load_all().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = q.run(spark, folder)
            if q.sql is None:
                told = f"{len(df.collect())} rows, no SQL"
            else:
                problem = difference(df, con, q.sql)
                bad += problem is not None
                told = problem or "same"
        except Exception as error:
            bad += 1
            told = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {told}", flush=True)
    print(f"{bad} wrong")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
