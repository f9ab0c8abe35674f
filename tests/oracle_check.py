"""Compares registered queries with their SQL on one data folder.

    python tests/oracle_check.py [folder] [name …]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from carestitch.bridge.views import BASE_TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return str(value) if not isinstance(value, (int, str)) else value


def rows(names, records) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in records), key=repr)


def compare(spark: SparkSession, con, name: str, folder: str) -> str | None:
    """None if equal, else what differs."""
    df = entry.queries()[name](spark, folder)
    ours = rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if ours else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows / {len(theirs)} rows"
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if not ours:
        return "both empty"
    return f"{len(different)} rows differ, first {different[0]}" if different else None


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # report every query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
