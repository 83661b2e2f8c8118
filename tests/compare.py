"""Run registered queries on Spark and their SQL on DuckDB, and compare the results.

``python -m tests.compare [folder] [name ...]`` checks all or the named queries.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entrypoint

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def spark_session(cpus: str = os.environ.get("TEST_CPUS", "8")) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cohortlens")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, str(type(value).__name__), str(value)) for value in row)


def _rows(rows, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=_sortable)


def differences(df, connection, sql: str) -> list[str]:
    """Empty when both results hold the same columns and the same rows, exactly."""
    result = connection.execute(sql)
    sql_names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(sql_names):
        return [f"columns {sorted(df.columns)} and {sorted(sql_names)}"]
    found = _rows([tuple(r) for r in df.collect()], df.columns)
    expected = _rows(expected, sql_names)
    problems = []
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows and {len(expected)}")
    names = sorted(df.columns)
    for mine, theirs in zip(found, expected, strict=False):
        if mine != theirs or [type(a) for a in mine] != [type(b) for b in theirs]:
            cells = [
                (n, a, b)
                for n, a, b in zip(names, mine, theirs, strict=True)
                if a != b or type(a) is not type(b)
            ]
            problems.append(str(cells)[:600])
            if len(problems) > 3:
                break
    return problems


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, connection = spark_session(), duck(folder)
    queries, sql = entrypoint.queries(), entrypoint.oracle_sql()
    failed = 0
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sql:
                problems = differences(df, connection, sql[name])
            else:
                problems = [] if df.collect() else ["no rows"]
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        mark = "ok  " if not problems else "FAIL"
        kind = "sql " if name in sql else "rows"
        print(f"{mark} {kind} {time.time() - started:6.2f}s {name}", flush=True)
        for problem in problems:
            print("       ", problem, flush=True)
        failed += bool(problems)
    print(f"{failed} of {len(names or queries)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
