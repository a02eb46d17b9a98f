"""Runs queries on Spark and their SQL on DuckDB and compares columns and rows as multisets."""

from __future__ import annotations

import collections
import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _value(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def multiset(columns: list[str], rows) -> collections.Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, con, folder: str, function, sql: str | None) -> tuple[int, str]:
    """Number of rows and '' if equal, else what differs."""
    df = function(spark, folder)
    got = df.collect()
    if sql is None:
        return len(got), "" if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} expected {sorted(columns)}"
    if len(got) != len(expected):
        return len(got), f"{len(got)} rows expected {len(expected)}"
    ours, theirs = multiset(df.columns, got), multiset(columns, expected)
    if ours != theirs:
        return len(got), f"{sorted(columns)}: {list((ours - theirs))[:2]} expected {list((theirs - ours))[:2]}"
    return len(got), ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from cardmill.session import get_session

    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = get_session("compare", "local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    con = connect(folder)
    functions, oracle = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[1:] or list(functions)
    bad = 0
    for name in wanted:
        start = time.perf_counter()
        try:
            n, problem = compare(spark, con, folder, functions[name], oracle.get(name))
        except Exception as error:  # report every query
            n, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "sql" if name in oracle else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind:4} {name:32} {n:8} {time.perf_counter() - start:6.2f}s {problem}")
    print(f"{len(wanted) - bad} of {len(wanted)} ok")
    sys.exit(bad > 0)
