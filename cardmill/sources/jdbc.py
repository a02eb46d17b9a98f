"""Relational tables over JDBC: parallel reads and batched writes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """A database and how to reach it; the password stays out of the representation."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = "org.postgresql.Driver"
    schema: str | None = "public"

    def options(self) -> dict[str, str]:
        given = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {k: v for k, v in given.items() if v is not None}

    def qualified(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema and "." not in table else table


def range_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Reader options that split a numeric column's range over ``partitions`` connections.

    Bounds only place the cuts; rows outside them, and NULLs, are read by the first and last partition.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    if lower >= upper or partitions == 1:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def bounds_query(table: str, column: str) -> str:
    """Smallest and largest value of a column, as SQL for the database."""
    return f"SELECT min({column}) AS lower_bound, max({column}) AS upper_bound FROM {table}"


def page_query(
    table: str, order_by: Sequence[str], page: int = 1, size: int = 20, columns: Sequence[str] = ()
) -> str:
    """One page of a table in a mandatory order, as SQL for the database.

    All ``columns`` that are not in the order end it, so that rows with equal keys are on one page each.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size must be at least 1")
    if not order_by:
        raise ValueError("a page needs an order")
    named = {o.split()[0].strip('"') for o in order_by}
    order = ", ".join([*order_by, *(f'"{c}"' for c in columns if c not in named)])
    return f"SELECT * FROM {table} ORDER BY {order} LIMIT {size} OFFSET {(page - 1) * size}"


def read_jdbc_query(spark: SparkSession, target: JdbcTarget, query: str) -> DataFrame:
    """Result of SQL that the database runs, read over one connection."""
    return spark.read.format("jdbc").options(**target.options()).option("query", query).load()


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    partition_column: str | None = None,
    partitions: int = 8,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table over JDBC. With a numeric ``partition_column`` it is read by ``partitions`` tasks, else by one.

    The database computes the bounds; only two numbers reach the driver.
    """
    name, options = target.qualified(table), {}
    if partition_column is not None:
        lower, upper = read_jdbc_query(spark, target, bounds_query(name, partition_column)).first()
        if lower is not None:
            options = range_options(partition_column, int(lower), int(upper) + 1, partitions)
    return (
        spark.read.format("jdbc")
        .options(**target.options(), **options)
        .option("dbtable", name)
        .option("fetchsize", fetch_size)
        .load()
    )


def write_jdbc(
    df: DataFrame,
    target: JdbcTarget,
    table: str,
    mode: str = "overwrite",
    connections: int = 16,
    batch_size: int = 10_000,
    truncate: bool = False,
    column_types: str | None = None,
) -> None:
    """Write ``df`` to a table with at most ``connections`` parallel connections.

    The writer creates a missing table with the types of the database's dialect, except where
    ``column_types`` names others. ``truncate`` keeps an existing table's definition on overwrite. Each
    partition is one transaction, so a failed task leaves no rows behind; a task whose commit was lost with
    its executor inserts again, so give the table a unique key where that matters.
    """
    options = write_options(target, table, connections, batch_size, truncate, column_types)
    if re.search(r"(?<!Broadcast)Exchange", df._jdf.queryExecution().executedPlan().toString()):
        # A broadcast is no shuffle. The writer coalesces, and so would run an aggregation before it in few tasks; a shuffle keeps that parallel.
        df = df.repartition(connections)
    df.write.format("jdbc").options(**options).mode(mode).save()


def write_options(
    target: JdbcTarget,
    table: str,
    connections: int = 16,
    batch_size: int = 10_000,
    truncate: bool = False,
    column_types: str | None = None,
) -> dict[str, str]:
    """Writer options for a table of the target's schema, the one that ``read_jdbc`` reads."""
    given = {
        "dbtable": target.qualified(table),
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        "truncate": str(truncate).lower(),
        "createTableColumnTypes": column_types,
    }
    return {**target.options(), **{k: v for k, v in given.items() if v is not None}}


def create_jdbc_table(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Create a table with the columns of ``df`` if it does not exist; no row is written."""
    write_jdbc(df.limit(0), target, table, mode="ignore")


def save_to_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Shorthand: overwrite ``table`` at ``url``."""
    df.write.jdbc(url=url, table=table, mode="overwrite", properties=properties)
