"""Catalog databases and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cardmill.operators.analytics import YEAR, top_clients
from cardmill.schemas import ddl
from cardmill.session import timestamp_statistics


def create_database(spark: SparkSession, database: str, location: str) -> None:
    location = location.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")


def create_table(
    spark: SparkSession,
    database: str,
    table: str,
    schema: StructType,
    location: str,
    partition_by: Sequence[str] = (),
) -> None:
    """Declare a Parquet table at ``location``; the partition columns must be in ``schema``."""
    location = location.replace("'", "\\'")
    partitions = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({ddl(schema)}) "
        f"USING parquet {partitions} LOCATION '{location}'"
    )


def write_table(
    df: DataFrame, database: str, table: str, path: str, partition_by: Sequence[str] = ()
) -> None:
    """Replace a catalog table with ``df``, stored at ``path``."""
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with timestamp_statistics(df.sparkSession):
        writer.saveAsTable(f"`{database}`.`{table}`")


def write_bucketed(df: DataFrame, database: str, table: str, path: str, key: str, buckets: int) -> None:
    """Replace a catalog table with ``df`` in ``buckets`` files by the hash of ``key``, each sorted by it.

    Two tables with as many buckets join on their keys without a shuffle, every time they are read; a table that is
    joined again and again pays for its shuffle once, here. Rows are dealt out as the buckets are, so each bucket is
    one file. All rows of a key share a bucket: this is for keys that tell rows apart, or nearly so. Files are in
    order, which a merge join uses without a sort if ``spark.sql.legacy.bucketedTableScan.outputOrdering`` is set.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    with timestamp_statistics(df.sparkSession):
        writer.bucketBy(buckets, key).sortBy(key).saveAsTable(f"`{database}`.`{table}`")


def save_top_clients(
    transactions: DataFrame,
    database: str,
    path: str,
    year: int = YEAR,
    k: int = 10,
    table: str | None = None,
    **columns: str,
) -> str:
    """Store the biggest spenders of a year as a catalog table and return its name."""
    table = table or f"top{k}_clients_{year}"
    write_table(top_clients(transactions, year, k, **columns), database, table, path)
    return f"{database}.{table}"
