"""Parquet and CSV writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardmill.operators.enrich import enrich_left
from cardmill.operators.rows import split_rows
from cardmill.session import timestamp_statistics
from cardmill.sources.readers import read_json_map


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    replace_partitions: bool = False,
) -> None:
    """Write Parquet, optionally in partition folders.

    ``replace_partitions`` overwrites only the partitions that ``df`` contains, so a repeated run of an
    ingestion day leaves the same rows and does not touch other days.
    """
    writer = df.write.mode("overwrite" if replace_partitions else mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with timestamp_statistics(df.sparkSession):
        writer.parquet(path)


def convert_json_map(spark: SparkSession, source: str, target: str, whole_file: bool = True) -> None:
    """Rewrite JSON objects ``{key: value}`` as records ``{"id": key, "item": value}``."""
    read_json_map(spark, source, whole_file=whole_file).write.mode("overwrite").json(target)


def write_by_month(
    df: DataFrame,
    path: str,
    date_col: str = "transaction_date",
    subfolder: str = "bronze_transactions_by_month",
    with_year: bool = False,
) -> str:
    """Write one folder per calendar month below ``path/subfolder`` and return that path.

    Months of all years share a folder unless ``with_year`` is set. The rebalance hint collects each month into
    few files and lets AQE split a month over as many tasks as its size needs.
    """
    columns = {"month": F.month(date_col)}
    if with_year:
        columns = {"year": F.year(date_col), **columns}
    target = f"{path.rstrip('/')}/{subfolder}"
    rows = df.withColumns(columns).hint("rebalance", *columns)
    write_parquet(rows, target, partition_by=list(columns))
    return target


def write_n_files(df: DataFrame, path: str, n_files: int = 5) -> None:
    """Write a result as ``n_files`` Parquet files of equal size."""
    write_parquet(df.repartition(n_files), path)


def write_enriched(
    transactions: DataFrame,
    clients: DataFrame,
    fraud_info: DataFrame,
    path: str,
    client_key: str = "client_id",
    transaction_key: str = "transaction_id",
) -> None:
    """Write transactions with client and fraud columns."""
    write_parquet(enrich_left(transactions, clients, fraud_info, client_key, transaction_key), path)


def write_split_csv(
    df: DataFrame, path: str, parts: int = 4, order_by: Sequence[str | Column] = ()
) -> None:
    """Write balanced contiguous parts, each a folder ``part=n`` of CSV with headers."""
    rows = split_rows(df, parts, order_by)
    rows.write.mode("overwrite").partitionBy("part").option("header", True).csv(path)
