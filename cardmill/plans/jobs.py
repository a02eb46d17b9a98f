"""The layer runs: files -> relational landing -> bronze -> silver -> marts.

Relational reads and writes are passed in as functions (see ``jdbc_reader`` and ``jdbc_writer``), so the same runs
work over any store that holds named tables. Errors are raised, never swallowed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cardmill.operators.cleaning import (
    clean_cards,
    clean_transactions,
    clean_users,
    stamp_ingestion,
    stamp_ingestion_partition,
)
from cardmill.operators.enrich import add_labels, enrich_transactions, labels_in_range
from cardmill.operators.sizing import measured_bytes, partitions_for, path_bytes, size_shuffles
from cardmill.plans.marts import KPI_MART, TOP_MART, marts, top_consumers, top_of_kpis
from cardmill.schemas import PARTITION_COLUMNS, table_schema
from cardmill.session import JobPaths, drop_copies, materialize
from cardmill.sinks.files import write_parquet
from cardmill.sinks.tables import create_database, write_bucketed, write_table
from cardmill.sources.files import ingest_directory
from cardmill.sources.jdbc import JdbcTarget, read_jdbc, write_jdbc
from cardmill.sources.readers import read_parquet

# Jobs submitted at a time where they do not depend on each other.
PARALLEL = 4

TableReader = Callable[[SparkSession, str], DataFrame]
TableWriter = Callable[[DataFrame, str], None]


# The numeric keys by which the source tables can be read in parts; other tables have none.
NUMERIC_KEYS = {
    "train_fraud_labels": "id",
    "users_data": "id",
    "transactions_data": "id",
    "cards_data": "id",
    "transaction_validated": "id",
    "transaction_refused": "id",
    "transactions_data_processed": "id",
}


def jdbc_reader(
    target: JdbcTarget, partition_columns: Mapping[str, str] = NUMERIC_KEYS, partitions: int = 8
) -> TableReader:
    """Reads named tables over JDBC, by several tasks where ``partition_columns`` names a numeric column."""
    return lambda spark, table: read_jdbc(spark, target, table, partition_columns.get(table), partitions)


def jdbc_writer(target: JdbcTarget, mode: str = "overwrite", connections: int = 16) -> TableWriter:
    """Writes named tables over JDBC."""
    return lambda df, table: write_jdbc(df, target, table, mode, connections)


def run_together(tasks: Iterable[Callable[[], None]], parallel: int = PARALLEL) -> None:
    """Run independent jobs side by side, so that a short one does not wait for a long one."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for done in [pool.submit(task) for task in tasks]:
            done.result()


def load_files(
    spark: SparkSession,
    folder: str,
    write: TableWriter,
    datasets: bool = False,
    schema_of: Callable[[str], StructType] | None = table_schema,
) -> tuple[list[str], list[str]]:
    """Files -> relational tables; CSV only, other files are reported.

    With ``schema_of=None`` the types are inferred, which reads the files twice.
    """
    return ingest_directory(spark, folder, write, schema_of or (lambda _: None), (".csv",), datasets)


def bronze_from_tables(
    spark: SparkSession,
    read: TableReader,
    paths: JobPaths,
    tables: Iterable[str] = ("transactions_data",),
    as_of: date | None = None,
    append: bool = False,
    max_files: int | None = None,
) -> None:
    """Relational tables -> Parquet partitioned by ingestion day.

    A repeated run of the same day replaces that day; ``append`` adds to it instead. ``max_files`` bounds the
    number of files, without a shuffle, where the reader has more partitions than that.
    """
    for table in tables:
        rows = stamp_ingestion_partition(read(spark, table), as_of)
        if max_files:
            rows = rows.coalesce(max_files)
        write_parquet(
            rows, paths.raw_table(table), "append", PARTITION_COLUMNS, replace_partitions=not append
        )


def bronze_from_files(
    spark: SparkSession,
    paths: JobPaths,
    as_of: date | None = None,
    schema_of: Callable[[str], StructType] = table_schema,
    datasets: bool = False,
    multi_line: bool = True,
) -> tuple[list[str], list[str]]:
    """CSV and JSON files -> Parquet with the ingestion date, one folder per table."""

    def write(rows: DataFrame, table: str) -> None:
        write_parquet(stamp_ingestion(rows, as_of), paths.raw_table(table))

    return ingest_directory(
        spark, paths.source, write, schema_of, datasets=datasets, multi_line=multi_line
    )


def silver_table(
    spark: SparkSession,
    paths: JobPaths,
    table: str,
    transformation: Callable[[DataFrame], DataFrame],
    suffix: str = "_cleaned",
    latest_only: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Bronze table -> transformation -> catalog table, in partition folders on request."""
    rows = transformation(read_parquet(spark, paths.raw_table(table), latest_only=latest_only))
    name = f"{table}{suffix}"
    write_table(rows, paths.database, name, paths.warehouse_table(name), partition_by)


def silver_copy(spark: SparkSession, paths: JobPaths, table: str) -> None:
    """Bronze table -> catalog table with the declared columns only, read as they are stored."""
    stored = read_parquet(spark, paths.raw_table(table))
    rows = stored.select(*table_schema(table).names)
    write_table(rows, paths.database, table, paths.warehouse_table(table))


def run_silver(
    spark: SparkSession, paths: JobPaths, mcc_key: str = "mcc", parallel: int = PARALLEL
) -> None:
    """Three cleaned tables, the processed table (by label, which the two label marts prune) and two copies."""
    size_shuffles(spark, path_bytes(spark, paths.raw_table("transactions_data")))
    create_database(spark, paths.database, paths.warehouse)

    def process(transactions: DataFrame) -> DataFrame:
        labels = read_parquet(spark, paths.raw_table("train_fraud_labels"))
        return enrich_transactions(
            clean_transactions(transactions, text_keys=False, exact=True),
            mcc=read_parquet(spark, paths.raw_table("mcc_codes")),
            users=read_parquet(spark, paths.raw_table("users_data")),
            cards=read_parquet(spark, paths.raw_table("cards_data")),
            labels=labels_in_range(labels, transactions),
            mcc_key=mcc_key,
        )

    table, copy = partial(silver_table, spark, paths), partial(silver_copy, spark, paths)
    run_together(
        [
            partial(table, "transactions_data", process, "_processed", latest_only=True, partition_by=["info"]),
            partial(table, "transactions_data", clean_transactions, latest_only=True),
            partial(table, "cards_data", clean_cards),
            partial(table, "users_data", clean_users),
            partial(copy, "mcc_codes"),
            partial(copy, "train_fraud_labels"),
        ],
        parallel,
    )


def bucket_count(spark: SparkSession, path: str, target_mb: int = 256) -> int:
    """Buckets for a table of the size of ``path``: a power of two, so that tables of two sizes can be made to agree.

    Sizes of compressed files say little of the rows that a task sorts; see ``row_bucket_count``.
    """
    return _power_of_two(partitions_for(path_bytes(spark, path), target_mb))


def row_bucket_count(tables: Iterable[DataFrame], target_mb: int = 256) -> int:
    """Buckets for tables that are joined: one of each holds rows of ``target_mb`` at most, as a task sorts them."""
    return _power_of_two(partitions_for(sum(map(measured_bytes, tables)), target_mb))


def _power_of_two(count: int) -> int:
    """The least power of two from ``count`` on."""
    return 1 << (count - 1).bit_length()


def silver_buckets(
    spark: SparkSession,
    paths: JobPaths,
    buckets: int | None = None,
    tables: Sequence[str] = ("transactions_data", "train_fraud_labels"),
) -> list[str]:
    """Bronze tables -> catalog tables in buckets by ``id``, as many as their rows need; returns their names.

    Labels are the history that every run joins; in buckets they are shuffled when they change and not in each run.
    """
    create_database(spark, paths.database, paths.warehouse)

    def read(table: str) -> DataFrame:
        rows = read_parquet(spark, paths.raw_table(table), latest_only=table == "transactions_data")
        return clean_transactions(rows) if table == "transactions_data" else rows.select(*table_schema(table).names)

    rows = {table: read(table) for table in tables}
    count = buckets or row_bucket_count(rows.values())

    def write(table: str) -> None:
        name = f"{table}_buckets"
        write_bucketed(rows[table], paths.database, name, paths.warehouse_table(name), "id", count)

    run_together([partial(write, table) for table in tables])
    return [f"{table}_buckets" for table in tables]


def labelled_from_buckets(spark: SparkSession, database: str) -> DataFrame:
    """Cleaned transactions with their labels, joined bucket by bucket."""
    transactions, labels = (spark.table(f"`{database}`.`{t}_buckets`") for t in ("transactions_data", "train_fraud_labels"))
    return add_labels(transactions, labels)


def run_marts(
    spark: SparkSession,
    write: TableWriter,
    database: str = "process_data",
    catalogue: Mapping[str, Callable[[SparkSession], DataFrame]] | None = None,
    parallel: int = PARALLEL,
) -> list[str]:
    """Compute every mart and hand it to ``write(rows, name)``; returns the names.

    The two aggregated marts of the standard catalogue share one scan: the top list comes from the KPIs, which are
    written to the shared folder once and dropped at the end.
    """
    catalogue = dict(marts(database) if catalogue is None else catalogue)
    names, copies = list(catalogue), []
    if {KPI_MART, TOP_MART} <= set(names) and _standard(catalogue[TOP_MART]):
        kpis = materialize(catalogue[KPI_MART](spark), "kpis")
        copies.append(kpis)
        catalogue |= {KPI_MART: lambda _: kpis, TOP_MART: lambda _: top_of_kpis(kpis)}
    run_together(
        [lambda name=name, query=query: write(query(spark), name) for name, query in catalogue.items()],
        parallel,
    )
    drop_copies(*copies)
    return names


def _standard(mart: Callable) -> bool:
    return isinstance(mart, partial) and mart.keywords.get("query") is top_consumers


def run_all(
    spark: SparkSession,
    paths: JobPaths,
    landing_folder: str,
    read_landing: TableReader,
    write_landing: TableWriter,
    write_mart: TableWriter,
    as_of: date | None = None,
    schema_of: Callable[[str], StructType] = table_schema,
    datasets: bool = False,
    multi_line: bool = True,
) -> list[str]:
    """The whole run: landing files to tables, tables and files to bronze, silver, marts."""
    landed, _ = load_files(spark, landing_folder, write_landing, datasets, schema_of)
    bronze_from_tables(spark, read_landing, paths, landed, as_of)
    bronze_from_files(spark, paths, as_of, schema_of, datasets, multi_line)
    run_silver(spark, paths)
    return run_marts(spark, write_mart, paths.database)
