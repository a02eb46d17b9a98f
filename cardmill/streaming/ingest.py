"""Incremental bronze ingestion: every source file is taken over exactly once."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from cardmill.operators.cleaning import stamp_ingestion_partition
from cardmill.schemas import PARTITION_COLUMNS
from cardmill.session import timestamp_statistics


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    as_of: date | None = None,
    max_files_per_batch: int = 1000,
) -> None:
    """Add the CSV files that appeared in ``folder`` since the last run to ``target``, then stop.

    The checkpoint remembers which files are done, so a repeated or restarted run adds nothing twice. Read
    ``target`` as a whole: its log lists the files of completed batches.
    """
    new_rows = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .csv(folder)
    )
    stream = (
        stamp_ingestion_partition(new_rows, as_of)
        .writeStream.partitionBy(*PARTITION_COLUMNS)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
    )
    with timestamp_statistics(spark):
        stream.start(target).awaitTermination()
