"""CSV, JSON, Parquet and SQL readers."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cardmill.operators.filters import preview
from cardmill.operators.sizing import repartition_by_size
from cardmill.schemas import narrow_keys, read_as
from cardmill.sources.listing import has_files

JSON_TARGET_MB = 40

logger = logging.getLogger(__name__)


def _structure(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None
) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, which reads the data twice.

    With a schema, columns that the file lacks and cells that do not parse are NULL; keys declared INT that do
    not fit are an error.
    """
    reader, paths = spark.read.option("header", True), path if isinstance(path, str) else list(path)
    if schema is None:
        return reader.option("inferSchema", True).csv(paths)
    schema = _structure(schema)
    return narrow_keys(reader.schema(read_as(schema)).csv(paths), schema)


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    multi_line: bool = True,
    target_mb: int = JSON_TARGET_MB,
) -> DataFrame:
    """JSON documents (one array or object per file) spread over partitions by the size of the input.

    A multi-line file is read by one task; give large data as many files or as JSON lines with
    ``multi_line=False``, which is splittable and needs no repartitioning.
    """
    schema = _structure(schema)
    reader = spark.read.schema(read_as(schema)).option("multiLine", multi_line)
    rows = narrow_keys(reader.json(path if isinstance(path, str) else list(path)), schema)
    return repartition_by_size(rows, path, target_mb) if multi_line else rows


def read_json_map(
    spark: SparkSession,
    path: str,
    key_col: str = "id",
    value_col: str = "item",
    whole_file: bool = True,
) -> DataFrame:
    """JSON objects ``{key: value}`` as rows ``key_col, value_col``.

    ``whole_file`` reads one object per file, otherwise one per line. Within an object the last of several
    equal keys wins.
    """
    text = spark.read.text(path, wholetext=whole_file)
    parsed = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    objects = text.select(F.monotonically_increasing_id().alias("_object"), parsed.alias("_map"))
    entries = objects.select("_object", F.posexplode("_map").alias("_at", key_col, value_col))
    return (
        entries.groupBy("_object", key_col)
        .agg(F.max_by(value_col, "_at").alias(value_col))
        .drop("_object")
    )


def partition_days(spark: SparkSession, path: str) -> dict[date, str]:
    """Ingestion day -> folder, for every ``year=/month=/day=`` folder below ``path``.

    Folder names are all that is needed, so no data file is opened.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/year=*/month=*/day=*")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    days = {}
    for folder in fs.globStatus(pattern) or []:
        name = folder.getPath().toString()
        values = re.search(r"year=(\d+)/month=(\d+)/day=(\d+)$", name)
        if values:
            days[date(*map(int, values.groups()))] = name
    return days


def latest_partition(spark: SparkSession, path: str) -> str:
    """Folder of the newest ingestion day that holds files, compared as dates."""
    for _, folder in sorted(partition_days(spark, path).items(), reverse=True):
        if has_files(spark, folder):
            return folder
    raise ValueError(f"no year/month/day partition with files below {path}")


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    latest_only: bool = False,
) -> DataFrame:
    """Parquet rows; ``latest_only`` reads just the folder of the newest ingestion day.

    A schema reads just its columns. The newest folder is read by itself, without its partition columns,
    so other days are not even listed.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(latest_partition(spark, path) if latest_only else path)


def read_sql(spark: SparkSession, query: str, show: int = 0) -> DataFrame:
    """Result of a SQL text over catalog tables and views; ``show`` rows are printed on request."""
    df = spark.sql(query)
    if show:
        preview(df, show).show()
    return df


def catalog_overview(spark: SparkSession) -> dict[str, object]:
    """Databases of the catalog and the warehouse folder."""
    overview = {
        "databases": [d.name for d in spark.catalog.listDatabases()],
        "warehouse": spark.conf.get("spark.sql.warehouse.dir"),
    }
    logger.info("catalog: %s", overview)
    return overview
