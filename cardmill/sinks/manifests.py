"""Versioned Parquet folders.

Data files are never changed. A manifest is one small Parquet folder a version that names the files that count, with
their number of rows, size and key range. A version can be read once its manifest is complete, so a reader sees the
old rows or the new ones and never half of a change; a writer that fails leaves files that no manifest names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cardmill.session import materialize, timestamp_statistics

DATA, MANIFESTS = "data", "_manifests"
FILE_COLUMNS = ("file", "n_rows", "n_bytes", "low", "high")


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system and path of a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the complete versions, oldest first."""
    fs, done = _folder(spark, f"{path.rstrip('/')}/{MANIFESTS}/v=*/_SUCCESS")
    names = [status.getPath().getParent().getName() for status in fs.globStatus(done) or []]
    return sorted(int(name.removeprefix("v=")) for name in names)


def latest_version(spark: SparkSession, path: str) -> int:
    """The newest version, 0 if there is none."""
    return max(versions(spark, path), default=0)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row a file of a version: ``file`` (below the data folder), ``n_rows``, ``n_bytes``, ``low``, ``high`` and more."""
    number = version or latest_version(spark, path)
    if not number:
        raise FileNotFoundError(f"no complete version in {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{MANIFESTS}/v={number}")


def publish(files: DataFrame, path: str, after: int) -> int:
    """Make ``files`` the version behind ``after`` and return its number.

    Of two writers that start from one version the second one fails: its manifest is there already. It has to
    start again from the newer version.
    """
    files.coalesce(1).write.mode("errorifexists").parquet(f"{path.rstrip('/')}/{MANIFESTS}/v={after + 1}")
    return after + 1


def write_files(df: DataFrame, path: str, key: Column, split_by: Sequence[str] = ()) -> DataFrame:
    """Write rows as new data files that no version names yet, and return their manifest rows.

    Files hold the partitions of ``df``; ``split_by`` keeps rows with different values apart, as folders, and these
    columns are not stored. ``low`` and ``high`` are the bounds of ``key``, which is read back by itself.
    """
    spark, target = df.sparkSession, f"{path.rstrip('/')}/{DATA}/{uuid.uuid4().hex[:12]}"
    writer = df.write.partitionBy(*split_by) if split_by else df.write
    with timestamp_statistics(spark):
        writer.parquet(target)
    stored = spark.read.schema(StructType([f for f in df.schema.fields if f.name not in split_by])).parquet(target)
    name = F.substring_index(F.col("_metadata.file_path"), f"/{DATA}/", -1)
    sizes = stored.groupBy(name.alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("_metadata.file_size").alias("n_bytes"),
        F.min(key).alias("low"),
        F.max(key).alias("high"),
    )
    return materialize(sizes, "manifest")


def append(df: DataFrame, path: str, key: Column) -> int:
    """Add ``df`` as new files, in the partitions it has, behind those of the newest version; returns the new one."""
    spark = df.sparkSession
    before = latest_version(spark, path)
    new = write_files(df, path, key)
    return publish(manifest(spark, path, before).unionByName(new) if before else new, path, before)


def read_files(
    spark: SparkSession, path: str, files: Sequence[str], schema: StructType | str | None = None
) -> DataFrame:
    """The rows of some files of a manifest; without any, ``schema`` says what the empty result looks like."""
    if not files:
        if schema is None:
            raise ValueError("no file and no schema")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    # Folders by which files were split are no columns.
    return reader.option("recursiveFileLookup", True).parquet(*[f"{path.rstrip('/')}/{DATA}/{name}" for name in files])


def file_names(files: DataFrame) -> list[str]:
    """The names in a manifest, as a scan needs them: one short text a file of some 128 MiB."""
    return [row["file"] for row in files.select("file").orderBy("file").toLocalIterator()]


def read_version(
    spark: SparkSession, path: str, schema: StructType | str | None = None, version: int | None = None
) -> DataFrame:
    """All rows of a version, the newest by default."""
    return read_files(spark, path, file_names(manifest(spark, path, version)), schema)


def drop_unnamed(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete older manifests than the newest ``keep`` and the data files that none of those names; returns the files.

    Readers of a version that is dropped lose its files, and files of a write that is under way look unnamed, so this
    is for times without either.
    """
    if keep < 1:
        raise ValueError("at least one version is kept")
    known = versions(spark, path)
    kept = {name for v in known[-keep:] for name in file_names(manifest(spark, path, v))}
    fs, data = _folder(spark, f"{path.rstrip('/')}/{DATA}")
    dropped = []
    for found in _parquet_files(fs, data):
        name = re.split(f"/{DATA}/", found.toString())[-1]
        if name not in kept:
            fs.delete(found, False)
            dropped.append(name)
    for v in known[:-keep]:
        fs.delete(_folder(spark, f"{path.rstrip('/')}/{MANIFESTS}/v={v}")[1], True)
    return sorted(dropped)


def _parquet_files(fs, folder) -> Iterator:
    if not fs.exists(folder):
        return
    entries = fs.listFiles(folder, True)
    while entries.hasNext():
        path = entries.next().getPath()
        if path.getName().endswith(".parquet"):
            yield path

