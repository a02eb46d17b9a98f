"""Partition counts from sizes, size-checked broadcasts and plan comparisons."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, NumericType, StringType

MIB = 1024 * 1024
BROADCAST_LIMIT = 256 * MIB

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Rows in a shuffle take more room than in compressed columns.
ROW_EXPANSION = 3
MOST_PARTITIONS = 50_000

logger = logging.getLogger(__name__)


def partitions_for(size_bytes: int, target_mb: int = 128) -> int:
    """Number of partitions of at most ``target_mb`` MiB, at least one."""
    if target_mb < 1:
        raise ValueError("target_mb must be at least 1")
    return max(1, -(-size_bytes // (target_mb * MIB)))


def partitions_for_column(size_bytes: str | Column, target_mb: int = 128) -> Column:
    """``partitions_for`` over a column of sizes."""
    size = F.col(size_bytes) if isinstance(size_bytes, str) else size_bytes
    count = F.ceil(size / F.lit(target_mb * MIB)).cast("int")
    return F.greatest(F.lit(1), F.coalesce(count, F.lit(1)))


def path_bytes(spark: SparkSession, path: str | Sequence[str]) -> int:
    """Bytes below files, directories or path patterns, on any file system Spark can read."""
    total = 0
    for one in [path] if isinstance(path, str) else path:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(one)
        fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = fs.globStatus(hadoop_path)
        if not found:
            raise FileNotFoundError(one)
        total += sum(int(fs.getContentSummary(status.getPath()).getLength()) for status in found)
    return total


def repartition_by_size(
    df: DataFrame, path: str | Sequence[str], target_mb: int = 128
) -> DataFrame:
    """Spread rows read from ``path`` over a partition count derived from its size."""
    return df.repartition(partitions_for(path_bytes(df.sparkSession, path), target_mb))


def size_shuffles(
    spark: SparkSession, input_bytes: int, target_mb: int = 256, most: int = MOST_PARTITIONS
) -> int:
    """Let shuffles start with enough partitions for an input of this size; AQE merges what stays small.

    The settings stay for the session. The number is only ever raised, up to ``most``, which bounds what the
    driver has to track; where that binds, partitions grow beyond ``target_mb`` and a warning says so. Skewed joins are
    split even if a following aggregation could have used their partitioning: one more shuffle of partial
    results costs less than a hot key in one task.
    """
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    current = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = partitions_for(input_bytes * ROW_EXPANSION, target_mb)
    if wanted > most:
        logger.warning("%d shuffle partitions wanted for %d MiB each, %d taken", wanted, target_mb, most)
        wanted = most
    if wanted > current:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    return max(wanted, current)


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def output_partitions(df: DataFrame, target_mb: int = 128, most: int = MOST_PARTITIONS) -> int:
    """Partitions for writing ``df``, by the size of the files that it reads.

    The optimizer's estimate of a join is a product that says nothing; it is used only for rows that come from no file.
    """
    files = df.inputFiles()
    size = path_bytes(df.sparkSession, files) if files else planned_bytes(df)
    return min(partitions_for(size, target_mb), most)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``, counted in one aggregate pass."""
    width = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + 8 + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, NumericType) or field.dataType.typeName() in (
            "date", "timestamp", "timestamp_ntz", "boolean",
        ):
            width = width + 16
        else:
            width = width + 8 + F.octet_length(F.to_json(F.struct(column)))
    return int(df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0])


def broadcast_room(spark: SparkSession) -> int:
    """Bytes that a broadcast may take: a sixteenth of the memory of the driver and of an executor."""
    context = spark.sparkContext
    driver = int(spark._jvm.java.lang.Runtime.getRuntime().maxMemory())
    executor = driver if context.master.startswith("local") else context._jsc.sc().executorMemory() * MIB
    return min(driver, executor) // 16


def broadcast_within(
    df: DataFrame, limit_bytes: int = BROADCAST_LIMIT, always_hint: bool = False
) -> DataFrame:
    """Hint a broadcast of ``df`` only when its size is known to stay within ``limit_bytes``.

    Below Spark's own threshold nothing is hinted, because the planner broadcasts by itself. Above the
    limit nothing is hinted either and the join shuffles, with AQE splitting skewed keys. In between the
    rows are measured, which reads no more than ``limit_bytes`` of files. The limit shrinks with the memory of
    the session.
    """
    limit_bytes = min(limit_bytes, broadcast_room(df.sparkSession))
    planned = planned_bytes(df)
    if planned > limit_bytes:
        return df
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if planned <= threshold and not always_hint:
        return df
    return F.broadcast(df) if measured_bytes(df) <= limit_bytes else df


def compare_variants(spark: SparkSession, variants: Mapping[str, DataFrame]) -> DataFrame:
    """Count each variant and report ``variant, n_rows, seconds``, one row per variant."""
    rows = []
    for name, df in variants.items():
        start = time.perf_counter()
        n_rows = df.count()
        rows.append((name, n_rows, time.perf_counter() - start))
    return spark.createDataFrame(rows, "variant string, n_rows bigint, seconds double")


def compare_cached(df: DataFrame) -> DataFrame:
    """``compare_variants`` of ``df`` uncached and cached; the cache is filled by the second count."""
    plain = compare_variants(df.sparkSession, {"no_cache": df})
    cached = df.persist()
    try:
        return plain.unionByName(compare_variants(df.sparkSession, {"cache": cached}))
    finally:
        cached.unpersist()
