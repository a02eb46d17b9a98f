"""Session bootstrap, job paths and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Timestamps stored as microseconds carry row-group statistics, the default type does not.
TIMESTAMP_TYPE = ("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")

SESSION_CONF = {
    TIMESTAMP_TYPE[0]: TIMESTAMP_TYPE[1],
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


@dataclass(frozen=True)
class JobPaths:
    """Where a run reads its files and keeps its layers."""

    source: str
    raw: str
    warehouse: str
    database: str = "process_data"

    def raw_table(self, name: str) -> str:
        return f"{self.raw.rstrip('/')}/{name}"

    def warehouse_table(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"


def get_session(
    app_name: str,
    master: str | None = None,
    hive: bool = False,
    conf: dict[str, str] | None = None,
    log_level: str = "ERROR",
) -> SparkSession:
    """A session with UTC time, AQE and, on request, the Hive catalog."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


_open_blocks: dict[int, tuple[int, str]] = {}
_open_blocks_lock = threading.Lock()


@contextmanager
def timestamp_statistics(spark: SparkSession) -> Iterator[None]:
    """Let Parquet writes inside the block keep statistics of timestamps, in any session.

    Blocks of several threads may overlap: the first one sets the option and the last one restores it.
    """
    key, value = TIMESTAMP_TYPE
    session = spark._jsparkSession.hashCode()
    with _open_blocks_lock:
        count, before = _open_blocks.get(session, (0, None))
        if not count:
            before = spark.conf.get(key)
            spark.conf.set(key, value)
        _open_blocks[session] = count + 1, before
    try:
        yield
    finally:
        with _open_blocks_lock:
            count, before = _open_blocks.pop(session)
            if count > 1:
                _open_blocks[session] = count - 1, before
            else:
                spark.conf.set(key, before)


def scratch_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where it is shared by definition.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_base(spark.sparkContext.applicationId)


@cache
def _local_base(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"cardmill-{application}-")


def _application_scratch(spark: SparkSession) -> str:
    return f"{scratch_base(spark)}/cardmill/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{_application_scratch(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete what this application wrote below the shared folder; results read from there are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_scratch(spark))
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


def drop_copies(*copies: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these frames, once nothing reads them any more."""
    for copy in copies:
        spark = copy.sparkSession
        for folder in {name.rpartition("/")[0] for name in copy.inputFiles()}:
            if f"/cardmill/{spark.sparkContext.applicationId}/" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared folder and reading it back.

    The copy survives lost executors and, unlike a row checkpoint, keeps column pruning.
    """
    path = scratch_path(df.sparkSession, label)
    with timestamp_statistics(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
