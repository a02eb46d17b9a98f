"""Source folders: route each file to a table and read it."""

from __future__ import annotations

import logging
import posixpath
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cardmill.schemas import table_schema
from cardmill.sources.listing import SourceFile, list_files
from cardmill.sources.readers import read_csv, read_json

logger = logging.getLogger(__name__)

# Numbered parts of one split file belong to one table.
PART_SUFFIX = re.compile(r"_part\d+$")


@dataclass(frozen=True)
class SourceTable:
    name: str
    extension: str
    paths: tuple[str, ...]


def route_files(
    files: list[SourceFile], extensions: tuple[str, ...] = (".csv", ".json")
) -> tuple[list[SourceTable], list[str]]:
    """Tables named by file, and the paths that no reader handles."""
    tables: dict[tuple[str, str], list[str]] = {}
    skipped = []
    for file in files:
        base, extension = posixpath.splitext(posixpath.basename(file.path))
        if extension in extensions:
            tables.setdefault((PART_SUFFIX.sub("", base), extension), []).append(file.path)
        else:
            skipped.append(file.path)
    names = [name for name, _ in tables]
    if len(set(names)) < len(names):
        raise ValueError(f"a table has files of two formats: {sorted(names)}")
    return [SourceTable(n, e, tuple(p)) for (n, e), p in sorted(tables.items())], skipped


def read_source(
    spark: SparkSession, table: SourceTable, schema: StructType | None, multi_line: bool = True
) -> DataFrame:
    """Rows of one routed table."""
    if table.extension == ".csv":
        return read_csv(spark, table.paths, schema)
    return read_json(spark, table.paths, schema, multi_line)


def ingest_directory(
    spark: SparkSession,
    folder: str,
    write: Callable[[DataFrame, str], None],
    schema_of: Callable[[str], StructType | None] = table_schema,
    extensions: tuple[str, ...] = (".csv", ".json"),
    datasets: bool = False,
    multi_line: bool = True,
) -> tuple[list[str], list[str]]:
    """Read every table of ``folder`` and hand it to ``write(rows, table)``.

    Returns the tables written and the paths skipped. The loop is over files; rows stay distributed.
    """
    tables, skipped = route_files(list_files(spark, folder, datasets), extensions)
    for path in skipped:
        logger.warning("no reader for %s", path)
    for table in tables:
        write(read_source(spark, table, schema_of(table.name), multi_line), table.name)
    return [t.name for t in tables], skipped
