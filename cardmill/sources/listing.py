"""Files of a folder."""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class SourceFile:
    path: str
    length: int


def has_files(spark: SparkSession, folder: str) -> bool:
    """Whether ``folder`` has a file that is not hidden; asks for entries one after the other and stops at the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return first_file(path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatusIterator(path))


def first_file(entries) -> bool:
    """Whether a listing has a visible file; reads no further than that."""
    while entries.hasNext():
        status = entries.next()
        if status.isFile() and not status.getPath().getName().startswith(("_", ".")):
            return True
    return False


def list_files(spark: SparkSession, folder: str, datasets: bool = False) -> list[SourceFile]:
    """Files directly in ``folder`` on any file system Spark can read; subfolders are ignored.

    ``datasets`` also lists folders that carry a file extension, the form in which Spark itself writes a
    large CSV or JSON file.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        dataset = datasets and status.isDirectory() and posixpath.splitext(name)[1] != ""
        if not name.startswith(("_", ".")) and (status.isFile() or dataset):
            found.append(SourceFile(status.getPath().toString(), int(status.getLen())))
    return sorted(found, key=lambda f: f.path)
