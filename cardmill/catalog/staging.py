"""Source files made from the given tables, for the queries that read or ingest files.

Everything is written by distributed Spark jobs below the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cardmill.operators.cleaning import TIMESTAMP_FORMAT

ROWS_PER_DOCUMENT = 20_000
# Some blocks of the text source.
ROWS_PER_ARRAY = 1_000_000


def write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).option("timestampFormat", TIMESTAMP_FORMAT).csv(path)
    return path


def _documents(df: DataFrame, element: str, start: str, end: str) -> DataFrame:
    """One JSON text per document; a document holds a bounded run of neighbouring input rows."""
    document = F.expr(f"monotonically_increasing_id() div {ROWS_PER_DOCUMENT}").alias("document")
    members = F.array_join(F.collect_list(element), ",")
    return (
        df.select(document, element)
        .groupBy("document")
        .agg(F.concat(F.lit(start), members, F.lit(end)).alias("value"))
    )


def write_json_arrays(df: DataFrame, path: str) -> str:
    """JSON arrays of records, one per file. Returns the path pattern of the files."""
    elements = df.select(F.to_json(F.struct("*")).alias("element"))
    _documents(elements, "element", "[", "]").write.partitionBy("document").text(path)
    return f"{path}/document=*"


def write_json_objects(df: DataFrame, path: str, key: str, value: str) -> str:
    """JSON objects ``{key: value}``, one per line."""
    pair = F.to_json(F.create_map(F.col(key), F.col(value)))
    elements = df.select(F.substring(pair, F.lit(2), F.length(pair) - 2).alias("element"))
    _documents(elements, "element", "{", "}").select("value").write.text(path)
    return path


def write_json_array_files(df: DataFrame, path: str, key: str, rows_per_file: int = ROWS_PER_ARRAY) -> str:
    """All rows as JSON arrays, each a file of about ``rows_per_file`` records. Returns the path pattern of the files.

    Records are dealt out by ``key`` and written as they come, so that a task neither sorts nor keeps them.
    """
    files = max(1, -(-df.count() // rows_per_file))
    records = df.select(key, F.to_json(F.struct("*")).alias("value")).repartition(files, key)

    def as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            if batch.num_rows:
                marks = pa.array([before] + [","] * (batch.num_rows - 1), batch.column(0).type)
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, batch.column(0), "")], ["value"])
                before = ","
        yield pa.RecordBatch.from_pydict({"value": ["[", "]"] if before == "[" else ["]"]})

    records.select("value").mapInArrow(as_array, "value string").write.text(path)
    return f"{path}/part-*"
