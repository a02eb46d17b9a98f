"""Global row positions without a global task."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardmill.session import materialize

STORED_LEAVES = {"FileSourceScanExec", "RangeExec", "LocalTableScanExec"}
REORDERS = re.compile(r"(?<!Broadcast)Exchange|Limit|TakeOrdered")


def replays_in_order(df: DataFrame) -> bool:
    """Whether a task of ``df`` that runs again sees the same rows in the same order.

    That holds for narrow work on stored files. Behind a shuffle, a limit, a cache or a database the order
    may change.
    """
    execution = df._jdf.queryExecution()
    if REORDERS.search(execution.executedPlan().toString()):
        return False
    leaves = execution.sparkPlan().collectLeaves()
    return {leaves.apply(i).getClass().getSimpleName() for i in range(leaves.size())} <= STORED_LEAVES


def _with_file_places(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows with the file and the place in it that they were read from; files are ordered by path."""
    if not replays_in_order(df):
        raise ValueError("rows that were shuffled have no input order; name the columns to order by")
    places = {"_file": "_metadata.file_path", "_block": "_metadata.file_block_start"}
    try:
        return df.select("*", *(F.col(c).alias(n) for n, c in places.items())), list(places)
    except AnalysisException as error:
        raise ValueError("the input order of several files is unknown here; name the columns to order by") from error


def _place(df: DataFrame, order_by: Sequence[str | Column]) -> tuple[DataFrame, DataFrame]:
    """Rows written in order with ``_task`` and ``_place``, and per task its number of rows and first position.

    Equal sort keys, even a third of all rows, are spread over tasks by the input position that ends the sort
    key. Input positions must not change when a lost task runs again, so an input that could come back in
    another order is written before it is sorted.
    """
    here = F.monotonically_increasing_id()
    rows, order_by = df, list(order_by)
    if not order_by and len(df.inputFiles()) > 1:
        # Spark hands out large files first, so the order of several files has to be asked for.
        rows, order_by = _with_file_places(df)
    if order_by:
        rows = rows.withColumn("_input", here)
        if not replays_in_order(df):
            rows = materialize(rows, "row-input")
        rows = rows.orderBy(*order_by, "_input").select(*[F.col(f"`{c}`") for c in df.columns])
    placed = materialize(rows.withColumns({"_task": F.spark_partition_id(), "_place": here}), "row-index")
    tasks = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    # One row per writing task, so this window and the broadcasts below stay small at any data size.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return placed, starts


def _number(placed: DataFrame, starts: DataFrame, index_col: str) -> DataFrame:
    shifts = starts.select("_task", (F.col("_start") - F.col("_first")).alias("_shift"))
    return (
        placed.join(F.broadcast(shifts), "_task")
        .withColumn(index_col, F.col("_place") + F.col("_shift"))
        .drop("_task", "_place", "_shift")
    )


def with_row_index(
    df: DataFrame, order_by: Sequence[str | Column] = (), index_col: str = "row_index"
) -> DataFrame:
    """Add the 0-based position of each row in the order given, or else in the input order.

    Rows are written once in order, with each row's task and place in it; what remains is to add up one count
    per task.
    """
    return _number(*_place(df, order_by), index_col)


def split_rows(
    df: DataFrame, parts: int = 4, order_by: Sequence[str | Column] = (), part_col: str = "part"
) -> DataFrame:
    """Number the rows 1..``parts`` in contiguous parts whose sizes differ by at most one.

    Without ``order_by`` the input order counts, several files by path; the first parts take the extra rows.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    placed, starts = _place(df, order_by)
    total = starts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    indexed = _number(placed, starts, "_index")
    size, extra = divmod(total, parts)
    long_rows = extra * (size + 1)
    in_long = F.expr(f"_index div {size + 1}L")
    in_short = extra + F.expr(f"(_index - {long_rows}L) div {max(size, 1)}L")
    part = F.when(F.col("_index") < long_rows, in_long).otherwise(in_short) + 1
    return indexed.withColumn(part_col, part.cast("int")).drop("_index")
