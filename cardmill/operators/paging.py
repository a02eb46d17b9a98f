"""Deterministic pages of a table, and the reads served from the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    AtomicType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    FractionalType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from cardmill.operators.filters import by_label

PAGE, SIZE = 1, 20
# Pages that end within so many rows are cut from a top-k of as many rows a task. The rows are the same either way.
FIRST_ROWS = 1_000
# Candidates of a deep page that one more sort may take; more are narrowed by all columns first.
RANGE_ROWS = 1_000_000


def _sortable(kind: DataType) -> bool:
    return isinstance(kind, AtomicType)


def total_order(df: DataFrame, order_by: Sequence[str]) -> list[tuple[str, bool]]:
    """(column, descending) for the given order, ended by all other sortable columns.

    Rows that are still equal are copies of each other (but for maps and the like), so pages neither lose nor
    repeat any.
    """
    order = [(name.split()[0], name.lower().endswith(" desc")) for name in order_by]
    named = {name for name, _ in order}
    rest = [f.name for f in df.schema.fields if f.name not in named and _sortable(f.dataType)]
    return order + [(name, False) for name in rest]


def _rising(df: DataFrame, name: str, descending: bool) -> list[Column]:
    """Columns that rise where the order goes on: nulls first in a rising order, last in a falling one."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if not descending:
        return [column.isNotNull().alias(f"{name}_known"), column.alias(name)]
    if isinstance(kind, StringType):
        # Digits of the bytes turned round, and an end that follows every digit: a longer text comes first.
        digits = F.translate(F.hex(column), "0123456789ABCDEF", "FEDCBA9876543210")
        value = F.concat(digits, F.lit("G"))
    elif isinstance(kind, FractionalType):
        value = -column
    elif isinstance(kind, NumericType):
        value = -column.cast("decimal(20,0)") if kind.simpleString() != "decimal" else -column
    else:
        value = -F.unix_micros(column.cast("timestamp")) if kind.simpleString() != "boolean" else ~column
    return [column.isNull().alias(f"{name}_null"), value.alias(name)]


def _place(df: DataFrame, order: Sequence[tuple[str, bool]]) -> Column:
    return F.struct(*(c for name, down in order for c in _rising(df, name, down)))


def _narrow(df: DataFrame, order: Sequence[tuple[str, bool]], first: int, end: int) -> tuple[DataFrame, int, int]:
    """The rows of the key ranges that hold the positions ``first`` to ``end``, the rows before them, their number.

    Only the keys are shuffled, by sampled ranges, and each range is reduced to its number of rows, first and last
    key. The full rows are then read with a filter; nothing is written. The bounds of the first column are plain
    comparisons as well, which reach the scan and skip its row groups.
    """
    lead = F.col(f"`{order[0][0]}`")
    keys = df.select(_place(df, order).alias("place"), lead.alias("lead"))
    ranged = keys.repartitionByRange(F.col("place")).groupBy(F.spark_partition_id().alias("task"))
    ranges = ranged.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("place").alias("low"),
        F.max("place").alias("high"),
        F.min("lead").alias("least"),
        F.max("lead").alias("most"),
        F.count_if(F.col("lead").isNull()).alias("unknown"),
    )
    before = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = ranges.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    hit = starts.where((F.col("start") < end) & (F.col("start") + F.col("n") > first))
    found = hit.agg(
        F.min("start").alias("start"),
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.sum("unknown").alias("unknown"),
    )
    row = found.first()
    if row["n"] is None:
        return df.limit(0), 0, 0
    kind = keys.schema["place"].dataType
    edge_schema = StructType([StructField("low", kind), StructField("high", kind)])
    edges = df.sparkSession.createDataFrame([(row["low"], row["high"])], edge_schema)
    place = _place(df, order)
    low, high = edges.select("low").scalar(), edges.select("high").scalar()
    near = df
    if not isinstance(df.schema[order[0][0]].dataType, (BooleanType, DoubleType, FloatType)):
        near = df.where(_within(lead, row["least"], row["most"], row["unknown"] > 0))
    return near.where((place >= low) & (place <= high)), row["start"], row["n"]


def _within(column: Column, least: object, most: object, unknown: bool) -> Column:
    """Whether a value lies between two known ones, or is NULL where that may be."""
    if least is None:
        return column.isNull()
    known = (column >= F.lit(least)) & (column <= F.lit(most))
    return known | column.isNull() if unknown else known


def paginate(df: DataFrame, order_by: Sequence[str], page: int = PAGE, size: int = SIZE) -> DataFrame:
    """Page ``page`` of ``size`` rows in a mandatory order of columns, ``"name"`` or ``"name desc"``.

    Rows with equal keys are ordered by all other columns, so every row is on exactly one page. Deep pages find the
    key range that holds them by counting, narrow it by all columns where one key has very many rows, and sort
    that range only.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size must be at least 1")
    if not order_by:
        raise ValueError("a page needs an order")
    order = total_order(df, order_by)
    sort = [F.col(f"`{name}`").desc() if down else F.col(f"`{name}`").asc() for name, down in order]
    offset = (page - 1) * size
    if offset + size > FIRST_ROWS:
        df, before, n = _narrow(df, order[: len(order_by)], offset, offset + size)
        offset -= before if n else 0
        if n > RANGE_ROWS:
            df, before, n = _narrow(df, order, offset, offset + size)
            offset -= before if n else 0
    return df.orderBy(*sort).offset(offset).limit(size)


def keyset_page(df: DataFrame, key: str, after: object = None, size: int = SIZE) -> DataFrame:
    """The ``size`` rows whose unique ``key`` follows ``after``; equally cheap at any depth."""
    if size < 1:
        raise ValueError("size must be at least 1")
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(size)


def records(df: DataFrame, column: str = "record") -> DataFrame:
    """Rows as JSON objects, one per row; NULL is kept as ``null``."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(column))


def fraud_page(labels: DataFrame, page: int = PAGE, size: int = SIZE) -> DataFrame:
    """Page over the fraud labels."""
    return paginate(labels, ["id"], page, size)


def legit_page(processed: DataFrame, page: int = PAGE, size: int = SIZE) -> DataFrame:
    """Page over the validated transactions."""
    return paginate(by_label(processed, "Yes"), ["id"], page, size)


def client_page(users: DataFrame, page: int = PAGE, size: int = SIZE) -> DataFrame:
    """Page over the clients."""
    return paginate(users, ["id"], page, size)
