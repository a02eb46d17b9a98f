"""Rows that do not parse, kept beside those that do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StringType, StructField, StructType, TimestampType

from cardmill.operators.cleaning import TIMESTAMP_FORMAT
from cardmill.session import scratch_path, timestamp_statistics

RAW = "_raw"
REJECT = "struct<column: string, text: string, reason: string>"


def _parsed(text: Column, kind: DataType) -> Column:
    if isinstance(kind, TimestampType):
        return F.coalesce(F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)), text.try_cast(kind))
    return text.try_cast(kind)


def _reason(text: Column, kind: DataType) -> Column:
    """Why a text is no value of a type."""
    if isinstance(kind, IntegralType):
        return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), "out of range").otherwise("not a whole number")
    if isinstance(kind, (DateType, TimestampType)):
        return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), "no such day or time").otherwise("not a date")
    return F.lit(f"not {kind.simpleString()}")


def split_rejects(rows: DataFrame, schema: StructType) -> DataFrame:
    """Text columns in the types of ``schema``, with ``_raw`` and ``_rejects``: each cell that did not parse, and why.

    ``rows`` has the columns of ``schema`` as text and ``_raw``, which is the line where its number of cells is wrong
    and NULL elsewhere. One projection, so nothing is read twice.
    """
    def reject(column: Column, text: Column, reason: Column) -> Column:
        return F.struct(column.alias("column"), text.alias("text"), reason.alias("reason")).cast(REJECT)

    cells = []
    for field in schema.fields:
        name, text = F.lit(field.name), F.col(f"`{field.name}`")
        if not isinstance(field.dataType, StringType):
            unread = text.isNotNull() & _parsed(text, field.dataType).isNull()
            cells.append(F.when(unread, reject(name, text, _reason(text, field.dataType))))
        if not field.nullable:
            cells.append(F.when(text.isNull(), reject(name, text, F.lit("missing"))))
    wrong = F.array_compact(F.array(*cells)) if cells else F.array()
    torn = F.array(reject(F.lit(None), F.col(RAW), F.lit("wrong number of cells")))
    kind = f"array<{REJECT}>"
    rejects = F.when(F.col(RAW).isNotNull(), torn.cast(kind)).otherwise(wrong.cast(kind))
    typed = [_parsed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields]
    return rows.select(*typed, F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]).alias("_cells"), rejects.alias("_rejects"))


def ingest_with_rejects(
    spark: SparkSession, path: str | Sequence[str], schema: StructType, target: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """CSV with a header -> accepted rows in ``schema``, and rejected ones with all their cells as text and the reasons.

    The files are scanned once: accepted and rejected rows are written by the same job, to two folders below
    ``target`` (by default in the shared scratch folder). Every line is in exactly one of them. A rejected row keeps
    its cells as a JSON object in ``record`` and has one entry of ``rejects`` for each cell that did not parse: column,
    text and reason. A line with too many or too few cells has one entry with the whole line. NULL is accepted
    where the schema allows it; keys that do not fit their type are rejected, never cut.
    """
    target = (target or scratch_path(spark, "ingest")).rstrip("/")
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields]).add(RAW, StringType())
    reader = spark.read.schema(texts).option("header", True).option("columnNameOfCorruptRecord", RAW)
    rows = split_rejects(reader.csv(path if isinstance(path, str) else list(path)), schema)
    accepted = F.size("_rejects") == 0
    rows = rows.select(
        *[F.col(f"`{f.name}`") for f in schema.fields],
        F.when(~accepted, F.to_json("_cells", {"ignoreNullFields": "false"})).alias("_record"),
        F.when(~accepted, F.col("_rejects")).alias("_rejects"),
        accepted.alias("_accepted"),
    )
    with timestamp_statistics(spark):
        rows.write.mode("overwrite").partitionBy("_accepted").parquet(target)
    stored = spark.read.schema(rows.schema).parquet(target)
    good = stored.where("_accepted").select(*[F.col(f"`{f.name}`") for f in schema.fields])
    bad = stored.where("NOT _accepted").select(F.col("_record").alias("record"), F.col("_rejects").alias("rejects"))
    return good, bad
