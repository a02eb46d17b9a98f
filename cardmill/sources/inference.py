"""Column types of CSV files from one scan, as a summary that can be merged with those of other files and days.

Types form a lattice: NULL below everything, ``boolean``, whole numbers below larger ones below ``double``, ``date`` below
``timestamp``, and ``string`` above all. Of a column it is enough to know for each type whether every value
parses as it; that is a minimum, so summaries of files merge by minima and the narrowest type that holds
everywhere wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Narrow types first; the first one that every value of a column parses as is its type.
LATTICE = ("boolean", "int", "bigint", "decimal(38,0)", "double", "date", "timestamp")
DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"
TIME = r"^\d{4}-\d{1,2}-\d{1,2}([ T].+)?$"


def _fits(text: Column, kind: str) -> Column:
    """Whether a text that is not NULL parses as a type."""
    if kind == "boolean":
        return F.lower(text).isin("true", "false")
    parsed = text.try_cast(kind).isNotNull()
    if kind.startswith(("int", "bigint", "decimal")):
        return text.rlike(r"^[+-]?\d+$") & parsed
    if kind in ("date", "timestamp"):
        return text.rlike(DAY if kind == "date" else TIME) & parsed
    return parsed


def read_text_columns(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV with a header, every column as text. Files whose header differs from the first one's are an error."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return reader.csv(path if isinstance(path, str) else list(path))


def type_summary(rows: DataFrame, by: Sequence[Column] = ()) -> DataFrame:
    """One row a column (and ``by``, say the file): ``column``, its ``place``, its number of values, and for each type whether all fit.

    One aggregation over one scan, with partial results of fixed size. A type fits a column without values.
    """
    every = []
    for name in rows.columns:
        text = F.col(f"`{name}`")
        fits = [F.coalesce(F.min(F.when(text.isNotNull(), _fits(text, kind))), F.lit(True)).alias(kind) for kind in LATTICE]
        every.append((name, F.struct(F.count(text).alias("n_values"), *fits)))
    summed = rows.groupBy(*by).agg(*[summary.alias(f"_{i}") for i, (_, summary) in enumerate(every)])
    entries = F.array(
        *[F.struct(F.lit(n).alias("column"), F.lit(i).alias("place"), F.col(f"_{i}").alias("s")) for i, (n, _) in enumerate(every)]
    )
    keys = [c for c in summed.columns if c not in {f"_{i}" for i in range(len(every))}]
    return summed.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.column", "e.place", "e.s.*")


def merge_summaries(summaries: DataFrame) -> DataFrame:
    """One row a column of summaries of several files or days, with its ``type``; a column without values is text."""
    fits = [F.min(f"`{kind}`").alias(kind) for kind in LATTICE]
    merged = summaries.groupBy("column").agg(F.min("place").alias("place"), F.sum("n_values").alias("n_values"), *fits)
    narrowest = F.coalesce(*[F.when(F.col(f"`{kind}`"), F.lit(kind)) for kind in LATTICE], F.lit("string"))
    kind = F.when(F.col("n_values") == 0, "string").otherwise(narrowest)
    return merged.select("column", "place", "n_values", kind.alias("type"))


def schema_of(merged: DataFrame) -> StructType:
    """The schema that merged summaries come to: one row a column."""
    columns = merged.orderBy("place", "column").collect()
    return StructType.fromDDL(", ".join(f"`{c['column']}` {c['type']}" for c in columns))


def infer_schema(spark: SparkSession, path: str | Sequence[str]) -> StructType:
    """The types of CSV files, from one scan over all of them."""
    return schema_of(merge_summaries(type_summary(read_text_columns(spark, path))))


def read_inferred(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """CSV rows in the types that fit all files, or in a given schema, such as one merged with earlier days.

    A value that does not parse as a given type becomes NULL; with inferred types there is none.
    """
    schema = schema or infer_schema(spark, path)
    rows = read_text_columns(spark, path)
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
