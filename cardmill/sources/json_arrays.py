"""One large JSON array read by many tasks.

A JSON document can be cut anywhere only if it is known, for every cut, whether it lies inside a string and how deep in
brackets. The text source cuts files into blocks and blocks at closing braces, which is cheap and blind; then

1. every piece is summed up: whether it holds an odd number of quotes, and how much deeper it ends, once for a start
   outside a string and once for a start inside;
2. these sums compose, so running sums over the pieces of a block and over the blocks of a file (one row a block)
   say where each piece begins;
3. a record ends where a closing brace leads back to the depth of the array. Pieces are put together by record
   inside their block; only the torn ends of blocks are put together across blocks.

Blocks of the text source are divided into runs of CHUNK pieces, which are what is called a block here. They are small
beside what a task is given, so a task's memory does not follow the size of a file or of its splits.

Only built-in expressions are used. The text is written once, summed up, and shuffled once, by block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from cardmill.operators.sizing import broadcast_within, partitions_for, path_bytes
from cardmill.schemas import narrow_keys, read_as
from cardmill.session import materialize

CUT = "}"
BLOCK = ("file", "split", "chunk")
CHUNK = 1 << 15
# Text that a task puts together. Its rows, with their file and place, take several times as much.
TASK_MB = 16


def _pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The text between closing braces, with its file, block and place in the block."""
    text = spark.read.option("lineSep", CUT).text(list(paths))
    # Rows of a split are read in order by one task.
    rows = text.select("*", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place"))
    return rows.select(
        F.col("file_path").alias("file"),
        F.col("file_block_start").alias("split"),
        F.expr(f"place div {CHUNK}").alias("chunk"),
        "place",
        "value",
    )


def _outside(parts: Column, inside_first: bool) -> Column:
    """The text between strings, of a text that was split at its quotes."""
    return F.array_join(F.filter(parts, lambda _, i: i % 2 == int(inside_first)), "")


def _depth(text: Column) -> Column:
    """Opened less closed brackets of a text without strings."""
    return F.length(F.translate(text, "}]", "")) - F.length(F.translate(text, "{[", ""))


def _summed(pieces: DataFrame) -> DataFrame:
    """For each piece whether it turns inside to outside, and the change of depth for either start.

    A brace that cut the text counts if the piece ends outside a string. A backslash never stands before a brace,
    since JSON knows no such escape, so that no escape is cut in two.
    """
    value = F.col("value")
    plain = F.when(F.contains(value, F.lit("\\")), F.regexp_replace(value, r"(?s)\\.", "")).otherwise(value)
    rows = pieces.withColumn("_parts", F.split(plain, '"', -1))
    parts = F.col("_parts")
    turns = (F.size(parts) - 1) % 2
    return rows.select(
        *pieces.columns,
        turns.alias("turns"),
        (_depth(_outside(parts, False)) - (1 - turns)).alias("from_outside"),
        (_depth(_outside(parts, True)) - turns).alias("from_inside"),
        F.regexp_extract("value", r"^[\s\uFEFF]*(.)", 1).alias("first"),
    )


def _before(*order: str, by: Sequence[str]) -> Window:
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _running(column: str | Column, window: Window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def _change(inside: Column) -> Column:
    return F.when(inside % 2 == 1, F.col("from_inside")).otherwise(F.col("from_outside"))


def _block_starts(summed: DataFrame, tasks: int) -> DataFrame:
    """One row a block: whether it starts inside a string, and its depth; and what the file comes to in the end."""
    narrow = summed.drop("value").repartition(tasks, *BLOCK)
    inside = _running("turns", _before("place", by=BLOCK))
    blocks = (
        narrow.withColumn("_inside", inside)
        .groupBy(*BLOCK)
        .agg(
            (F.sum("turns") % 2).alias("turns"),
            F.sum(_change(F.col("_inside"))).alias("from_outside"),
            F.sum(_change(F.col("_inside") + 1)).alias("from_inside"),
            F.min_by("first", "place").alias("first"),
        )
    )
    whole = Window.partitionBy("file")
    before = _before(*BLOCK[1:], by=["file"])
    blocks = blocks.withColumn("inside", _running("turns", before) % 2)
    blocks = blocks.withColumn("change", _change(F.col("inside")))
    base = (F.first("first").over(whole.orderBy(*BLOCK[1:])) == "[").cast("int")
    return blocks.select(
        *BLOCK,
        "inside",
        _running("change", before).alias("depth"),
        base.alias("base"),
        (F.row_number().over(whole.orderBy(*BLOCK[1:])) == 1).alias("leads"),
        F.sum("change").over(whole).alias("end_depth"),
        (F.sum("turns").over(whole) % 2).alias("end_inside"),
    )


def _torn(starts: DataFrame) -> list[str]:
    """Files that end inside a string or a bracket. A last piece without a brace makes the depth one too small."""
    bad = (F.col("end_inside") != 0) | ~F.col("end_depth").isin(0, -1)
    return [row["file"] for row in starts.where(bad).select("file").distinct().orderBy("file").limit(10).collect()]


def json_array_texts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The records of JSON arrays of objects as texts, one row ``value`` a record; any number of files.

    A file holds one array of objects, or objects one behind the other. Blocks lie in the splits of the text source
    (``spark.sql.files.maxPartitionBytes``), so a file of any size is read by many tasks; a record may span
    blocks. A file that ends inside a record, or holds anything but objects, is an error. Empty files and arrays
    have no records.
    """
    paths = [path] if isinstance(path, str) else list(path)
    tasks = max(spark.sparkContext.defaultParallelism, partitions_for(path_bytes(spark, paths), TASK_MB))
    # Written, so that splits and places are the same below, whatever executors there are by then.
    summed = materialize(_summed(_pieces(spark, paths)), "json-pieces")
    starts = materialize(_block_starts(summed, tasks), "json-blocks")
    if torn := _torn(starts):
        raise ValueError(f"JSON that is not closed in {torn}")
    rows = summed.drop("first").repartition(tasks, *BLOCK)
    rows = rows.join(broadcast_within(starts.drop("end_depth", "end_inside")), list(BLOCK))
    before = _before("place", by=BLOCK)
    rows = rows.withColumn("_inside", (F.col("inside") + _running("turns", before)) % 2)
    rows = rows.withColumn("_change", _change(F.col("_inside")))
    rows = rows.withColumn("_depth", F.col("depth") + _running("_change", before))
    ends = (F.col("_depth") + F.col("_change") == F.col("base")) & ((F.col("_inside") + F.col("turns")) % 2 == 0)
    rows = rows.withColumn("_ends", ends.cast("int"))
    rows = rows.withColumn("record", _running("_ends", before))
    # Still dealt out by block: no further shuffle.
    found = rows.groupBy(*BLOCK, "record").agg(
        F.array_sort(F.collect_list(F.struct("place", "value"))).alias("pieces"),
        F.max("_ends").alias("ends"),
        F.min_by(F.struct("_inside", "_depth", "base", "leads"), "place").alias("start"),
    )
    text = F.concat(F.array_join(F.col("pieces.value"), CUT), F.lit(CUT))
    fresh = (F.col("start._inside") == 0) & (F.col("start._depth") == F.col("start.base"))
    # In the first block the opening bracket is still to come.
    fresh = fresh | (F.col("start.leads") & (F.col("record") == 0))
    found = found.select(*BLOCK, "record", text.alias("value"), (F.col("ends") == 1).alias("ends"), fresh.alias("fresh"))
    whole = found.where("ends AND fresh").select("value")
    # At most two pieces a block are torn.
    torn = found.where("NOT (ends AND fresh)")
    number = _running(F.col("ends").cast("int"), _before(*BLOCK[1:], "record", by=["file"]))
    joined = torn.withColumn("number", number).groupBy("file", "number")
    ordered = F.array_sort(F.collect_list(F.struct(*BLOCK[1:], "record", "value")))["value"]
    joined = joined.agg(F.array_join(ordered, "").alias("value"))
    texts = whole.unionByName(joined.select("value"))
    # What stands before a record, and what is left behind the last one with the brace that was added to it.
    record = F.regexp_replace("value", r"^[\s\uFEFF]*[\[,]?\s*", "")
    rest = F.col("value").rlike(r"^[\s\uFEFF]*\[?\s*\]?\s*\}$")
    wrong = F.raise_error(F.concat(F.lit("not an object in a JSON array: "), F.substring(record, 1, 80)))
    found = F.when(rest, F.lit(None)).when(record.startswith("{"), record).otherwise(wrong)
    return texts.select(found.alias("value")).where(F.col("value").isNotNull())


def read_json_array(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """JSON arrays of records, each file read by many tasks; the rows that a multi-line read gives.

    Fields that a record lacks or that do not parse are NULL; keys declared INT that do not fit are an error.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = F.from_json("value", read_as(schema), dict(options or {}))
    return narrow_keys(json_array_texts(spark, path).select(parsed.alias("_row")).select("_row.*"), schema)
