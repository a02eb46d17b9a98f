"""What several operators share: column hygiene, fixed patterns and shipping of the package to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RESERVED = "_llm_"
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(df: DataFrame, *outputs: str) -> DataFrame:
    """``df`` without columns that an operator is about to add; names that start with ``_llm_`` are reserved too."""
    taken = {x.lower() for x in outputs}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken and not c.startswith(RESERVED)])


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words_of(text: Column) -> Column:
    """The array of words of a text; empty for null or blank text."""
    body = strip(text)
    return F.when(F.length(body) > 0, F.split(body, SPACE_CLASS + "+")).otherwise(F.array().cast("array<string>"))


def count_words(text: Column) -> Column:
    """Number of words of a text, 0 for null. One character a word is left to count, not an array of all words."""
    marks = F.regexp_replace(strip(text), f"{WORD_CLASS}+{SPACE_CLASS}*", "w")
    return F.coalesce(F.length(marks), F.lit(0)).cast("bigint")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` refers to it, lambdas included."""
    return F.get(F.transform(F.array(value), use), 0)


def bounded_batches(spark: SparkSession) -> None:
    """Let Python workers take few rows at a time, since one text may be very long. Stays set for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers once per application, so that jobs need no installed copy."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        path = os.path.join(tempfile.mkdtemp(prefix="cardmill-llm-"), "cardmill_llm.zip")
        with zipfile.ZipFile(path, "w") as out:
            for top, _, names in os.walk(os.path.join(root, "cardmill")):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(top, name)
                        out.write(full, os.path.relpath(full, root))
        context.addPyFile(path)
        _shipped.add(context.applicationId)
    bounded_batches(spark)
    return spark
