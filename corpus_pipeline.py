"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing and encoding of the documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardmill.llm.byte_bpe import round_trip
from cardmill.llm.common import table
from cardmill.llm.line_dedup import dedup_lines
from cardmill.llm.minhash_dedup import near_documents
from cardmill.llm.mixing import mixed_rows
from cardmill.llm.quality import quality_filter
from cardmill.session import materialize


def rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_filter(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document holds; n_chars follows the text."""
    out = dedup_lines(docs).drop("n_lines", "n_dropped")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id. Rows without an id are in no group.

    Documents of a similarity of 0.80 or more are near-duplicates here; op4_minhash_dedup has its own 0.85.
    """
    return near_documents(docs, percent=80).where(F.col("kept") | F.col("doc_id").isNull()).select(docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_rows(docs).select(docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each row, with digests of the ids and of the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = round_trip(docs, path, public_tokenizers.PATTERN, ids_col="ids")
    return out.select("doc_id", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", rule_stage),
    ("line_dedup", line_stage),
    ("minhash_dedup", near_stage),
    ("mix_sources", mix_stage),
    ("byte_bpe", encode_stage),
]
# Near-duplicate groups need a fixed point, which one SQL statement does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and reread; the last one's rows are the result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
