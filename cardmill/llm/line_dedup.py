"""Operator 1, line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardmill.llm.common import ascii_lower, free, let, strip
from cardmill.session import materialize

ADDED = ("n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(strip(line))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, max_docs: int = 1
) -> DataFrame:
    """Drop lines whose key is in more than ``max_docs`` documents, except in the smallest id that holds it.

    Returns ``docs`` with the text rewritten and ``n_lines`` (before) and ``n_dropped`` added; input columns of
    these names are replaced.

    * Null or empty text is one empty line and becomes the empty text; an empty table gives an empty table.
    * Keys shorter than ``min_chars`` code points always stay. Inside the keeping document repeats stay too.
    * Rows with a null id neither count as a document nor lose lines. Rows with equal ids are one document when
      documents are counted, and each of them is reassembled from its own text; repeated rows come out repeated.

    Counting is pre-aggregated by (key, document) and then by key, so a line that every document holds is one
    row a task. The shared keys are written before they are joined back to line positions: an aggregate that feeds the
    join directly would keep AQE from splitting the partition of such a line.
    """
    docs = free(docs, *ADDED)
    doc, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    same_text = F.xxhash64(F.coalesce(text, F.lit("")))
    exploded = docs.where(doc.isNotNull()).select(
        doc.alias("_llm_doc"), same_text.alias("_llm_row"), F.posexplode(_lines(text)).alias("_llm_pos", "_llm_line")
    )
    key = line_key(F.col("_llm_line"))
    lines = exploded.where(F.length(key) >= min_chars).select(
        "_llm_doc", "_llm_row", "_llm_pos", F.unhex(F.md5(key)).alias("_llm_key")
    )
    shared = (
        lines.groupBy("_llm_key")
        .agg(F.count_distinct("_llm_doc").alias("_llm_docs"), F.min("_llm_doc").alias("_llm_first"))
        .where(F.col("_llm_docs") > max_docs)
        .select("_llm_key", "_llm_first")
    )
    shared = materialize(shared, "shared-lines")
    drops = (
        lines.join(shared, "_llm_key")
        .where(F.col("_llm_doc") != F.col("_llm_first"))
        .groupBy("_llm_doc", "_llm_row")
        .agg(F.collect_set("_llm_pos").alias("_llm_drop"))
    )
    parts = _lines(text)
    last = F.size(parts) - 1
    # Positions that stay, in order: a hash lookup for each, so long documents cost no more for each line.
    stay = F.array_except(F.sequence(F.lit(0), last), F.col("_llm_drop"))
    kept = let(parts, lambda ls: F.array_join(F.transform(stay, lambda p: F.get(ls, p)), "\n"))
    out = docs.withColumn("_llm_key_row", same_text).join(
        drops, (doc == F.col("_llm_doc")) & (F.col("_llm_key_row") == F.col("_llm_row")), "left"
    )
    changed = F.when(F.col("_llm_drop").isNull(), F.coalesce(text, F.lit(""))).otherwise(kept)
    others = [F.col(f"`{c}`") if c != text_col else changed.alias(c) for c in docs.columns]
    return out.select(
        *others,
        F.size(parts).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_llm_drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
