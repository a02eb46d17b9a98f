"""Operator 3, mixing sources to target weights, by histograms of hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardmill.llm.common import WORD_CLASS, count_words, free
from cardmill.session import materialize

LEVELS, LEVEL_BITS = 3, 12
HASH_DIGITS = LEVELS * LEVEL_BITS // 4
ADDED = ("size", "source_size", "target", "taken")
# Null sources form a source of their own, after all others.
SOURCE = ("_llm_null", "_llm_source")


def hash_place(identity: Column) -> Column:
    """A place in [0, 2**36) that depends on the identity alone."""
    return F.conv(F.substring(F.md5(identity), 1, HASH_DIGITS), 16, 10).cast("bigint")


def source_targets(totals: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds ``target`` to one row a source with its total ``source_size``.

    Sources weigh ``weights`` in turn, in code-point order. They share ``share`` times all sizes; a source that
    would pass ``most`` times its size stops there and the excess goes to the others by weight. Sorted by the
    level at which they fill up, the sources that stop are a prefix, so running sums replace the iteration.
    """
    rank = F.row_number().over(Window.orderBy(*SOURCE)) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    rows = totals.withColumn("_llm_weight", weight).withColumn("_llm_cap", cap)
    order = Window.orderBy(F.col("_llm_cap") / F.col("_llm_weight"), *SOURCE)
    whole = Window.partitionBy()
    full_before = F.coalesce(F.sum("_llm_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("_llm_weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("source_size").over(whole) * F.lit(float(share))
    level = (budget - full_before) / weight_left
    rows = rows.withColumn("_llm_level", level).withColumn("_llm_place", F.row_number().over(order))
    below = F.col("_llm_cap") > F.col("_llm_weight") * F.col("_llm_level")
    final = F.min(F.when(below, F.struct("_llm_place", "_llm_level"))).over(whole)
    share_of = F.col("_llm_weight") * final["_llm_level"]
    return rows.select(
        *SOURCE, "source_size", F.coalesce(F.least(F.col("_llm_cap"), share_of), F.col("_llm_cap")).alias("target")
    )


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: copies that every row gets (``_llm_full``) and the place up to which rows get one more.

    The rows below a threshold are those whose sizes add up nearest to what the target leaves beyond the full
    copies. Each level sums sizes by source and bucket of 12 more bits, then looks into the boundary bucket only,
    so no row is sorted and a source of any size is at most 4096 sums a task. A larger target never loses a row.
    """
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("_llm_full", full.cast("bigint")).select(
        *SOURCE,
        "source_size",
        "target",
        "_llm_full",
        (F.col("target") - F.col("_llm_full") * F.col("source_size")).alias("_llm_rest"),
        F.lit(0).cast("bigint").alias("_llm_prefix"),
        F.lit(0).cast("bigint").alias("_llm_base"),
    )
    for level in range(1, LEVELS + 1):
        down = (LEVELS - level) * LEVEL_BITS
        state = materialize(state, f"mix-level-{level}")
        keys = state.select(*SOURCE, "_llm_prefix")
        # Rows of the boundary bucket; at the first level that is every row.
        inside = sized.withColumn("_llm_prefix", F.shiftright("_llm_u", down + LEVEL_BITS)) if level > 1 else sized
        if level > 1:
            inside = inside.join(keys, [*SOURCE, "_llm_prefix"], "left_semi")
        sums = inside.groupBy(*SOURCE, F.shiftright("_llm_u", down).alias("_llm_bucket")).agg(
            F.sum("size").alias("_llm_sum")
        )
        order = Window.partitionBy(*SOURCE).orderBy("_llm_bucket")
        before = F.sum("_llm_sum").over(order) - F.col("_llm_sum")
        ranked = sums.join(state, list(SOURCE)).withColumn("_llm_before", F.col("_llm_base") + before)
        end = F.col("_llm_before") + F.col("_llm_sum")
        boundary = ranked.where((F.col("_llm_before") < F.col("_llm_rest")) & (end >= F.col("_llm_rest")))
        found = boundary.select(*SOURCE, "_llm_bucket", "_llm_before", end.alias("_llm_end"))
        # Without a boundary nothing more is taken: the place before the first.
        state = state.join(found, list(SOURCE), "left")
        rest = [*SOURCE, "source_size", "target", "_llm_full", "_llm_rest"]
        if level < LEVELS:
            state = state.select(
                *rest,
                F.coalesce("_llm_bucket", F.lit(-1)).cast("bigint").alias("_llm_prefix"),
                F.coalesce("_llm_before", F.lit(0)).cast("bigint").alias("_llm_base"),
            )
        else:
            nearer = (F.col("_llm_end") - F.col("_llm_rest")) < (F.col("_llm_rest") - F.col("_llm_before"))
            place = F.col("_llm_bucket") - F.when(nearer, 0).otherwise(1)
            state = state.select(*rest, F.coalesce(place, F.lit(-1)).alias("_llm_last"))
    return state


def _places(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``docs`` with the source that a row counts for and its place."""
    doc, text, source = (F.col(f"`{c}`") for c in (id_col, text_col, source_col))
    identity = F.coalesce(doc.cast("string"), F.concat(F.lit("null:"), F.coalesce(text, F.lit(""))))
    return docs.withColumns(
        {
            "_llm_null": source.isNull(),
            "_llm_source": F.coalesce(source.cast("string"), F.lit("")),
            "_llm_u": hash_place(identity),
        }
    )


def _bounds(places: DataFrame, text_col: str, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """The thresholds of all sources, written; words are counted once, into a copy of the sizes alone."""
    size = count_words(F.col(f"`{text_col}`"))
    sized = materialize(places.select(*SOURCE, "_llm_u", size.alias("size")), "mix-sizes")
    totals = sized.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    return materialize(thresholds(sized, source_targets(totals, weights, share, most)), "mix-bounds")


def _copies() -> Column:
    """How often the mix takes a row that has been joined to its thresholds."""
    return F.col("_llm_full") + F.when(F.col("_llm_u") <= F.col("_llm_last"), 1).otherwise(0)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2,
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` and ``taken`` (words the mix takes of the row).

    * ``taken`` is ``size`` times 0 to ``most``; a source's taken words come within half a row of its target.
    * Null text has size 0. Null sources are one source, last in order. No sizes at all: targets of 0.
    * A row's place depends on its id (or its text, where the id is null) alone, so reruns agree; rows with
      equal ids are taken or left together. Input columns named like the added ones are replaced.
    """
    docs = free(docs, *ADDED)
    places = _places(docs, id_col, text_col, source_col)
    bounds = _bounds(places, text_col, weights, share, most)
    marked = places.withColumn("size", count_words(F.col(f"`{text_col}`")))
    return marked.join(bounds, list(SOURCE)).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        "size",
        "source_size",
        "target",
        (F.col("size") * _copies()).alias("taken"),
    )


def _repeated(rows: DataFrame, times: Column) -> DataFrame:
    """Each row ``times`` times."""
    several = rows.withColumn("_llm_times", times.cast("int")).where(F.col("_llm_times") > 0)
    return several.withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), F.col("_llm_times")))).drop(
        "_llm_times", "_llm_copy"
    )


def take_mix(mixed: DataFrame) -> DataFrame:
    """The rows of a mix, each as often as it is taken; rows without words count as not taken."""
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0)
    return _repeated(mixed, times).drop(*ADDED)


def mixed_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2,
) -> DataFrame:
    """The rows of ``take_mix(mix(docs))`` without counting their words again: a row needs but one word to be taken."""
    docs = free(docs, *ADDED)
    places = _places(docs, id_col, text_col, source_col)
    bounds = _bounds(places, text_col, weights, share, most)
    worded = F.col(f"`{text_col}`").rlike(WORD_CLASS)
    taken = _repeated(places.join(bounds, list(SOURCE)), F.when(worded, _copies()).otherwise(0))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
