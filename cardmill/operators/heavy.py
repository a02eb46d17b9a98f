"""Joins that stay even where a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardmill.operators.sizing import BROADCAST_LIMIT, broadcast_within

SHARE = 0.01
# Keys that a summary keeps track of for each that may be heavy: its counts are then good to a few hundredths of it.
TRACKED = 100


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """The keys that hold at least about ``share`` of the rows, at most ``1 / share`` many, NULL left out.

    One pass over the key column with a summary of frequent items, whose size is fixed by ``share`` and not by
    the number of keys; summaries of tasks are merged, no key is shuffled. Counts may be too large by a few
    hundredths of ``share``, never so small that a heavy key is missed.
    """
    if not 0 < share < 1:
        raise ValueError("share is between 0 and 1")
    most = int(1 / share)
    top = F.expr(f"approx_top_k(`{key}`, {most + 1}, {most * TRACKED})").alias("top")
    row = df.where(F.col(key).isNotNull()).agg(top, F.count(F.lit(1)).alias("n")).first()
    return sorted(item["item"] for item in row["top"] or [] if item["count"] >= share * row["n"])


def join_heavy(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "inner",
    share: float = SHARE,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``rows`` joined with a dimension that is too large to broadcast, heavy keys apart from the others.

    The few dimension rows of heavy keys are broadcast (if they are as few as they should be), so their rows stay where
    they were read; all other rows are shuffled by key, none of which is heavy. That also holds where AQE cannot
    split a key, because an aggregation by the same key shares the stage. ``rows`` are scanned three times, once
    for the key alone. ``how`` is ``inner`` or ``left``; a NULL key matches nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join {how}")
    heavy = heavy_keys(rows, key, share)
    if not heavy:
        return rows.join(dimension, key, how)
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    few = broadcast_within(dimension.where(is_heavy), broadcast_limit, always_hint=True)
    return rows.where(is_heavy).join(few, key, how).unionByName(
        rows.where(~is_heavy).join(dimension.where(~is_heavy), key, how)
    )
