"""Reproducible pseudo-random row assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def hash_percent(key: str | Column, seed: int) -> Column:
    """0..99 from a key and a seed: the same for a key in every run and on every partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def hash_split(
    df: DataFrame, key: str, percents: Sequence[int] = (80, 20), seed: int = 42
) -> list[DataFrame]:
    """Disjoint, complete subsets of ``df`` with about the given percentages of the keys."""
    if sum(percents) != 100:
        raise ValueError("percentages must add up to 100")
    parts, low = [], 0
    for percent in percents:
        bucket = hash_percent(key, seed)
        parts.append(df.where((bucket >= low) & (bucket < low + percent)))
        low += percent
    return parts


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42
) -> list[DataFrame]:
    """Spark's own split; reproducible only while the partitioning of ``df`` stays the same."""
    return df.randomSplit(list(weights), seed=seed)
