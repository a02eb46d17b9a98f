"""A layout in which predicates on either of several columns skip row groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardmill.operators.sizing import output_partitions
from cardmill.session import timestamp_statistics
from cardmill.sinks.keyed import FILE_MB, range_place

# Bits of the place in each column: so many quantiles, so fine the order.
BITS = 8
ACCURACY = 10_000


def interleave(places: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the places dealt out in turn, highest first, as one BIGINT: their Z-order."""
    if not places or len(places) * bits > 62:
        raise ValueError("one to 62 bits in all")
    code = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for place in places:
            code = F.shiftleft(code, 1).bitwiseOR(F.shiftright(place.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint")))
    return code


def with_clustering(df: DataFrame, columns: Sequence[str], bits: int = BITS, code_col: str = "_code") -> DataFrame:
    """``df`` with its Z-order over the quantiles of ``columns`` (numbers, dates or timestamps).

    Quantiles make all columns count alike, however their values are spread; they come from one pass over these
    columns, by mergeable summaries. NULL has the place before all.
    """
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    quantiles = df.select(
        F.struct(*[F.percentile_approx(c, shares, ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)])
    ).scalar()
    rows = df.withColumn("_quantiles", quantiles)
    places = [
        F.coalesce(range_place(F.col(c), F.col("_quantiles")[f"q{i}"]), F.lit(0)) for i, c in enumerate(columns)
    ]
    rows = rows.withColumn("_places", F.array(*places))
    code = interleave([F.col("_places")[i] for i in range(len(columns))], bits)
    return rows.withColumn(code_col, code).drop("_quantiles", "_places")


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    files: int | None = None,
    bits: int = BITS,
    row_group_bytes: int | None = None,
) -> None:
    """Write ``df`` in ranges of its Z-order over ``columns``, sorted by it.

    Files and row groups then hold narrow ranges of every column, and a filter on one of them, or on both, skips
    those of the others. Rows of one code are kept apart by the columns themselves, so a code with very many rows is
    dealt over several files as long as these differ.
    """
    parts = files or output_partitions(df, FILE_MB)
    ranged = with_clustering(df, columns, bits).repartitionByRange(parts, "_code", *columns)
    ranged = ranged.sortWithinPartitions("_code", *columns).drop("_code")
    writer = ranged.write if row_group_bytes is None else ranged.write.option("parquet.block.size", row_group_bytes)
    with timestamp_statistics(df.sparkSession):
        writer.parquet(path)
