"""Date expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F


def in_year(column: str | Column, year: int) -> Column:
    """Half-open year range; unlike ``year(column) = y`` it reaches the Parquet scan."""
    column = F.col(column) if isinstance(column, str) else column
    return (column >= F.lit(f"{year:04d}-01-01").cast("timestamp")) & (
        column < F.lit(f"{year + 1:04d}-01-01").cast("timestamp")
    )


def calendar_parts(column: str | Column) -> dict[str, Column]:
    """year, month, day and day_of_week (Sunday = 1) of a date or timestamp."""
    return {
        "year": F.year(column),
        "month": F.month(column),
        "day": F.dayofmonth(column),
        "day_of_week": F.dayofweek(column),
    }


def ingestion_day(as_of: date | None = None, days_ago: int = 0) -> Column:
    """The ingestion date: a given day, or today, ``days_ago`` days back."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_sub(day, days_ago) if days_ago else day


def last_days(
    df: DataFrame, column: str, days: int = 90, anchor: date | Column | None = None
) -> DataFrame:
    """Rows of the last ``days`` days before ``anchor``, by default before the newest row.

    The default anchor is a scalar subquery over one column. The whole cutoff is computed inside it, so
    that the scan gets a plain comparison and can skip row groups.
    """
    if anchor is None:
        cutoff = df.select(F.date_sub(F.max(column), days).cast("timestamp")).scalar()
    else:
        cutoff = F.date_sub(anchor if isinstance(anchor, Column) else F.lit(anchor), days).cast("timestamp")
    return df.where(F.col(column) >= cutoff)
