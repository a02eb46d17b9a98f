"""Money strings, exact amounts, sums and means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

# Room for 10**24 units with six decimal places; sums have eight more digits.
EXACT_TYPE = "decimal(30,6)"
EXACT_SUFFIX = "_exact"


def _plain(column: str | Column) -> Column:
    return F.translate(column, "$", "")


def _finite(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def money(column: str | Column) -> Column:
    """``"$12.50"`` -> 12.5 as FLOAT; text that is no finite number becomes NULL.

    Only the dollar sign is removed, so a thousands separator makes the value NULL.
    """
    return _finite(_plain(column).try_cast("float"))


def exact_money(column: str | Column) -> Column:
    """``"$12.50"`` -> 12.500000 as a wide decimal, without passing through FLOAT."""
    return _plain(column).try_cast(EXACT_TYPE)


def clean_money(df: DataFrame, *names: str) -> DataFrame:
    """Parse the named money columns in place; columns that are numbers already are only cast."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            n: F.col(n).try_cast("float") if isinstance(types[n], NumericType) else money(F.col(n))
            for n in names
        }
    )


def exact_amount(df: DataFrame, name: str) -> Column:
    """The amounts of a column as wide decimals.

    They come from the column that keeps them beside ``name`` where there is one, else from ``name`` itself: from
    its text, or from the stored numbers. What is no number, or has more digits than fit, becomes NULL.
    """
    if f"{name}{EXACT_SUFFIX}" in df.columns:
        return F.col(f"{name}{EXACT_SUFFIX}")
    return exact_money(name) if isinstance(df.schema[name].dataType, StringType) else F.col(name).try_cast(EXACT_TYPE)


def exact_sum(column: str | Column) -> Column:
    """Sum of amounts as DOUBLE, added as decimals and so independent of the order of addition."""
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column.try_cast(EXACT_TYPE)).cast("double")


def exact_mean(column: str | Column) -> Column:
    """Mean of amounts as DOUBLE: the exact sum by the number of amounts, the same on every partitioning."""
    column = F.col(column) if isinstance(column, str) else column
    return exact_sum(column) / F.count(column.try_cast(EXACT_TYPE))
