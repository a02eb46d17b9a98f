"""Row filters and the views built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def by_label(df: DataFrame, value: str, column: str = "info") -> DataFrame:
    """Rows whose label equals ``value`` exactly; NULL and other spellings do not match."""
    return df.where(F.col(column) == value)


def fraud(df: DataFrame, column: str = "is_fraud") -> DataFrame:
    return df.where(F.col(column))


def non_fraud(df: DataFrame, column: str = "is_fraud") -> DataFrame:
    return df.where(~F.col(column))


def create_fraud_views(
    df: DataFrame,
    column: str = "is_fraud",
    fraud_view: str = "fraud_transactions",
    non_fraud_view: str = "non_fraud_transactions",
) -> None:
    """Register both subsets as temporary views; rows without a flag are in neither."""
    fraud(df, column).createOrReplaceTempView(fraud_view)
    non_fraud(df, column).createOrReplaceTempView(non_fraud_view)


def preview(df: DataFrame, n: int = 2) -> DataFrame:
    """A few rows for a look at the data."""
    return df.limit(n)


def require_rows(df: DataFrame, what: str = "data frame") -> DataFrame:
    """``df`` itself, or an error if it has no row; stops at the first row found."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
