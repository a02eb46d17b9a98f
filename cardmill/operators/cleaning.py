"""Bronze rows -> typed rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from cardmill.functions.calendar import ingestion_day
from cardmill.functions.money import EXACT_SUFFIX, clean_money, exact_amount
from cardmill.schemas import INGESTION_COLUMN

# The timestamp format and the money columns of the source tables.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TRANSACTION_MONEY = ("amount",)
CARD_MONEY = ("credit_limit",)
USER_MONEY = ("per_capita_income", "yearly_income", "total_debt")


def stamp_ingestion(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """Add the ingestion date."""
    return df.withColumn(INGESTION_COLUMN, ingestion_day(as_of))


def stamp_ingestion_partition(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """Add the ingestion date and its year, month and day."""
    day = ingestion_day(as_of)
    return df.withColumns(
        {
            INGESTION_COLUMN: day,
            "year": F.year(day),
            "month": F.month(day),
            "day": F.dayofmonth(day),
        }
    )


def clean_transactions(df: DataFrame, text_keys: bool = True, exact: bool = False) -> DataFrame:
    """Parse date and amount; unreadable values become NULL.

    ``mcc`` and ``client_id`` become text, as in the cleaned table; ``text_keys=False`` keeps their type
    for further joins. ``exact`` adds ``amount_exact``, the amount as a decimal that sums and means are made of.
    """
    columns = {}
    if isinstance(df.schema["date"].dataType, StringType):
        columns["date"] = F.try_to_timestamp("date", F.lit(TIMESTAMP_FORMAT))
    else:
        columns["date"] = F.col("date").cast("timestamp")
    if text_keys:
        columns |= {name: F.col(name).cast("string") for name in ("mcc", "client_id")}
    if exact:
        columns |= {f"{name}{EXACT_SUFFIX}": exact_amount(df, name) for name in TRANSACTION_MONEY}
    return clean_money(df.withColumns(columns), *TRANSACTION_MONEY)


def clean_cards(df: DataFrame) -> DataFrame:
    """Parse the credit limit."""
    return clean_money(df, *CARD_MONEY)


def clean_users(df: DataFrame) -> DataFrame:
    """Parse incomes and debt."""
    return clean_money(df, *USER_MONEY)
