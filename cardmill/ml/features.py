"""Feature frames for the trainers."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from cardmill.functions.calendar import calendar_parts

# Names, types, defaults and order of the models' features, and the card brands.
CALENDAR_FEATURES = ("year", "month", "day", "day_of_week")
AMOUNT_FLOATS = ("credit_score", "amount", "yearly_income", "total_debt", "credit_limit", "per_capita_income")
AMOUNT_FLAGS = {"has_chip": 1, "card_on_dark_web": 0}
AMOUNT_DEFAULTS = {
    "credit_score": 600,
    "num_credit_cards": 1,
    "has_chip": 1,
    "card_on_dark_web": 0,
    "yearly_income": 30000,
    "total_debt": 1000,
    "credit_limit": 5000,
    "per_capita_income": 25000,
    "gender": "unknown",
    "card_brand": "unknown",
    "card_type": "unknown",
}
AMOUNT_STRINGS = ("gender", "card_brand", "card_type")
AMOUNT_FEATURES = (
    "credit_score", "num_credit_cards", "yearly_income", "total_debt", "credit_limit",
    "per_capita_income", "has_chip", "card_on_dark_web",
    "gender_index", "card_brand_index", "card_type_index",
)
CARD_BRANDS = ("Visa", "Mastercard", "Discover", "Amex")
BRAND_FEATURES = ("prefix1", "prefix2", "prefix4", "length")


def calendar_features(
    df: DataFrame, date_col: str = "date", label_col: str = "amount"
) -> DataFrame:
    """Add the calendar features; a missing label counts as 0."""
    return df.withColumns(calendar_parts(date_col)).fillna({label_col: 0})


def yes_no_flag(column: str, default: int) -> Column:
    """1 for yes, 0 for any other text, ``default`` for NULL; numbers pass through."""
    text = F.upper(F.trim(F.col(column).cast("string")))
    return (
        F.when(text.isNull(), F.lit(default))
        .when(text == "YES", F.lit(1))
        .otherwise(F.coalesce(text.try_cast("int"), F.lit(0)))
    )


def amount_features(df: DataFrame) -> DataFrame:
    """Type the client and card columns and fill their gaps; rows without an amount stay unlabelled."""
    columns = {name: F.col(name).try_cast("float") for name in AMOUNT_FLOATS}
    columns |= {"num_credit_cards": F.col("num_credit_cards").try_cast("int")}
    columns |= {name: yes_no_flag(name, default) for name, default in AMOUNT_FLAGS.items()}
    return df.withColumns(columns).fillna(AMOUNT_DEFAULTS)


def brand_features(df: DataFrame, number_col: str = "card_number") -> DataFrame:
    """Rows of the known brands with number prefixes and number length."""
    return df.where(F.col("card_brand").isin(*CARD_BRANDS)).withColumns(
        {
            "prefix1": F.substring(number_col, 1, 1).try_cast("int"),
            "prefix2": F.substring(number_col, 1, 2).try_cast("int"),
            "prefix4": F.substring(number_col, 1, 4).try_cast("int"),
            "length": F.length(number_col),
        }
    )


def string_indexer(column: str, output: str | None = None, invalid: str = "keep") -> StringIndexer:
    """Index by falling frequency, ties in alphabetical order."""
    return StringIndexer(inputCol=column, outputCol=output or f"{column}_index", handleInvalid=invalid)


def index_mapping(df: DataFrame, column: str) -> DataFrame:
    """``column, idx`` of a fitted index."""
    model = string_indexer(column, "idx").fit(df.select(column))
    return model.transform(df.select(column).distinct()).where(F.col(column).isNotNull())


def assembler(features: tuple[str, ...] | list[str], invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=invalid)
