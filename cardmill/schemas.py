"""Declared table schemas and their SQL renderings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names and types of the five source tables.
SOURCE_COLUMNS = {
    "train_fraud_labels": "id int, info string",
    "users_data": (
        "id int, current_age int, retirement_age int, birth_year int, birth_month int, "
        "gender string, address string, latitude double, longitude double, "
        "per_capita_income string, yearly_income string, total_debt string, "
        "credit_score int, num_credit_cards int"
    ),
    "transactions_data": (
        "id int, date timestamp, client_id int, card_id int, amount string, use_chip string, "
        "merchant_id int, merchant_city string, merchant_state string, zip double, mcc int, "
        "errors string"
    ),
    "mcc_codes": "id string, item string",
    "cards_data": (
        "id int, client_id int, card_brand string, card_type string, card_number string, "
        "expires string, cvv int, has_chip string, num_cards_issued int, credit_limit string, "
        "acct_open_date string, year_pin_last_changed int, card_on_dark_web string"
    ),
}
INGESTION_COLUMN = "ingestion_date"
PARTITION_COLUMNS = ("year", "month", "day")

# Spark types of the type names above; no session is needed to look them up.
SQL_TYPES = {
    "int": IntegerType(),
    "string": StringType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
}

# Columns that identify rows of other tables; they outgrow INT first.
KEY_COLUMNS = ("id", "client_id", "card_id", "merchant_id", "mcc")

# Spark type -> PostgreSQL column type.
POSTGRES_TYPES: dict[type[DataType], str] = {
    StringType: "TEXT",
    IntegerType: "INTEGER",
    LongType: "BIGINT",
    FloatType: "REAL",
    DoubleType: "DOUBLE PRECISION",
    BooleanType: "BOOLEAN",
    TimestampType: "TIMESTAMP",
    DateType: "DATE",
}


def table_schema(
    table: str,
    ingestion: bool = False,
    partitions: bool = False,
    wide_keys: bool = True,
) -> StructType:
    """Schema of a source table; an unknown name raises ``KeyError``.

    ``ingestion`` adds the ingestion date and ``partitions`` the year/month/day of the bronze layout. Keys are
    BIGINT, since tables may have more rows than INT can number; ``wide_keys=False`` declares them INT, and then
    the readers raise an error for a key that does not fit.
    """
    schema = StructType()
    for column in SOURCE_COLUMNS[table].split(", "):
        name, kind = column.split(" ")
        wide = wide_keys and kind == "int" and name in KEY_COLUMNS
        schema = schema.add(name, LongType() if wide else SQL_TYPES[kind])
    if ingestion:
        schema = schema.add(INGESTION_COLUMN, DateType())
    for name in PARTITION_COLUMNS if partitions else ():
        schema = schema.add(name, IntegerType())
    return schema


def read_as(schema: StructType) -> StructType:
    """The schema that text files are parsed with: INT keys as BIGINT, so that large ones are seen."""
    out = StructType()
    for f in schema.fields:
        narrow = f.name in KEY_COLUMNS and isinstance(f.dataType, IntegerType)
        out = out.add(f.name, LongType() if narrow else f.dataType)
    return out


def narrow_keys(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in ``schema``; a key beyond INT raises an error instead of becoming NULL."""

    def fit(name: str) -> Column:
        key = F.col(f"`{name}`")
        error = F.raise_error(F.concat(F.lit(f"key {name} does not fit INT: "), key.cast("string")))
        return F.when(key.isNull() | key.between(-(2**31), 2**31 - 1), key.try_cast("int")).otherwise(error)

    keys = [f.name for f in schema.fields if f.name in KEY_COLUMNS and isinstance(f.dataType, IntegerType)]
    return df.withColumns({name: fit(name) for name in keys}) if keys else df


def ddl(schema: StructType) -> str:
    """``name TYPE, ...`` for a schema, usable as a read schema or in CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def postgres_type(data_type: DataType) -> str:
    """PostgreSQL type of a Spark type; unlisted types are stored as text."""
    if isinstance(data_type, DecimalType):
        return f"NUMERIC({data_type.precision},{data_type.scale})"
    return POSTGRES_TYPES.get(type(data_type), "TEXT")


def _quoted(field: StructField) -> str:
    return '"' + field.name.replace('"', '""') + '" ' + postgres_type(field.dataType)


def create_table_ddl(df: DataFrame, table: str) -> str:
    """CREATE TABLE statement for a relational copy of ``df``."""
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(map(_quoted, df.schema.fields))})"
