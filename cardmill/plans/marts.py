"""The ten marts, by output name."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardmill.functions.money import EXACT_SUFFIX, exact_amount, exact_mean
from cardmill.operators.filters import by_label

CLIENT = ("client_id", "current_age", "gender")
KPI_MART, TOP_MART = "kpi_by_consu_id", "top_10_consu"


def transaction_validated(processed: DataFrame) -> DataFrame:
    """Processed rows with label 'Yes'. The name follows the mart; the label itself means fraud."""
    return _whole(by_label(processed, "Yes"))


def transaction_refused(processed: DataFrame) -> DataFrame:
    """Processed rows with label 'No'."""
    return _whole(by_label(processed, "No"))


def top_consumers(processed: DataFrame, k: int = 10) -> DataFrame:
    """Clients with most transactions. ``total_amount`` counts amounts that are not NULL."""
    return top_of_kpis(client_kpis(processed), k)


def top_of_kpis(kpis: DataFrame, k: int = 10) -> DataFrame:
    """The same from the client KPIs, which hold the counts already."""
    return kpis.select(*CLIENT, "total_amount").orderBy(F.desc("total_amount"), *CLIENT).limit(k)


def client_kpis(processed: DataFrame) -> DataFrame:
    """Counts, mean and maximum of amounts per client. ``total_amount`` counts amounts that are not NULL."""
    return processed.groupBy(*CLIENT).agg(
        F.count("amount").alias("total_amount"),
        F.count(F.lit(1)).alias("transaction_count"),
        exact_mean(exact_amount(processed, "amount")).alias("avg_spent"),
        F.max("amount").alias("max_spent"),
    )


def _whole(df: DataFrame) -> DataFrame:
    """All columns but the exact amounts, which are no part of a mart."""
    return df.drop(*(c for c in df.columns if c.endswith(EXACT_SUFFIX)))


# Output table -> (silver table, query over it).
MARTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "transaction_validated": ("transactions_data_processed", transaction_validated),
    "transaction_refused": ("transactions_data_processed", transaction_refused),
    TOP_MART: ("transactions_data_processed", top_consumers),
    KPI_MART: ("transactions_data_processed", client_kpis),
    "cards_data": ("cards_data_cleaned", _whole),
    "mcc_codes": ("mcc_codes", _whole),
    "train_fraud_labels": ("train_fraud_labels", _whole),
    "transactions_data": ("transactions_data_cleaned", _whole),
    "transactions_data_processed": ("transactions_data_processed", _whole),
    "users_data": ("users_data_cleaned", _whole),
}


def _read(spark: SparkSession, database: str, table: str, query: Callable) -> DataFrame:
    return query(spark.table(f"`{database}`.`{table}`"))


def marts(database: str = "process_data") -> dict[str, Callable[[SparkSession], DataFrame]]:
    """Every mart as a function of the session, over the silver tables of ``database``."""
    return {
        name: partial(_read, database=database, table=table, query=query)
        for name, (table, query) in MARTS.items()
    }


def mart(name: str, database: str = "process_data") -> Callable[[SparkSession], DataFrame]:
    """One mart by name; an unknown name raises ``KeyError``."""
    return marts(database)[name]
