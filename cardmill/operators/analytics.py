"""Spending analytics over transactions; column names, years and k are parameters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from cardmill.functions.calendar import in_year, last_days
from cardmill.functions.money import exact_amount, exact_mean, exact_sum

YEAR = 2010


def count_last_days(
    df: DataFrame,
    days: int = 90,
    date_col: str = "transaction_date",
    anchor: date | None = None,
) -> DataFrame:
    """One row ``n``: transactions of the last ``days`` days before the newest one or ``anchor``.

    The cutoff reaches the scan, so that only recent row groups are counted.
    """
    return last_days(df, date_col, days, anchor).agg(F.count(F.lit(1)).alias("n"))


def monthly_totals(
    df: DataFrame,
    year: int = YEAR,
    client_col: str = "client_id",
    date_col: str = "transaction_date",
    amount_col: str = "amount",
) -> DataFrame:
    """Spending per month of a year and client."""
    return (
        df.where(in_year(date_col, year))
        .groupBy(F.month(date_col).alias("month"), F.col(client_col).alias(client_col))
        .agg(exact_sum(exact_amount(df, amount_col)).alias("total_spent"))
    )


def top_clients(
    df: DataFrame,
    year: int = YEAR,
    k: int = 10,
    client_col: str = "client_id",
    date_col: str = "transaction_date",
    amount_col: str = "amount",
) -> DataFrame:
    """The ``k`` clients that spent most in a year; ties go to the smaller client id."""
    return (
        df.where(in_year(date_col, year))
        .groupBy(client_col)
        .agg(exact_sum(exact_amount(df, amount_col)).alias("total_spent"))
        .orderBy(F.desc("total_spent"), F.asc(client_col))
        .limit(k)
    )


def top_clients_per_month(
    df: DataFrame,
    year: int = YEAR,
    k: int = 3,
    client_col: str = "client_id",
    date_col: str = "transaction_date",
    amount_col: str = "amount",
    rank_col: str = "rank",
) -> DataFrame:
    """The ``k`` clients that spent most in each month of a year, ordered by month and rank.

    Spark cuts each task's rows to ``k`` per month before the window's shuffle, so a month never gathers
    all its clients in one task.
    """
    by_spending = Window.partitionBy("month").orderBy(F.desc("total_spent"), F.asc(client_col))
    return (
        monthly_totals(df, year, client_col, date_col, amount_col)
        .withColumn(rank_col, F.row_number().over(by_spending))
        .where(F.col(rank_col) <= k)
        .orderBy("month", rank_col)
    )


def client_metrics(
    df: DataFrame,
    year: int = YEAR,
    client_col: str = "client_id",
    date_col: str = "transaction_date",
    amount_col: str = "amount",
) -> DataFrame:
    """Per client of a year: number, mean, maximum and last date of transactions, and the best month.

    One aggregation with one shuffle: twelve monthly sums ride along with the other aggregates, and the
    best month is the position of the largest. The earliest month wins a tie; a client without any
    amount gets its first month.
    """
    month, amount = F.month(date_col), exact_amount(df, amount_col)
    sums = [F.sum(F.when(month == m, amount)).alias(f"_m{m}") for m in range(1, 13)]
    metrics = (
        df.where(in_year(date_col, year))
        .groupBy(client_col)
        .agg(
            F.count(F.lit(1)).alias("nb_transactions"),
            exact_mean(amount).alias("avg_spent"),
            F.max(amount).cast("double").alias("max_spent"),
            F.max(date_col).alias("last_transaction_date"),
            F.min(month).alias("_first_month"),
            *sums,
        )
    )
    totals = F.array(*(F.col(f"_m{m}") for m in range(1, 13)))
    best = F.array_position(totals, F.array_max(totals)).cast("int")
    return metrics.select(
        client_col,
        F.lit(year).alias("year"),
        "nb_transactions",
        "avg_spent",
        "max_spent",
        "last_transaction_date",
        F.coalesce(best, "_first_month").alias("best_month"),
    )


def best_month(
    df: DataFrame,
    year: int = YEAR,
    client_col: str = "client_id",
    date_col: str = "transaction_date",
    amount_col: str = "amount",
) -> DataFrame:
    """``client, best_month`` by ranking the monthly totals of each client (at most twelve rows each)."""
    by_total = Window.partitionBy(client_col).orderBy(F.desc("total_spent"), F.asc("month"))
    return (
        monthly_totals(df, year, client_col, date_col, amount_col)
        .withColumn("rank", F.row_number().over(by_total))
        .where(F.col("rank") == 1)
        .select(client_col, F.col("month").alias("best_month"))
    )


def average_by_type(
    df: DataFrame, type_col: str = "transaction_type", amount_col: str = "amount"
) -> DataFrame:
    """Mean amount per transaction type."""
    return df.groupBy(type_col).agg(exact_mean(exact_amount(df, amount_col)).alias("avg_amount"))
