"""The reads served from the marts, by endpoint name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardmill.operators.paging import PAGE, SIZE, paginate, records
from cardmill.plans.jobs import TableReader
from cardmill.sources.jdbc import JdbcTarget, page_query, read_jdbc_query

# Endpoint -> (mart, order of its pages); the top list is short and served whole.
ENDPOINTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "fraud-transactions": ("train_fraud_labels", ("id",)),
    "legit-transactions": ("transaction_validated", ("id",)),
    "top10-clients": ("top_10_consu", ()),
    "client-info": ("users_data", ("id",)),
}


def serve(
    spark: SparkSession, read: TableReader, endpoint: str, page: int = PAGE, size: int = SIZE
) -> DataFrame:
    """Records of an endpoint as JSON, from any store of marts."""
    mart, order_by = ENDPOINTS[endpoint]
    rows = read(spark, mart)
    return records(paginate(rows, order_by, page, size) if order_by else rows)


def serve_jdbc(
    spark: SparkSession, target: JdbcTarget, endpoint: str, page: int = PAGE, size: int = SIZE
) -> DataFrame:
    """The same from a relational store, which cuts the page itself."""
    mart, order_by = ENDPOINTS[endpoint]
    table = target.qualified(mart)
    if order_by:
        columns = read_jdbc_query(spark, target, f"SELECT * FROM {table} WHERE 1 = 0").columns
        query = page_query(table, order_by, page, size, columns)
    else:
        query = f"SELECT * FROM {table}"
    return records(read_jdbc_query(spark, target, query))
