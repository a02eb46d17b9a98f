"""The given tables seen as card-transaction tables, as Spark data frames.

orders are transactions, customers are users, suppliers are cards, parts are merchant categories and the order status
is the fraud label. Keys stay BIGINT, because order keys outgrow INT. Promotional parts are no merchant category,
so some codes have no label, and orders without a priority carry no fraud label.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardmill.operators.cleaning import clean_transactions
from cardmill.functions.money import exact_amount
from cardmill.operators.enrich import add_labels, enrich_transactions

YEAR = 1996
DAY = date(2025, 5, 22)

# Columns of the given tables used here; declaring them spares the job that reads footers.
GIVEN = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
}


def _dollars(amount: str, name: str) -> str:
    return f"concat('$', cast(cast({amount} AS decimal(15,2)) AS string)) AS {name}"


@dataclass(frozen=True)
class Sample:
    spark: SparkSession
    folder: str

    def raw(self, table: str) -> DataFrame:
        reader = self.spark.read
        if table in GIVEN:
            reader = reader.schema(GIVEN[table])
        return reader.parquet(f"{self.folder}/{table}.parquet")

    def _remainder(self, key: str, table: str) -> Column:
        """``key`` modulo the number of rows of ``table``, counted by a scalar subquery."""
        return F.col(key) % self.raw(table).select(F.count(F.lit(1))).scalar()

    def transactions(self) -> DataFrame:
        online = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
        orders = self.raw("orders").select(
            "*",
            self._remainder("o_orderkey", "supplier").alias("card_id"),
            self._remainder("o_orderkey", "part").alias("mcc"),
        )
        return orders.selectExpr(
            "o_orderkey AS id",
            "cast(o_orderdate AS timestamp) AS date",
            "o_custkey AS client_id",
            "card_id",
            _dollars("o_totalprice", "amount"),
            f"CASE WHEN {online} THEN 'Online Transaction' WHEN o_orderpriority = '3-MEDIUM' "
            "THEN 'Chip Transaction' ELSE 'Swipe Transaction' END AS use_chip",
            "o_orderkey % 5000 AS merchant_id",
            f"if({online}, 'ONLINE', concat('City ', o_custkey % 97)) AS merchant_city",
            f"if({online}, NULL, element_at(array('CA', 'TX', 'NY'), cast(o_custkey % 3 + 1 AS int))) "
            "AS merchant_state",
            f"if({online}, NULL, cast(10000 + o_custkey % 89999 AS double)) AS zip",
            "mcc",
            "if(o_orderkey % 50 = 7, 'Insufficient Balance', NULL) AS errors",
        )

    def users(self) -> DataFrame:
        age = "cast(18 + c_custkey % 60 AS int)"
        return self.raw("customer").selectExpr(
            "c_custkey AS id",
            f"{age} AS current_age",
            "66 AS retirement_age",
            f"2020 - {age} AS birth_year",
            "cast(1 + c_custkey % 12 AS int) AS birth_month",
            "if(c_custkey % 2 = 0, 'Female', 'Male') AS gender",
            "concat(c_custkey, ' Main Street') AS address",
            "cast(30 + c_custkey % 15 AS double) AS latitude",
            "cast(c_custkey % 45 - 120 AS double) AS longitude",
            _dollars("c_acctbal + 1000", "per_capita_income"),
            _dollars("c_acctbal + 2000", "yearly_income"),
            _dollars("c_acctbal", "total_debt"),
            "cast(500 + c_custkey % 350 AS int) AS credit_score",
            "cast(1 + c_custkey % 6 AS int) AS num_credit_cards",
        )

    def cards(self) -> DataFrame:
        suppliers = self.raw("supplier").select(
            "*", self._remainder("s_suppkey", "customer").alias("client_id")
        )
        return suppliers.selectExpr(
            "s_suppkey AS id",
            "client_id",
            "element_at(array('Visa', 'Mastercard', 'Amex', 'Discover'), cast(s_suppkey % 4 + 1 AS int)) "
            "AS card_brand",
            "if(s_suppkey % 3 = 0, 'Credit', 'Debit') AS card_type",
            "concat(3 + s_suppkey % 4, 100000000000000 + s_suppkey * 7919) AS card_number",
            "concat(lpad(1 + s_suppkey % 12, 2, '0'), '/', 2025 + s_suppkey % 5) AS expires",
            "cast(100 + s_suppkey % 900 AS int) AS cvv",
            "if(s_suppkey % 5 = 0, 'NO', 'YES') AS has_chip",
            "cast(1 + s_suppkey % 3 AS int) AS num_cards_issued",
            _dollars("s_acctbal", "credit_limit"),
            "concat(lpad(1 + s_suppkey % 11, 2, '0'), '/', 1998 + s_suppkey % 20) AS acct_open_date",
            "cast(2008 + s_suppkey % 12 AS int) AS year_pin_last_changed",
            "'No' AS card_on_dark_web",
        )

    def mcc(self) -> DataFrame:
        return (
            self.raw("part")
            .where(F.col("p_type") != "PROMO")
            .select(F.col("p_partkey").cast("string").alias("id"), F.col("p_type").alias("item"))
        )

    def labels(self) -> DataFrame:
        info = F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No")
        return (
            self.raw("orders")
            .where(F.col("o_orderpriority") != "4-NOT SPECIFIED")
            .select(F.col("o_orderkey").alias("id"), info.alias("info"))
        )

    def table(self, name: str) -> DataFrame:
        return {
            "transactions_data": self.transactions,
            "users_data": self.users,
            "cards_data": self.cards,
            "mcc_codes": self.mcc,
            "train_fraud_labels": self.labels,
        }[name]()

    def processed(self) -> DataFrame:
        """The processed table, from cleaned transactions stamped with a fixed ingestion day."""
        transactions = clean_transactions(self.transactions(), text_keys=False, exact=True)
        transactions = transactions.withColumn("ingestion_date", F.lit(DAY))
        return enrich_transactions(
            transactions, self.mcc(), self.users(), self.cards(), self.labels()
        )

    def spending(self, labelled: bool = False) -> DataFrame:
        """All transactions under the names the spending analytics use; only the flag needs the label join."""
        transactions = self.transactions()
        columns = [
            F.col("id").alias("transaction_id"),
            F.col("date").alias("transaction_date"),
            "client_id",
            exact_amount(transactions, "amount").alias("amount"),
            F.col("use_chip").alias("transaction_type"),
            "mcc",
        ]
        if labelled:
            transactions = add_labels(transactions, self.labels())
            columns.append((F.col("info") == "Yes").alias("is_fraud"))
        return transactions.select(*columns)

    def clients(self) -> DataFrame:
        """Users keyed by ``client_id``."""
        return self.users().withColumnRenamed("id", "client_id")
