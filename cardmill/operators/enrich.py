"""Joins that add client, card, category and label columns to transactions.

Dimensions are broadcast only after ``broadcast_within`` has checked their size. Every other join shuffles on
its key and leaves a key that holds a large share of the rows to AQE, which splits its partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardmill.functions.money import clean_money
from cardmill.operators.cleaning import CARD_MONEY, TRANSACTION_MONEY, USER_MONEY
from cardmill.operators.sizing import BROADCAST_LIMIT, broadcast_within
from cardmill.schemas import INGESTION_COLUMN


def add_labels(transactions: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Keep labelled transactions and add ``info``; a second label doubles its transaction.

    Labels have the grain of transactions, so this join always shuffles unless they happen to be few.
    """
    return transactions.join(labels.drop(INGESTION_COLUMN), key)


def labels_in_range(labels: DataFrame, transactions: DataFrame, key: str = "id") -> DataFrame:
    """Labels between the smallest and the largest key of ``transactions``; an inner join loses nothing.

    Reads one column of the transactions and looks up two numbers. Worth it where the transactions are one
    ingestion day and the labels a long history: the range reaches the scan, and only these labels shuffle.
    """
    low, high = transactions.agg(F.min(key), F.max(key)).first()
    return labels.where(F.col(key).between(low, high))


def add_users(
    transactions: DataFrame, users: DataFrame, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Keep transactions of known clients and add the client columns."""
    users = users.drop(INGESTION_COLUMN).withColumnRenamed("id", "users_id_client")
    users = broadcast_within(users, broadcast_limit)
    joined = transactions.join(users, transactions["client_id"] == users["users_id_client"])
    return joined.drop("users_id_client")


def add_cards(
    transactions: DataFrame, cards: DataFrame, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Keep transactions of known cards and add the card columns, without the card's client."""
    cards = cards.drop(INGESTION_COLUMN, "client_id").withColumnRenamed("id", "cards_id_card")
    cards = broadcast_within(cards, broadcast_limit)
    joined = transactions.join(cards, transactions["card_id"] == cards["cards_id_card"])
    return joined.drop("cards_id_card")


def add_mcc(
    transactions: DataFrame,
    mcc: DataFrame,
    mcc_key: str = "mcc",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Add the category label; ``item`` is NULL for an unknown code."""
    mcc = mcc.drop(INGESTION_COLUMN).withColumnRenamed("id", "mcc_id")
    mcc = broadcast_within(mcc, broadcast_limit)
    joined = transactions.join(mcc, transactions[mcc_key].cast("string") == mcc["mcc_id"], "left")
    return joined.drop("mcc_id")


def enrich_transactions(
    transactions: DataFrame,
    mcc: DataFrame,
    users: DataFrame,
    cards: DataFrame,
    labels: DataFrame,
    mcc_key: str = "mcc",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The processed table: transaction, category, client, card and label columns, money parsed.

    The label join runs first: it is the one that must shuffle both sides, it drops the unlabelled rows and
    at that point a row carries only the transaction columns. The joins that add most columns come last.
    """
    order = [
        *(c for c in transactions.columns),
        "item",
        *(c for c in users.columns if c not in ("id", INGESTION_COLUMN)),
        *(c for c in cards.columns if c not in ("id", "client_id", INGESTION_COLUMN)),
        "info",
    ]
    df = add_labels(clean_money(transactions, *TRANSACTION_MONEY), labels)
    df = add_mcc(df, mcc, mcc_key, broadcast_limit)
    df = add_users(df, clean_money(users, *USER_MONEY), broadcast_limit)
    df = add_cards(df, clean_money(cards, *CARD_MONEY), broadcast_limit)
    return df.select(*order)


def with_clients(transactions: DataFrame, clients: DataFrame, key: str = "client_id") -> DataFrame:
    """Inner join with clients; the planner and AQE choose the strategy."""
    return transactions.join(clients, key)


def with_clients_broadcast(
    transactions: DataFrame,
    clients: DataFrame,
    key: str = "client_id",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The same join with clients broadcast, if they are small enough."""
    return transactions.join(broadcast_within(clients, broadcast_limit, always_hint=True), key)


def label_mcc(
    transactions: DataFrame,
    mcc_labels: DataFrame,
    key: str = "mcc",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Left join of a label table on the category code."""
    return transactions.join(broadcast_within(mcc_labels, broadcast_limit), key, "left")


def enrich_left(
    transactions: DataFrame,
    clients: DataFrame,
    fraud_info: DataFrame,
    client_key: str = "client_id",
    transaction_key: str = "transaction_id",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Add client and fraud columns and keep every transaction.

    Fraud rows have the grain of transactions: they are joined first, while rows are narrow.
    """
    order = [
        client_key,
        transaction_key,
        *(c for c in transactions.columns if c not in (client_key, transaction_key)),
        *(c for c in clients.columns if c != client_key),
        *(c for c in fraud_info.columns if c != transaction_key),
    ]
    joined = transactions.join(fraud_info, transaction_key, "left")
    joined = joined.join(broadcast_within(clients, broadcast_limit), client_key, "left")
    return joined.select(*order)
