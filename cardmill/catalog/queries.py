"""Every query and operator over the given tables, by key: ``(spark, folder) -> DataFrame``.

Operators that write return what was read back.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardmill.catalog import staging
from cardmill.catalog.sample import DAY, YEAR, Sample
from cardmill.functions.hashing import hash_split, random_split
from cardmill.functions.money import exact_sum
from cardmill.ml import features, training
from cardmill.operators import analytics, cleaning, enrich, filters, paging, sizing
from cardmill.operators.rows import split_rows, with_row_index
from cardmill.plans import jobs, marts
from cardmill.schemas import PARTITION_COLUMNS, table_schema
from cardmill.session import JobPaths, materialize, scratch_path
from cardmill.sinks import files as file_sinks
from cardmill.sinks import tables as table_sinks
from cardmill.sources import readers
from cardmill.sources.json_arrays import read_json_array
from cardmill.streaming.ingest import ingest_new_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
    """Register a function of the sample under its own name."""
    QUERIES[function.__name__] = lambda spark, folder: function(_sample(spark, folder))
    return function


def _sample(spark: SparkSession, folder: str) -> Sample:
    """The sample tables, with shuffles sized for their largest."""
    sizing.size_shuffles(spark, sizing.path_bytes(spark, f"{folder}/orders.parquet"))
    return Sample(spark, folder)


def new_database(spark: SparkSession, label: str) -> str:
    """A catalog database of this application, located in the shared folder."""
    name = "cardmill_" + re.sub(r"\W", "_", f"{label}_{spark.sparkContext.applicationId}".lower())
    table_sinks.create_database(spark, name, scratch_path(spark, name))
    return name


def _wide(df: DataFrame, key: str) -> DataFrame:
    """Inference makes a key INT or BIGINT, by the size of the table; this makes it BIGINT."""
    return df.withColumn(key, F.col(key).cast("bigint"))


# Scans


@query
def csv_scan_schema(s: Sample) -> DataFrame:
    path = staging.write_csv(s.transactions(), scratch_path(s.spark, "csv"))
    return readers.read_csv(s.spark, path, table_schema("transactions_data"))


@query
def csv_scan_inferred(s: Sample) -> DataFrame:
    rows = readers.read_csv(s.spark, staging.write_csv(s.users(), scratch_path(s.spark, "csv")))
    return _wide(rows, "id")


@query
def json_scan_schema(s: Sample) -> DataFrame:
    files = staging.write_json_arrays(s.mcc(), scratch_path(s.spark, "json"))
    return readers.read_json(s.spark, files, table_schema("mcc_codes"))


@query
def json_array_split(s: Sample) -> DataFrame:
    """All transactions in large arrays, a file each, read by as many tasks as their size allows."""
    odd = F.concat_ws("", F.lit('say "'), "use_chip", F.lit('" }, {[ \\'), "id", F.lit("]\t\\"))
    place = F.struct("merchant_city", F.array("merchant_id", "mcc").alias("codes"))
    rows = s.transactions().select("id", "amount", "errors", odd.alias("note"), place.alias("place"))
    files = staging.write_json_array_files(rows, scratch_path(s.spark, "json-array"), "id")
    schema = "id bigint, amount string, errors string, note string, place struct<merchant_city: string, codes: array<bigint>>"
    read = read_json_array(s.spark, files, schema)
    return read.select("id", "amount", "errors", "note", "place.merchant_city", F.col("place.codes")[1].alias("mcc"))


@query
def json_lines_scan(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "json")
    s.labels().write.json(path)
    return readers.read_json(s.spark, path, table_schema("train_fraud_labels"), multi_line=False)


@query
def json_map_to_rows(s: Sample) -> DataFrame:
    path = staging.write_json_objects(s.mcc(), scratch_path(s.spark, "map"), "id", "item")
    return readers.read_json_map(s.spark, path, whole_file=False)


@query
def parquet_scan_schema(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "labels")
    file_sinks.write_parquet(cleaning.stamp_ingestion(s.labels(), DAY), path)
    return readers.read_parquet(s.spark, path, table_schema("train_fraud_labels"))


@query
def latest_partition(s: Sample) -> DataFrame:
    """Each kind of transaction arrives on a day of its own."""
    path = scratch_path(s.spark, "days")
    days = {"Online": date(2025, 4, 30), "Swipe": date(2025, 5, 1), "Chip": DAY}
    for kind, day in days.items():
        arrived = s.transactions().where(F.col("use_chip") == f"{kind} Transaction")
        part = cleaning.stamp_ingestion_partition(arrived, day)
        file_sinks.write_parquet(part, path, "append", PARTITION_COLUMNS)
    return readers.read_parquet(s.spark, path, latest_only=True)


@query
def sql_scan(s: Sample) -> DataFrame:
    s.users().createOrReplaceTempView("cardmill_users")
    return readers.read_sql(
        s.spark,
        "SELECT gender, current_age, count(*) AS n_clients, max(credit_score) AS best_score "
        "FROM cardmill_users WHERE num_credit_cards >= 3 GROUP BY gender, current_age",
    )


def _source_folder(s: Sample, tables: tuple[str, ...]) -> str:
    """CSV and JSON tables, and one file that no reader handles."""
    folder = scratch_path(s.spark, "source")
    for table in tables:
        if table == "mcc_codes":
            s.mcc().write.json(f"{folder}/{table}.json")
        else:
            staging.write_csv(s.table(table), f"{folder}/{table}.csv")
    s.raw("region").select("r_name").write.text(f"{folder}/notes.txt")
    return folder


@query
def ingest_directory(s: Sample) -> DataFrame:
    details = {
        "cards_data": "card_number",
        "users_data": "address",
        "mcc_codes": "item",
        "train_fraud_labels": "info",
    }
    raw = scratch_path(s.spark, "raw")
    paths = JobPaths(_source_folder(s, tuple(details)), raw, raw)
    done, _ = jobs.bronze_from_files(s.spark, paths, DAY, datasets=True, multi_line=False)
    rows = [
        readers.read_parquet(s.spark, paths.raw_table(name)).select(
            F.lit(name).alias("table_name"),
            F.col("id").cast("string").alias("id"),
            F.col(details[name]).alias("detail"),
            "ingestion_date",
        )
        for name in done
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query
def split_csv_parts(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "split")
    file_sinks.write_split_csv(s.transactions(), path, 4, ["id"])
    rows = s.spark.read.schema(table_schema("transactions_data").add("part", "integer"))
    return rows.option("header", True).csv(path)


@query
def split_two_files(s: Sample) -> DataFrame:
    """Two deliveries of unequal size, the larger one in as many files as it needs, split in file and line order."""
    path = scratch_path(s.spark, "two-files")
    labels = s.labels()
    for name, rows in (("a", labels.where("id <= 100")), ("b", labels.where("id > 100"))):
        # Files are numbered in the order of the sort.
        rows.orderBy("id").write.parquet(f"{path}/{name}")
    stored = s.spark.read.schema(labels.schema).option("recursiveFileLookup", True).parquet(path)
    return split_rows(stored, 5)


@query
def wide_key_run(s: Sample) -> DataFrame:
    """Keys beyond INT through the bronze run, with all its defaults."""
    folder, raw = scratch_path(s.spark, "wide"), scratch_path(s.spark, "raw")
    far = s.labels().withColumn("id", F.col("id") + 3_000_000_000)
    staging.write_csv(far, f"{folder}/train_fraud_labels.csv")
    jobs.bronze_from_files(s.spark, JobPaths(folder, raw, raw), DAY, datasets=True)
    return readers.read_parquet(s.spark, f"{raw}/train_fraud_labels")


@query
def row_positions(s: Sample) -> DataFrame:
    rows = s.transactions().select("id", "client_id")
    return with_row_index(rows, ["client_id", "id"])


# Cleaning


@query
def clean_transactions(s: Sample) -> DataFrame:
    raw = s.transactions().withColumn("date", F.date_format("date", cleaning.TIMESTAMP_FORMAT))
    return cleaning.clean_transactions(raw)


@query
def clean_cards(s: Sample) -> DataFrame:
    return cleaning.clean_cards(s.cards())


@query
def clean_users(s: Sample) -> DataFrame:
    return cleaning.clean_users(s.users())


# Joins


@query
def enrich_transactions(s: Sample) -> DataFrame:
    return s.processed()


@query
def enrich_mcc_left(s: Sample) -> DataFrame:
    return enrich.add_mcc(s.transactions(), s.mcc()).select("id", "mcc", "item")


@query
def enrich_inner_users(s: Sample) -> DataFrame:
    return enrich.add_users(s.transactions(), s.users()).select("id", "client_id", "current_age", "gender")


@query
def enrich_inner_cards(s: Sample) -> DataFrame:
    joined = enrich.add_cards(s.transactions(), s.cards())
    return joined.select("id", "client_id", "card_id", "card_brand", "card_number")


@query
def enrich_inner_labels(s: Sample) -> DataFrame:
    return enrich.add_labels(s.transactions(), s.labels()).select("id", "amount", "info")


# Marts


def _mart(name: str, s: Sample) -> DataFrame:
    """A mart over lazily built silver frames instead of catalog tables."""
    silver = {
        "transactions_data_processed": s.processed,
        "transactions_data_cleaned": lambda: cleaning.clean_transactions(s.transactions()),
        "cards_data_cleaned": lambda: cleaning.clean_cards(s.cards()),
        "users_data_cleaned": lambda: cleaning.clean_users(s.users()),
        "mcc_codes": s.mcc,
        "train_fraud_labels": s.labels,
    }
    table, mart = marts.MARTS[name]
    return mart(silver[table]())


MART_KEYS = {
    "mart_validated": "transaction_validated",
    "mart_refused": "transaction_refused",
    "mart_top10": "top_10_consu",
    "mart_kpi": "kpi_by_consu_id",
    "mart_passthrough_cards": "cards_data",
    "mart_passthrough_mcc": "mcc_codes",
    "mart_passthrough_labels": "train_fraud_labels",
    "mart_passthrough_transactions": "transactions_data",
    "mart_passthrough_processed": "transactions_data_processed",
    "mart_passthrough_users": "users_data",
}
for _key, _name in MART_KEYS.items():
    QUERIES[_key] = lambda spark, folder, name=_name: _mart(name, _sample(spark, folder))


# Served reads


@query
def page_fraud(s: Sample) -> DataFrame:
    return paging.fraud_page(s.labels(), page=2)


@query
def page_legit(s: Sample) -> DataFrame:
    return paging.legit_page(marts.transaction_validated(s.processed()), page=3)


@query
def page_clients(s: Sample) -> DataFrame:
    return paging.client_page(cleaning.clean_users(s.users()), page=3)


@query
def page_deep(s: Sample) -> DataFrame:
    return paging.paginate(s.labels(), ["id desc"], page=4, size=300)


@query
def page_ties(s: Sample) -> DataFrame:
    """First, middle and last pages of an order with many equal keys."""
    rows = s.transactions().select("client_id", "use_chip", "id", "amount")
    pages = [paging.paginate(rows, ["use_chip", "client_id desc"], page, 250) for page in (1, 3, 6)]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


@query
def page_keyset(s: Sample) -> DataFrame:
    return paging.keyset_page(s.labels(), "id", after=500, size=50)


@query
def page_records(s: Sample) -> DataFrame:
    return paging.records(paging.fraud_page(s.labels()))


# Analytics


@query
def q1_last_90_days(s: Sample) -> DataFrame:
    return analytics.count_last_days(s.spending())


@query
def q1_cache_comparison(s: Sample) -> DataFrame:
    recent = analytics.last_days(s.spending(), "transaction_date", 90)
    return sizing.compare_cached(recent).drop("seconds")


@query
def q2_join_clients(s: Sample) -> DataFrame:
    return enrich.with_clients(s.transactions(), s.clients())


@query
def q2_join_broadcast(s: Sample) -> DataFrame:
    return enrich.with_clients_broadcast(s.transactions(), s.clients())


@query
def q2_compare_variants(s: Sample) -> DataFrame:
    transactions, clients = s.transactions(), s.clients()
    variants = {
        "no_optimization": enrich.with_clients(transactions, clients),
        "broadcast_optimization": enrich.with_clients_broadcast(transactions, clients),
    }
    return sizing.compare_variants(s.spark, variants).drop("seconds")


@query
def q3_mcc_labels(s: Sample) -> DataFrame:
    labels = s.mcc().select(F.col("id").cast("bigint").alias("mcc"), "item")
    return enrich.label_mcc(s.transactions(), labels)


def _fraud_view(s: Sample, which: int) -> DataFrame:
    names = ("cardmill_fraud_transactions", "cardmill_non_fraud_transactions")
    filters.create_fraud_views(s.spending(labelled=True), "is_fraud", *names)
    return s.spark.table(names[which])


@query
def q4_fraud_view(s: Sample) -> DataFrame:
    return _fraud_view(s, 0)


@query
def q4_non_fraud_view(s: Sample) -> DataFrame:
    return _fraud_view(s, 1)


@query
def q5_enrich_save(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "enriched")
    fraud_info = s.labels().select(
        F.col("id").alias("transaction_id"), (F.col("info") == "Yes").alias("is_fraud")
    )
    transactions = s.transactions().withColumnsRenamed({"id": "transaction_id", "date": "transaction_date"})
    file_sinks.write_enriched(transactions, s.clients(), fraud_info, path)
    return readers.read_parquet(s.spark, path)


@query
def q6_top10_year(s: Sample) -> DataFrame:
    database = new_database(s.spark, "q6")
    name = table_sinks.save_top_clients(s.spending(), database, scratch_path(s.spark, "top10"), YEAR)
    return s.spark.table(name)


@query
def q7_top3_per_month(s: Sample) -> DataFrame:
    return analytics.top_clients_per_month(s.spending(), YEAR, rank_col="rnk")


@query
def q8_client_metrics(s: Sample) -> DataFrame:
    return analytics.client_metrics(s.spending(), YEAR)


@query
def q8_best_month(s: Sample) -> DataFrame:
    return analytics.best_month(s.spending(), YEAR)


@query
def monthly_totals(s: Sample) -> DataFrame:
    return analytics.monthly_totals(s.spending(), YEAR)


@query
def q9_fraud_models(s: Sample) -> DataFrame:
    rows = s.processed().select(
        F.col("id").alias("transaction_id"),
        (F.col("info") == "Yes").alias("is_fraud"),
        "amount",
        "credit_score",
        "current_age",
    )
    found = []
    for model, predictions in training.score_fraud_models(rows, ["amount", "credit_score", "current_age"]).items():
        # The evaluator takes its curve from raw predictions, at up to a thousand thresholds; the ranks are exact.
        area = training.area_under_roc(predictions, "label")
        scores = materialize(predictions.select("label", vector_to_array("probability")[1].alias("score")), "scores")
        exact = training.auc_frame(scores, "label").first()["auc"]
        found.append((model, scores.count(), abs(area - exact) < 0.005))
    return s.spark.createDataFrame(found, "model string, n_test bigint, auc_agrees boolean")


@query
def q10_by_month(s: Sample) -> DataFrame:
    target = file_sinks.write_by_month(s.spending(), scratch_path(s.spark, "months"))
    return readers.read_parquet(s.spark, target)


@query
def q11_avg_by_type(s: Sample) -> DataFrame:
    return analytics.average_by_type(s.spending())


@query
def q12_five_files(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "metrics")
    file_sinks.write_n_files(analytics.client_metrics(s.spending(), YEAR), path)
    files = s.spark.read.parquet(path).select(F.count_distinct("_metadata.file_path").alias("n"))
    return readers.read_parquet(s.spark, path).withColumn("n_files", files.scalar())


# Partitioning


@query
def partitions_for(s: Sample) -> DataFrame:
    sizes = s.raw("documents").groupBy("source").agg(F.sum(F.octet_length("text")).alias("n_bytes"))
    return sizes.withColumn("n_partitions", sizing.partitions_for_column("n_bytes", 1))


@query
def size_repartition(s: Sample) -> DataFrame:
    path = f"{s.folder}/orders.parquet"
    spread = sizing.repartition_by_size(s.raw("orders"), path, 1)
    # Whole MiB, rounded up: what the repartition promises.
    wanted = -(-sizing.path_bytes(s.spark, path) // sizing.MIB)
    return spread.withColumn("as_promised", F.lit(spread.rdd.getNumPartitions() == wanted))


@query
def split_rows_input_order(s: Sample) -> DataFrame:
    parts = split_rows(s.labels().select("id"), 7).groupBy("part")
    return parts.agg(F.count(F.lit(1)).alias("n_rows"))


# Machine learning


def _split_frame(df: DataFrame, key: str, percents: tuple[int, ...], seed: int) -> DataFrame:
    train, test = hash_split(df, key, percents, seed)
    return train.withColumn("subset", F.lit("train")).unionByName(test.withColumn("subset", F.lit("test")))


@query
def hash_split_80_20(s: Sample) -> DataFrame:
    return _split_frame(s.labels(), "id", (80, 20), 42)


@query
def hash_split_70_30(s: Sample) -> DataFrame:
    return _split_frame(s.labels(), "id", (70, 30), 42)


@query
def random_split_sizes(s: Sample) -> DataFrame:
    """All rows, each in one subset, and whether the subsets have about the shares asked for."""
    stored = materialize(s.labels(), "random-split")
    train, test = random_split(stored)
    share = F.lit(train.count() / max(stored.count(), 1)).between(0.7, 0.9)
    return train.unionByName(test).withColumn("near_80_percent", share)


@query
def nonempty_guard(s: Sample) -> DataFrame:
    """The two subsets that the guard lets through, and that it stops an empty one."""
    train, test = training.train_test(s.labels(), "id")
    try:
        filters.require_rows(s.labels().where("id < 0"), "training set")
        stopped = False
    except ValueError:
        stopped = True
    rows = train.withColumn("subset", F.lit("train")).unionByName(test.withColumn("subset", F.lit("test")))
    return rows.withColumn("empty_is_stopped", F.lit(stopped))


@query
def ml_calendar_features(s: Sample) -> DataFrame:
    rows = features.calendar_features(s.processed())
    return rows.select("id", "amount", *features.CALENDAR_FEATURES)


@query
def ml_amount_features(s: Sample) -> DataFrame:
    plain = [c for c in features.AMOUNT_FEATURES if not c.endswith("_index")]
    return features.amount_features(s.processed()).select("id", "amount", *plain, *features.AMOUNT_STRINGS)


@query
def ml_brand_features(s: Sample) -> DataFrame:
    return features.brand_features(s.cards()).select("id", *features.BRAND_FEATURES)


@query
def ml_index_mapping(s: Sample) -> DataFrame:
    return features.index_mapping(s.cards(), "card_brand")


@query
def ml_rmse(s: Sample) -> DataFrame:
    guesses = s.processed().select("amount_exact", (F.col("credit_score") * 400).alias("prediction"))
    return training.rmse_frame(guesses, "amount_exact")


@query
def ml_accuracy(s: Sample) -> DataFrame:
    prefix = features.brand_features(s.cards())
    guess = F.when(F.col("prefix1") == 3, "Visa").when(F.col("prefix1") == 5, "Amex").otherwise("Discover")
    return training.accuracy_frame(prefix.withColumn("prediction", guess), "card_brand")


def _checked(model, predictions: DataFrame, rmse: float, rows: DataFrame) -> DataFrame:
    """Test rows by id, whether each has a prediction, and whether the model fits the rows it was trained on.

    On rows that it has not seen a model of unrelated amounts may be worse than their mean, on its own it may not.
    """
    train, _ = hash_split(rows, "id")
    fits = training.beats_mean(model.transform(train), "amount").first()[0]
    return predictions.select(
        "id", F.col("prediction").isNotNull().alias("predicted"), F.lit(bool(fits) and rmse >= 0).alias("fits")
    )


@query
def ml_calendar_gbt(s: Sample) -> DataFrame:
    return _checked(*training.train_calendar_amount_model(s.processed()), features.calendar_features(s.processed()))


@query
def ml_amount_gbt(s: Sample) -> DataFrame:
    known = features.amount_features(s.processed()).where(F.col("amount").isNotNull())
    return _checked(*training.train_amount_model(s.processed()), known)


@query
def ml_brand_rf(s: Sample) -> DataFrame:
    _, predictions, _ = training.train_brand_classifier(s.cards())
    return predictions.select("id", "card_brand", "predicted_brand")


@query
def ml_auc(s: Sample) -> DataFrame:
    scores = s.processed().select((F.col("info") == "Yes").alias("label"), F.col("credit_score").alias("score"))
    return training.auc_frame(scores, "label")


@query
def ml_training_run(s: Sample) -> DataFrame:
    """The training run over the silver table of a whole run: its rows, and its error beside that of its predictions."""
    paths, _ = _run_layers(s)
    _, predictions, error = training.training_run(s.spark, paths.database)
    predictions = materialize(predictions.select("amount", "prediction"), "predictions")
    again = training.rmse_frame(predictions, "amount").first()["rmse"]
    processed = s.spark.table(f"{paths.database}.transactions_data_processed")
    rows = processed.agg(F.count(F.lit(1)).alias("n_rows"), F.count("amount").alias("n_amounts"))
    agrees = F.lit(abs(error - again) <= 1e-6 * error)
    return rows.withColumns({"n_test": F.lit(predictions.count()).cast("bigint"), "error_agrees": agrees})


# Layer runs


@query
def parquet_round_trip(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "cards")
    file_sinks.write_parquet(cleaning.clean_cards(s.cards()), path, partition_by=["card_brand"])
    return readers.read_parquet(s.spark, path)


@query
def table_round_trip(s: Sample) -> DataFrame:
    database = new_database(s.spark, "tables")
    table_sinks.drop_table(s.spark, database, "users")
    users = cleaning.stamp_ingestion(cleaning.clean_users(s.users()), DAY)
    path = scratch_path(s.spark, "users")
    table_sinks.create_table(s.spark, database, "users", users.schema, path, ["ingestion_date"])
    table_sinks.write_table(users, database, "users", path, ["ingestion_date"])
    return s.spark.table(f"{database}.users")


@query
def bronze_incremental(s: Sample) -> DataFrame:
    """Each label arrives on a day of its own; the second day is run twice."""
    raw = scratch_path(s.spark, "raw")
    paths = JobPaths(raw, raw, raw)
    max_files = max(10, sizing.partitions_for(sizing.path_bytes(s.spark, f"{s.folder}/orders.parquet")))
    for info, day in (("No", date(2025, 5, 21)), ("Yes", DAY), ("Yes", DAY)):
        arrived = filters.by_label(s.labels(), info)
        jobs.bronze_from_tables(
            s.spark, lambda _, __: arrived, paths, ["train_fraud_labels"], day, max_files=max_files
        )
    return readers.read_parquet(s.spark, paths.raw_table("train_fraud_labels"))


@query
def bronze_new_files(s: Sample) -> DataFrame:
    """Each label arrives in files of its own; the last run finds nothing new."""
    folder = scratch_path(s.spark, "arrivals")
    target, checkpoint = scratch_path(s.spark, "bronze"), scratch_path(s.spark, "progress")
    schema = table_schema("train_fraud_labels")
    for info, runs in (("No", 1), ("Yes", 2)):
        arrived = filters.by_label(s.labels(), info)
        arrived.write.mode("append").option("header", True).csv(folder)
        for _ in range(runs):
            ingest_new_files(s.spark, folder, schema, target, checkpoint, DAY)
    return readers.read_parquet(s.spark, target)


def _run_layers(s: Sample) -> tuple[JobPaths, Callable[[str], str]]:
    """The whole run over files, with Parquet folders in place of the relational store."""
    spark = s.spark
    landing = scratch_path(spark, "landing-files")
    staging.write_csv(s.transactions(), f"{landing}/transactions_data.csv")
    source = _source_folder(s, ("cards_data", "users_data", "mcc_codes", "train_fraud_labels"))
    store, mart_store = scratch_path(spark, "store"), scratch_path(spark, "marts")
    database = new_database(spark, "layers")
    paths = JobPaths(source, scratch_path(spark, "raw"), scratch_path(spark, "warehouse"), database)
    jobs.run_all(
        spark,
        paths,
        landing,
        read_landing=lambda session, table: session.read.parquet(f"{store}/{table}"),
        write_landing=lambda rows, table: rows.write.mode("append").parquet(f"{store}/{table}"),
        write_mart=lambda rows, table: rows.write.mode("overwrite").parquet(f"{mart_store}/{table}"),
        as_of=DAY,
        datasets=True,
        multi_line=False,
    )
    return paths, lambda table: f"{mart_store}/{table}"


@query
def bronze_silver_gold(s: Sample) -> DataFrame:
    _, mart_path = _run_layers(s)
    return _wide(readers.read_parquet(s.spark, mart_path("kpi_by_consu_id")), "client_id")


@query
def files_to_tables(s: Sample) -> DataFrame:
    """Files -> named tables with inferred types."""
    store = scratch_path(s.spark, "store")
    folder = _source_folder(s, ("users_data", "cards_data"))
    done, _ = jobs.load_files(
        s.spark, folder, lambda rows, t: rows.write.mode("append").parquet(f"{store}/{t}"), datasets=True
    )
    users, cards = (s.spark.read.parquet(f"{store}/{name}") for name in reversed(done))
    spending = cards.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("n_cards"), exact_sum(F.translate("credit_limit", "$", "")).alias("limits")
    )
    joined = users.join(spending, users["id"] == spending["client_id"], "left")
    return _wide(joined.select("id", "yearly_income", "n_cards", "limits"), "id")
