"""Physical plans: what must be in them and what must not."""

import glob

import pytest
from compare import SF
from plans import plan, scan_rows, scans
from pyspark.sql import functions as F

from cardmill.catalog.queries import QUERIES
from cardmill.functions.calendar import in_year, last_days
from cardmill.operators import analytics
from cardmill.plans import jobs, marts
from cardmill.sinks.files import write_parquet

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonRDD", "MapIn")
LAZY = [
    "clean_transactions", "enrich_transactions", "enrich_mcc_left", "enrich_inner_labels", "mart_validated",
    "mart_top10", "mart_kpi", "mart_passthrough_processed", "page_fraud", "page_legit", "page_deep", "page_keyset",
    "q1_last_90_days", "q2_join_clients", "q2_join_broadcast", "q3_mcc_labels", "q4_fraud_view", "q7_top3_per_month",
    "q8_client_metrics", "q8_best_month", "monthly_totals", "q11_avg_by_type", "partitions_for", "hash_split_80_20",
    "ml_calendar_features", "ml_amount_features", "ml_brand_features", "ml_rmse", "row_positions", "split_csv_parts",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not [word for word in FORBIDDEN if word in text]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Transactions as the silver layer stores them, in date order over several row groups."""
    path = str(tmp_path_factory.mktemp("silver")) + "/t"
    stamp = F.timestamp_seconds(F.lit(1262304000) + F.col("id") * 600)
    rows = spark.range(0, 120_000, 1, 12).select(
        F.col("id").alias("transaction_id"), stamp.alias("transaction_date"), (F.col("id") % 900).alias("client_id"),
        F.rand(3).cast("float").alias("amount"), F.lit("x").alias("unused"),
    )
    write_parquet(rows, path)
    return spark.read.parquet(path)


def test_year_reaches_the_scan(table):
    text = scans(table.where(in_year("transaction_date", 2010)))
    assert "GreaterThanOrEqual(transaction_date,2010-01-01" in text
    assert "LessThan(transaction_date,2011-01-01" in text


def test_aggregates_read_only_their_columns(table):
    metrics = analytics.client_metrics(table)
    assert "ReadSchema: struct<transaction_date:timestamp,client_id:bigint,amount:float>" in scans(metrics)
    text = plan(metrics)
    assert text.count("Exchange") == 1
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_newest_days_skip_row_groups(spark, table):
    """The cutoff of the subquery is pushed into the scan at run time, so only late rows are read."""
    counted = last_days(table, "transaction_date", 90).groupBy().count()
    newest = table.agg(F.max("transaction_date").alias("d")).first().d
    expected = table.where(F.col("transaction_date") >= F.date_sub(F.lit(newest), 90)).count()
    assert counted.collect()[0][0] == expected
    assert min(scan_rows(counted)) < 40_000


def test_top_k_shapes(sample, table):
    assert "TakeOrderedAndProject" in plan(analytics.top_clients(table))
    assert "TakeOrderedAndProject" in plan(marts.top_consumers(sample.processed()))
    text = plan(analytics.top_clients_per_month(table))
    assert text.count("WindowGroupLimit") == 2


def test_partial_aggregation_before_every_shuffle(sample):
    text = plan(marts.client_kpis(sample.processed()))
    assert "partial_count(amount" in text and "partial_sum(" in text


def test_shallow_page_has_no_full_sort(spark):
    text = plan(QUERIES["page_fraud"](spark, SF))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_average_by_type_shuffles_once(spark):
    assert plan(QUERIES["q11_avg_by_type"](spark, SF)).count("Exchange hashpartitioning") == 1


def test_label_marts_read_their_partition(spark, sample, folder):
    path = folder + "/processed"
    write_parquet(sample.processed(), path, partition_by=["info"])
    stored = spark.read.parquet(path)
    for mart, label in ((marts.transaction_validated, "Yes"), (marts.transaction_refused, "No")):
        assert "(info#" in scans(mart(stored)) and f" = {label})" in scans(mart(stored)).split("PartitionFilters")[1].split("\n")[0]


def test_both_aggregated_marts_come_from_one_scan(spark, sample, folder):
    """The two marts of a standard run read the copy of the KPIs, not the processed table."""
    write_parquet(sample.processed(), folder + "/processed")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS one_scan LOCATION '{folder}/db'")
    spark.sql(f"CREATE TABLE one_scan.transactions_data_processed USING parquet LOCATION '{folder}/processed'")
    inputs = {}

    def write(rows, name):
        inputs[name] = rows.inputFiles()
        rows.count()

    chosen = {k: marts.marts("one_scan")[k] for k in (marts.KPI_MART, marts.TOP_MART)}
    jobs.run_marts(spark, write, "one_scan", chosen)
    assert inputs[marts.KPI_MART] == inputs[marts.TOP_MART]
    assert not any("/processed/" in f for files in inputs.values() for f in files)
    assert not glob.glob(inputs[marts.KPI_MART][0].removeprefix("file:"))
    spark.sql("DROP DATABASE one_scan CASCADE")
