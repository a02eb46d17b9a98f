import glob
import json
import os
import threading
from collections import Counter
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cardmill.catalog.sample import Sample
from cardmill.operators.cleaning import stamp_ingestion_partition
from cardmill.plans import jobs, marts, served
from cardmill.schemas import PARTITION_COLUMNS, table_schema
from cardmill.session import JobPaths, timestamp_statistics
from cardmill.sinks import files, tables
from cardmill.sources.readers import read_parquet
from cardmill.streaming.ingest import ingest_new_files
from compare import SF


def part_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_partition_folders_and_modes(spark, folder):
    rows = spark.range(6).withColumn("k", F.col("id") % 2)
    files.write_parquet(rows, folder + "/t", partition_by=["k"])
    assert sorted(n for n in os.listdir(folder + "/t") if "=" in n) == ["k=0", "k=1"]
    files.write_parquet(rows, folder + "/t", "append", ["k"])
    assert read_parquet(spark, folder + "/t").count() == 12
    files.write_parquet(rows, folder + "/t", partition_by=["k"])
    assert read_parquet(spark, folder + "/t").count() == 6


def test_repeated_day_is_replaced(spark, folder):
    def run(day, n):
        files.write_parquet(
            stamp_ingestion_partition(spark.range(n), day), folder + "/t",
            partition_by=PARTITION_COLUMNS, replace_partitions=True,
        )

    run(date(2025, 5, 1), 3)
    run(date(2025, 5, 2), 4)
    run(date(2025, 5, 2), 5)
    got = Counter(r.ingestion_date for r in read_parquet(spark, folder + "/t").collect())
    assert got == {date(2025, 5, 1): 3, date(2025, 5, 2): 5}


def test_append_adds_again(spark, folder):
    paths = JobPaths(folder, folder, folder)
    for _ in range(2):
        jobs.bronze_from_tables(spark, lambda s, t: s.range(3), paths, ["t"], date(2025, 5, 1), append=True)
    assert read_parquet(spark, folder + "/t").count() == 6


def test_months(spark, folder):
    dates = [datetime(2010, 1, 5), datetime(2011, 1, 6), datetime(2010, 12, 31)]
    rows = spark.createDataFrame([(d,) for d in dates], "transaction_date timestamp")
    target = files.write_by_month(rows, folder)
    assert target == folder + "/bronze_transactions_by_month"
    assert sorted(n for n in os.listdir(target) if "=" in n) == ["month=1", "month=12"]
    assert read_parquet(spark, target).where("month = 1").count() == 2
    by_year = files.write_by_month(rows, folder, subfolder="y", with_year=True)
    assert sorted(n for n in os.listdir(by_year) if "=" in n) == ["year=2010", "year=2011"]


def test_large_month_is_written_by_several_tasks(spark, conf, folder):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="200000")
    day = F.when(F.col("id") % 3 == 0, F.lit("2010-02-01")).otherwise(F.lit("2010-03-01"))
    rows = spark.range(0, 200_000, 1, 8).select(day.cast("timestamp").alias("transaction_date"), F.rand(1).alias("x"))
    target = files.write_by_month(rows, folder)
    assert len(part_files(target + "/month=3")) > 1
    assert read_parquet(spark, target).count() == 200_000


def test_five_files(spark, folder):
    files.write_n_files(spark.range(100), folder + "/t")
    assert len(part_files(folder + "/t")) == 5
    assert read_parquet(spark, folder + "/t").count() == 100


def test_split_csv_has_headers(spark, folder):
    rows = spark.createDataFrame([(i, f"r{i}") for i in range(10)], "id int, t string").repartition(3)
    files.write_split_csv(rows, folder + "/t", 4, ["id"])
    got = {}
    for name in (n for n in os.listdir(folder + "/t") if "=" in n):
        lines = []
        for file in sorted(f for f in os.listdir(f"{folder}/t/{name}") if f.startswith("part-")):
            with open(f"{folder}/t/{name}/{file}", encoding="utf-8") as f:
                header, *body = f.read().splitlines()
            assert header == "id,t"
            lines += body
        got[name] = lines
    assert {n: len(v) for n, v in got.items()} == {"part=1": 3, "part=2": 3, "part=3": 2, "part=4": 2}
    assert got["part=2"] == ["3,r3", "4,r4", "5,r5"]


def test_split_keeps_the_order_of_a_file(spark, folder):
    with open(folder + "/in.csv", "w", encoding="utf-8") as f:
        f.write("v\n" + "\n".join(str(i * 7919 % 1000) for i in range(1000)))
    rows = spark.read.option("header", True).option("maxPartitionBytes", 500).csv(folder + "/in.csv")
    files.write_split_csv(rows, folder + "/t", 3)
    got = [int(r.v) for r in spark.read.option("header", True).csv(folder + "/t/part=1").collect()]
    assert sorted(got) == sorted(i * 7919 % 1000 for i in range(334))


def test_catalog_tables(spark, folder):
    tables.create_database(spark, "sinks_test", folder + "/db")
    schema = table_schema("mcc_codes", ingestion=True)
    tables.create_table(spark, "sinks_test", "m", schema, folder + "/m", ["ingestion_date"])
    described = spark.sql("DESCRIBE sinks_test.m").collect()
    assert "# Partition Information" in [r.col_name for r in described]
    rows = spark.createDataFrame([("1", "a", date(2025, 5, 1))], schema)
    tables.write_table(rows, "sinks_test", "m", folder + "/m", ["ingestion_date"])
    assert [tuple(r) for r in spark.table("sinks_test.m").collect()] == [("1", "a", date(2025, 5, 1))]
    tables.write_table(rows.drop("item"), "sinks_test", "m", folder + "/m2")
    assert spark.table("sinks_test.m").columns == ["id", "ingestion_date"]
    tables.drop_table(spark, "sinks_test", "m")
    assert not spark.catalog.tableExists("sinks_test.m")


def test_top_clients_table(spark, folder):
    tables.create_database(spark, "sinks_test", folder + "/db")
    rows = spark.createDataFrame(
        [(1, datetime(2010, 1, 1), 5.0), (2, datetime(2010, 1, 1), 6.0)],
        "client_id int, transaction_date timestamp, amount float",
    )
    name = tables.save_top_clients(rows, "sinks_test", folder + "/top")
    assert name == "sinks_test.top10_clients_2010"
    assert [r.client_id for r in spark.table(name).orderBy("total_spent").collect()] == [1, 2]


def test_stream_takes_each_file_once(spark, folder):
    schema = table_schema("train_fraud_labels")
    args = (spark, folder + "/in", schema, folder + "/out", folder + "/progress", date(2025, 5, 1))
    spark.createDataFrame([(1, "Yes")], schema).write.option("header", True).csv(folder + "/in")
    ingest_new_files(*args)
    ingest_new_files(*args)
    spark.createDataFrame([(2, "No")], schema).write.mode("append").option("header", True).csv(folder + "/in")
    ingest_new_files(*args)
    got = read_parquet(spark, folder + "/out").collect()
    assert sorted((r.id, r.info, r.year, r.month, r.day) for r in got) == [(1, "Yes", 2025, 5, 1), (2, "No", 2025, 5, 1)]


def test_overlapping_writes_keep_statistics(spark, folder):
    """In a plain session two writers overlap: both files hold microseconds and the session's option comes back."""
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, "INT96")
    try:
        inside, leave = threading.Event(), threading.Event()

        def slow():
            with timestamp_statistics(spark):
                inside.set()
                leave.wait(30)
                files.write_parquet(spark.range(3).select(F.current_timestamp().alias("t")), folder + "/slow")

        thread = threading.Thread(target=slow)
        thread.start()
        inside.wait(30)
        files.write_parquet(spark.range(3).select(F.current_timestamp().alias("t")), folder + "/quick")
        assert spark.conf.get(key) == "TIMESTAMP_MICROS"
        leave.set()
        thread.join()
        assert spark.conf.get(key) == "INT96"
    finally:
        spark.conf.set(key, before)
    for name in ("slow", "quick"):
        part = glob.glob(f"{folder}/{name}/part-*.parquet")[0]
        assert pq.ParquetFile(part).schema.column(0).physical_type == "INT64"


def test_a_failing_job_is_not_hidden():
    done = []

    def fail():
        raise RuntimeError("no space")

    with pytest.raises(RuntimeError, match="no space"):
        jobs.run_together([lambda: done.append(1), fail, lambda: done.append(2)], parallel=2)
    assert sorted(done) == [1, 2]


def test_whole_run(spark, folder):
    """Plain single files as sources, default schemas, the relational store replaced by folders."""
    sample = Sample(spark, SF)
    os.makedirs(folder + "/landing")
    os.makedirs(folder + "/source")

    sample.transactions().toPandas().to_csv(f"{folder}/landing/transactions_data.csv", index=False)
    for name in ("users_data", "cards_data", "train_fraud_labels"):
        sample.table(name).toPandas().to_csv(f"{folder}/source/{name}.csv", index=False)
    sample.mcc().toPandas().to_json(f"{folder}/source/mcc_codes.json", orient="records", indent=1)
    paths = JobPaths(folder + "/source", folder + "/raw", folder + "/warehouse", "whole_run")
    stored = {}

    def write_mart(rows, table):
        rows.write.parquet(f"{folder}/marts/{table}")
        stored[table] = spark.read.parquet(f"{folder}/marts/{table}")

    names = jobs.run_all(
        spark, paths, folder + "/landing",
        read_landing=lambda session, table: session.read.parquet(f"{folder}/store/{table}"),
        write_landing=lambda rows, table: rows.write.mode("append").parquet(f"{folder}/store/{table}"),
        write_mart=write_mart,
        as_of=date(2025, 5, 22),
    )
    assert names == list(marts.MARTS) and set(stored) == set(names)
    processed = stored["transactions_data_processed"]
    assert len(processed.columns) == 39
    assert Counter(processed.collect()) == Counter(
        spark.createDataFrame(sample.processed().select(processed.columns).collect(), processed.schema).collect()
    )
    assert stored["transactions_data"].schema["client_id"].dataType.simpleString() == "string"
    assert stored["mcc_codes"].columns == ["id", "item"]
    assert {t.name for t in spark.catalog.listTables("whole_run") if not t.isTemporary} == {
        "transactions_data_cleaned", "cards_data_cleaned", "users_data_cleaned", "transactions_data_processed",
        "mcc_codes", "train_fraud_labels",
    }
    top = served.serve(spark, lambda _, name: stored[name], "top10-clients")
    assert top.count() == 10
    page = served.serve(spark, lambda _, name: stored[name], "client-info", page=2, size=7)
    ids = [json.loads(r.record)["id"] for r in page.collect()]
    assert ids == sorted(r.id for r in stored["users_data"].collect())[7:14]
    assert marts.mart("kpi_by_consu_id", "whole_run")(spark).count() == stored["kpi_by_consu_id"].count()
