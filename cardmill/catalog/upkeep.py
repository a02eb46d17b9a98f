"""Queries over tables that are kept up to date in place, laid out for later reads, or read from doubtful files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from cardmill.catalog import staging
from cardmill.catalog.queries import new_database, query
from cardmill.catalog.sample import DAY, YEAR, Sample
from cardmill.operators.cleaning import TIMESTAMP_FORMAT, stamp_ingestion, stamp_ingestion_partition
from cardmill.operators.heavy import join_heavy
from cardmill.plans import incremental, jobs
from cardmill.schemas import PARTITION_COLUMNS, table_schema
from cardmill.session import JobPaths, scratch_path
from cardmill.sinks import clustered, keyed, manifests
from cardmill.sinks.files import write_parquet
from cardmill.sources import inference, rejects

# Each kind of transaction arrives on a day of its own.
DAYS = {"Online": date(2025, 4, 30), "Swipe": date(2025, 5, 1), "Chip": DAY}


def _state(s: Sample) -> DataFrame:
    """The totals over three days, of which one came again after half of its rows."""
    path, spending = scratch_path(s.spark, "state"), s.spending()

    def merge(kind: str, where: Column) -> None:
        arrived = spending.where((F.col("transaction_type") == f"{kind} Transaction") & where)
        incremental.merge_day(arrived, path, DAYS[kind], buckets=8)

    everything = F.lit(True)
    merge("Online", everything)
    merge("Swipe", F.col("transaction_id") % 2 == 0)
    for kind in ("Chip", "Swipe"):
        merge(kind, everything)
    return incremental.client_totals(s.spark, path)


@query
def kpi_incremental(s: Sample) -> DataFrame:
    return incremental.state_kpis(_state(s))


@query
def metrics_incremental(s: Sample) -> DataFrame:
    return incremental.state_metrics(_state(s), YEAR)


@query
def months_incremental(s: Sample) -> DataFrame:
    return incremental.state_months(_state(s), YEAR)


@query
def merge_corrections(s: Sample) -> DataFrame:
    """Labels in eight files; some come late and some are corrected, a few twice, all in the lower quarter of the keys."""
    path = scratch_path(s.spark, "labels")
    labels = s.labels().withColumn("seen", F.lit(0))
    late = F.col("id") % 10 == 0
    keyed.write_ranges(labels.where(~late | (F.col("id") > _quarter(s))), path, "id", files=8)
    low = labels.where(F.col("id") <= _quarter(s))
    fixed = low.where(F.col("id") % 97 == 3).withColumns({"info": F.lit("Checked"), "seen": F.lit(1)})
    again = low.where(F.col("id") % 194 == 3).withColumns({"info": F.lit("Withdrawn"), "seen": F.lit(2)})
    changes = again.unionByName(fixed).unionByName(low.where(late & (F.col("id") % 97 != 3)))
    keyed.merge_corrections(s.spark, path, changes, "id", ["seen"])
    return manifests.read_version(s.spark, path)


def _quarter(s: Sample) -> Column:
    return s.labels().select((F.max("id") / 4)).scalar()


@query
def compact_days(s: Sample) -> DataFrame:
    """Three days of labels in six files each; two of the days are packed. Each row says how many files its day has now."""
    path = scratch_path(s.spark, "days")
    days = list(DAYS.values())
    for i, day in enumerate(days):
        arrived = stamp_ingestion(s.labels().where(F.col("id") % 3 == i), day)
        manifests.append(arrived.repartition(6, "id"), path, F.col("ingestion_date"))
    for day in days[1:]:
        keyed.compact(s.spark, path, "ingestion_date", F.col("low") == F.lit(day), sort_by=["id"])
    files = manifests.manifest(s.spark, path).groupBy(F.col("low").alias("ingestion_date"))
    files = files.agg(F.count(F.lit(1)).alias("n_files"))
    return manifests.read_version(s.spark, path).join(F.broadcast(files), "ingestion_date")


@query
def page_by_directory(s: Sample) -> DataFrame:
    """Three pages out of ten files: the first, one across files and one behind the end."""
    path, order = scratch_path(s.spark, "pages"), ["use_chip", "client_id desc"]
    rows = s.transactions().select("client_id", "use_chip", "id", "amount")
    keyed.write_pages(rows, path, order, files=10)
    pages = [keyed.page_by_directory(s.spark, path, page, 250) for page in (1, 3, 100_000_000)]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


@query
def clustered_read(s: Sample) -> DataFrame:
    """A range of clients and a range of days, read from a layout that serves both."""
    path, spending = scratch_path(s.spark, "clustered"), s.spending()
    clustered.write_clustered(spending, path, ["client_id", "transaction_date"], files=4)
    rows = s.spark.read.schema(spending.schema).parquet(path)
    clients = rows.where(F.col("client_id").between(40, 90)).withColumn("by", F.lit("client"))
    days = "transaction_date >= timestamp '1996-03-01 00:00:00' AND transaction_date < timestamp '1996-05-01 00:00:00'"
    return clients.unionByName(rows.where(days).withColumn("by", F.lit("date")))


@query
def silver_bucketed_join(s: Sample) -> DataFrame:
    raw, name = scratch_path(s.spark, "raw"), new_database(s.spark, "buckets")
    paths = JobPaths(raw, raw, scratch_path(s.spark, "warehouse"), name)
    arrived = stamp_ingestion_partition(s.transactions(), DAY)
    write_parquet(arrived, paths.raw_table("transactions_data"), partition_by=PARTITION_COLUMNS)
    write_parquet(stamp_ingestion(s.labels(), DAY), paths.raw_table("train_fraud_labels"))
    jobs.silver_buckets(s.spark, paths)
    return jobs.labelled_from_buckets(s.spark, name)


@query
def join_heavy_clients(s: Sample) -> DataFrame:
    """One client has a third of all transactions."""
    client = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("client_id")).cast("bigint")
    return join_heavy(s.transactions().withColumn("client_id", client), s.clients(), "client_id")


@query
def infer_lattice(s: Sample) -> DataFrame:
    """Two deliveries of one table, the second with wider values in most columns."""
    path = scratch_path(s.spark, "lattice")
    rows = s.transactions()
    odd = F.col("id") % 2 == 1
    for name, wide in (("first", False), ("second", True)):
        part = rows.where(odd if wide else ~odd)
        part = part.select(
            "id",
            F.date_format("date", TIMESTAMP_FORMAT if wide else "yyyy-MM-dd").alias("seen"),
            (F.col("client_id") + (3_000_000_000 if wide else 0)).alias("account"),
            F.concat("merchant_id", F.lit(".5" if wide else "")).alias("share"),
            F.when(F.col("id") % 4 == 0, "true").otherwise("x" if wide else "FALSE").alias("flag"),
            F.lit(None).cast("string").alias("nothing"),
        )
        staging.write_csv(part, f"{path}/{name}")
    days = [inference.type_summary(inference.read_text_columns(s.spark, f"{path}/{name}")) for name in ("first", "second")]
    schema = inference.schema_of(inference.merge_summaries(days[0].unionByName(days[1])))
    read = inference.read_inferred(s.spark, f"{path}/*", schema)
    return _same_keys(read).withColumn("types", F.lit(", ".join(f.dataType.simpleString() for f in schema.fields[1:])))


def _same_keys(df: DataFrame) -> DataFrame:
    """Inference makes a key INT or BIGINT, by the size of the table."""
    return df.withColumn("id", F.col("id").cast("bigint"))


@query
def ingest_with_rejects(s: Sample) -> DataFrame:
    """Accepted rows by id, and each rejected cell with its text and reason."""
    bad = {
        "date": F.when(F.col("id") % 37 == 5, "2024-13-45 00:00:00"),
        "client_id": F.when(F.col("id") % 41 == 2, "99999999999999999999"),
        "mcc": F.when(F.col("id") % 31 == 3, F.concat(F.lit("x"), "mcc")),
        "zip": F.when(F.col("id") % 59 == 4, "here"),
    }
    rows = s.transactions().withColumn("date", F.date_format("date", TIMESTAMP_FORMAT))
    rows = rows.withColumns({name: F.coalesce(text, F.col(name).cast("string")) for name, text in bad.items()})
    path = staging.write_csv(rows, scratch_path(s.spark, "doubtful"))
    schema = table_schema("transactions_data")
    good, wrong = rejects.ingest_with_rejects(s.spark, path, schema)
    wrong = wrong.select(F.get_json_object("record", "$.id").cast("bigint").alias("id"), F.explode("rejects").alias("r"))
    good = good.select("id", F.lit(None).cast("string").alias("column"), F.col("client_id").cast("string").alias("text"), F.lit("accepted").alias("reason"))
    return good.unionByName(wrong.select("id", "r.*"))
