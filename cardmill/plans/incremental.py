"""Client figures kept up to date from the newest day alone.

The state is a versioned folder with two kinds of files. ``day`` files hold what each ingestion day adds to the months
of a client, ``total`` files the same over all days, by hash bucket of the client. A day is merged bucket by bucket;
of the history nothing is read but the totals of the buckets that the day touches. A day that comes again
replaces what it added: the totals of its clients, and only these, are made anew from the day files.

All figures are mergeable: counts, decimal sums and maxima. One manifest names both kinds of files, so a run that
fails half way has changed nothing and can be repeated.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardmill.functions.money import EXACT_TYPE, exact_amount
from cardmill.session import materialize
from cardmill.sinks.manifests import file_names, latest_version, manifest, publish, read_files, write_files

BUCKETS = 64
DAY, TOTAL = "day", "total"
KEYS = ("client", "year", "month")
# How each figure of two parts is merged.
MERGES = {"n_rows": F.sum, "n_amounts": F.sum, "total": F.sum, "most": F.max, "last_date": F.max}
SUM_TYPE = "decimal(38,6)"


def day_figures(
    rows: DataFrame, client_col: str = "client_id", date_col: str = "transaction_date", amount_col: str = "amount"
) -> DataFrame:
    """What some rows add to each ``client``, ``year`` and ``month``. Rows without a date count for the NULL month."""
    amount = exact_amount(rows, amount_col).try_cast(EXACT_TYPE)
    keys = F.col(client_col).alias("client"), F.year(date_col).alias("year"), F.month(date_col).alias("month")
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(amount).alias("n_amounts"),
        F.sum(amount).cast(SUM_TYPE).alias("total"),
        F.max(amount).alias("most"),
        F.max(date_col).alias("last_date"),
    )


def _merged(parts: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in parts.schema.fields}
    merged = parts.groupBy(*KEYS).agg(*[merge(name).alias(name) for name, merge in MERGES.items()])
    return merged.select(*KEYS, *[F.col(name).cast(types[name]) for name in MERGES])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("client"), F.lit(buckets)).cast("int")


def _day_number(day: date) -> int:
    return day.toordinal()


def _files(spark: SparkSession, path: str, version: int) -> DataFrame | None:
    return manifest(spark, path, version) if version else None


def _named(files: DataFrame, kind: str, where: Column) -> list[str]:
    return file_names(files.where((F.col("kind") == kind) & where))


def merge_day(rows: DataFrame, path: str, day: date, buckets: int = BUCKETS, **columns: str) -> int:
    """Merge the transactions of an ingestion day into the state below ``path``; returns the new version.

    A day that is in the state already is replaced, also by no rows at all. ``buckets`` is fixed by the first day:
    another number later is an error. A client with a third of the rows is one partial row a task before the shuffle.
    """
    spark, number = rows.sparkSession, _day_number(day)
    before = latest_version(spark, path)
    files = _files(spark, path, before)
    if files is not None and (known := files.select(F.max("buckets")).first()[0]) != buckets:
        raise ValueError(f"the state has {known} buckets, not {buckets}")
    figures = day_figures(rows, **columns).withColumns({"_kind": F.lit(number), "_bucket": _bucket(buckets)})
    added = write_files(figures, path, F.lit(number).cast("long"), split_by=["_kind"])
    new = read_files(spark, path, file_names(added), figures.drop("_kind").schema)
    earlier = _named(files, DAY, F.col("low") == number) if files is not None else []
    touched = new.select("client", "_bucket")
    if earlier:
        touched = touched.union(read_files(spark, path, earlier, new.schema).select("client", "_bucket"))
    hit = materialize(touched.select("_bucket").distinct(), "touched-buckets")  # at most ``buckets`` rows
    numbers = sorted(r["_bucket"] for r in hit.collect())
    in_hit = F.col("low").isin(numbers)
    stored = _named(files, TOTAL, in_hit) if files is not None else []
    old = read_files(spark, path, stored, new.schema)
    if earlier:
        # The clients of the day, as it was or as it is now, from what all other days added to them.
        clients = touched.select("client").distinct()
        others = read_files(spark, path, _named(files, DAY, F.col("low") != number), new.schema)
        same = F.col("client").eqNullSafe(F.col("of"))
        mine = clients.withColumnRenamed("client", "of")
        others = others.join(mine, same, "left_semi")
        old = old.join(mine, same, "left_anti").unionByName(others)
    totals = _merged(old.unionByName(new)).withColumn("_bucket", _bucket(buckets))
    totals = totals.withColumn("_part", F.col("_bucket")).hint("rebalance", "_part")
    written = write_files(totals, path, F.col("_bucket").cast("long"), split_by=["_part"])
    parts = [added.withColumns({"kind": F.lit(DAY)}), written.withColumns({"kind": F.lit(TOTAL)})]
    if files is not None:
        gone = ((F.col("kind") == DAY) & (F.col("low") == number)) | ((F.col("kind") == TOTAL) & in_hit)
        parts.append(files.where(~gone).drop("buckets"))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return publish(merged.withColumn("buckets", F.lit(buckets)), path, before)


def client_totals(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The state over all days: one row a client and month."""
    files = manifest(spark, path)
    return read_files(spark, path, _named(files, TOTAL, F.lit(True)), schema).drop("_bucket")


def state_kpis(totals: DataFrame, client_col: str = "client_id") -> DataFrame:
    """Counts, mean and maximum of amounts per client, as the KPI mart has them, from the totals."""
    return totals.groupBy(F.col("client").alias(client_col)).agg(
        F.sum("n_amounts").alias("total_amount"),
        F.sum("n_rows").alias("transaction_count"),
        (F.sum("total").cast("double") / F.sum("n_amounts")).alias("avg_spent"),
        F.max("most").cast("float").alias("max_spent"),
    )


def state_metrics(totals: DataFrame, year: int, client_col: str = "client_id") -> DataFrame:
    """The client metrics of a year: number, mean, maximum, last date and best month, from the totals alone.

    The earliest month wins a tie; a client without any amount gets its first month.
    """
    best = F.max_by("month", F.struct("total", -F.col("month")))
    metrics = totals.where(F.col("year") == year).groupBy(F.col("client").alias(client_col)).agg(
        F.sum("n_rows").alias("nb_transactions"),
        (F.sum("total").cast("double") / F.sum("n_amounts")).alias("avg_spent"),
        F.max("most").cast("double").alias("max_spent"),
        F.max("last_date").alias("last_transaction_date"),
        best.alias("best_month"),
    )
    return metrics.select(client_col, F.lit(year).alias("year"), *metrics.columns[1:])


def state_months(totals: DataFrame, year: int, client_col: str = "client_id") -> DataFrame:
    """Spending per month of a year and client, from the totals."""
    months = totals.where(F.col("year") == year)
    return months.select("month", F.col("client").alias(client_col), F.col("total").cast("double").alias("total_spent"))
