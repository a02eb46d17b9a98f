"""Versioned tables, incremental state, layouts and doubtful files: edge cases and what is read."""

import datetime
import glob
import json
import random

import pytest
from plans import plan, scan_rows
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cardmill.catalog import staging
from cardmill.operators.analytics import client_metrics, monthly_totals
from cardmill.operators.heavy import heavy_keys, join_heavy
from cardmill.operators.sizing import output_partitions, planned_bytes
from cardmill.plans import incremental, jobs
from cardmill.schemas import table_schema
from cardmill.session import JobPaths
from cardmill.sinks import clustered, keyed, manifests, tables
from cardmill.sinks.files import write_parquet
from cardmill.sources import inference, json_arrays, rejects

DAY = datetime.date(2025, 5, 1)


def named(spark, path, version=None):
    return set(manifests.file_names(manifests.manifest(spark, path, version)))


# Versions


def test_versions_stay_readable_and_two_writers_cannot_both_win(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(10)
    assert manifests.latest_version(spark, path) == 0
    with pytest.raises(FileNotFoundError):
        manifests.manifest(spark, path)
    manifests.append(rows, path, F.col("id"))
    manifests.append(rows.selectExpr("id + 100 AS id"), path, F.col("id"))
    assert manifests.read_version(spark, path).count() == 20
    assert manifests.read_version(spark, path, version=1).count() == 10
    with pytest.raises(AnalysisException):
        manifests.publish(manifests.manifest(spark, path, 1), path, after=1)
    assert manifests.versions(spark, path) == [1, 2]


def test_a_manifest_that_is_not_complete_is_no_version(spark, folder):
    path = f"{folder}/t"
    manifests.append(spark.range(3), path, F.col("id"))
    manifests.manifest(spark, path).write.parquet(f"{path}/_manifests/v=2")
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_manifests/v=2/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).delete(marker, False)
    assert manifests.latest_version(spark, path) == 1


def test_files_that_no_version_names_are_dropped(spark, folder):
    path = f"{folder}/t"
    keyed.write_ranges(spark.range(100), path, "id", files=4)
    manifests.write_files(spark.range(5), path, F.col("id"))  # of a writer that failed
    keyed.merge_corrections(spark, path, spark.range(3), "id")
    assert len(manifests.drop_unnamed(spark, path, keep=2)) >= 1
    assert manifests.read_version(spark, path, version=1).count() == 100
    dropped = manifests.drop_unnamed(spark, path)
    assert dropped and manifests.versions(spark, path) == [2]
    assert manifests.read_version(spark, path).count() == 100


# Corrections


def test_only_files_with_a_correction_are_rewritten(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(0, 800, 2).selectExpr("id", "'old' AS info")
    keyed.write_ranges(rows, path, "id", files=8)
    before = named(spark, path)
    fixes = spark.createDataFrame([(150, "new"), (151, "late"), (152, "new")], "id long, info string")
    assert keyed.merge_corrections(spark, path, fixes, "id") == 2
    after = named(spark, path)
    assert len(before & after) >= 6 and after - before
    got = {r["id"]: r["info"] for r in manifests.read_version(spark, path).collect()}
    assert got == {i: "old" for i in range(0, 800, 2)} | {150: "new", 151: "late", 152: "new"}
    old = {r["id"]: r["info"] for r in manifests.read_version(spark, path, version=1).collect()}
    assert set(old.values()) == {"old"}


def test_corrections_again_and_again(spark, folder):
    """Random corrections, below, between and above the ranges, some twice; the ranges of files stay apart."""
    path, rnd = f"{folder}/t", random.Random(4)
    state = {i: (0, "a") for i in range(100, 300)}
    rows = spark.createDataFrame([(i, *v) for i, v in state.items()], "id long, seen int, info string")
    keyed.write_ranges(rows, path, "id", files=5)
    for turn in range(1, 4):
        fixes = [(rnd.randrange(50, 350), rnd.randrange(3), rnd.choice("xyz")) for _ in range(20)]
        for i, seen, info in sorted(fixes, key=lambda f: f[1:]):
            state[i] = (seen, info)
        keyed.merge_corrections(spark, path, spark.createDataFrame(fixes, rows.schema), "id", ["seen"])
        got = {r["id"]: (r["seen"], r["info"]) for r in manifests.read_version(spark, path).collect()}
        assert got == state
        spans = sorted((r["low"], r["high"]) for r in manifests.manifest(spark, path).collect())
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_no_corrections_and_corrections_without_a_key(spark, folder):
    path = f"{folder}/t"
    keyed.write_ranges(spark.range(10), path, "id", files=2)
    assert keyed.merge_corrections(spark, path, spark.range(0), "id") == 1
    with pytest.raises(PySparkException, match="a correction has no id"):
        keyed.merge_corrections(spark, path, spark.createDataFrame([(None,)], "id long"), "id")
    assert manifests.latest_version(spark, path) == 1


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 100])
def test_range_place(spark, n):
    lows = list(range(10, 10 + 5 * n, 5))
    rows = spark.range(0, 520, 3).withColumn("lows", F.lit(json.dumps(lows))).withColumn("lows", F.from_json("lows", "array<long>"))
    for r in rows.withColumn("place", keyed.range_place(F.col("id"), F.col("lows"))).collect():
        assert r["place"] == sum(low <= r["id"] for low in lows)


def test_files_follow_the_size_of_what_is_read(spark, folder):
    """The planner's estimate of a join is a product of sizes."""
    spark.range(200_000).write.parquet(f"{folder}/a")
    a = spark.read.parquet(f"{folder}/a")
    joined = a.join(a.withColumnRenamed("id", "other"), F.col("id") % 7 == F.col("other") % 5)
    assert planned_bytes(joined) > 10**11
    assert output_partitions(joined, 1) <= 4
    assert output_partitions(spark.range(10)) == 1
    keyed.write_ranges(a, f"{folder}/t", "id")
    assert manifests.manifest(spark, f"{folder}/t").count() == 1


# Packing


def test_pack_fills_bins():
    sizes = [("a", 60), ("b", 50), ("c", 40), ("d", 30), ("e", 20), ("big", 100)]
    assert keyed.pack(sizes, 100) == [["a", "c"], ["b", "d", "e"]]
    assert keyed.pack([], 100) == []


def test_compaction_leaves_other_files_alone(spark, folder):
    path = f"{folder}/t"
    for day in (1, 2):
        rows = spark.range(day * 100, day * 100 + 60).withColumn("day", F.lit(day))
        manifests.append(rows.repartition(4, "id"), path, F.col("day"))
    before = {r["file"]: r["low"] for r in manifests.manifest(spark, path).collect()}
    keyed.compact(spark, path, "day", F.col("low") == 2, sort_by=["id"])
    after = {r["file"]: (r["low"], r["n_rows"]) for r in manifests.manifest(spark, path).collect()}
    assert {f for f, day in before.items() if day == 1} <= set(after)
    assert [v for f, v in after.items() if f not in before] == [(2, 60)]
    assert sorted(r["id"] for r in manifests.read_version(spark, path).collect()) == [*range(100, 160), *range(200, 260)]
    # Nothing is left to pack on that day, and bins below the target take several files.
    assert keyed.compact(spark, path, "day", F.col("low") == 2) == 3
    sizes = [r["n_bytes"] for r in manifests.manifest(spark, path).where("low = 1").collect()]
    keyed.compact(spark, path, "day", F.col("low") == 1, target_bytes=2 * max(sizes) + 1)
    assert manifests.manifest(spark, path).where("low = 1").count() == 2


# Pages


def test_a_page_opens_the_files_that_hold_it(spark, folder):
    path, rnd = f"{folder}/t", random.Random(1)
    data = [(rnd.randrange(5), rnd.choice("abc"), i) for i in range(1000)]
    keyed.write_pages(spark.createDataFrame(data, "k int, name string, id long"), path, ["k desc", "name"], files=10)
    want = sorted(data, key=lambda r: (-r[0], r[1], r[2]))
    for page, size in ((1, 20), (7, 33), (2, 500), (100, 10), (101, 10), (51, 20)):
        got = keyed.page_by_directory(spark, path, page, size)
        assert [tuple(r) for r in got.collect()] == want[(page - 1) * size : page * size]
        assert len(got.inputFiles()) <= 2 + size // 50
    with pytest.raises(ValueError):
        keyed.page_by_directory(spark, path, 0, 10)


# Incremental state


def spent(spark, data):
    return spark.createDataFrame(data, "client_id long, transaction_date timestamp, amount string")


def random_days(seed=3):
    rnd = random.Random(seed)
    days = {}
    for d in range(3):
        rows = []
        for _ in range(60):
            when = datetime.datetime(rnd.choice([2009, 2010]), rnd.randrange(1, 13), rnd.randrange(1, 28), 5)
            amount = rnd.choice([None, "$x", f"${rnd.randrange(-500, 900)}.{rnd.randrange(10)}5"])
            rows.append((rnd.choice([None, 1, 1, 1, 2, rnd.randrange(40)]), rnd.choice([when, when, when, None]), amount))
        days[DAY + datetime.timedelta(days=d)] = rows
    return days


def figures(df):
    return sorted(map(str, df.collect()))


def test_state_equals_the_full_aggregate(spark, folder):
    path, days = f"{folder}/state", random_days()
    first, *others = days
    incremental.merge_day(spent(spark, days[first][:20] + [(77, None, "$5.00")]), path, first, buckets=4)
    for day in [*others, first]:  # the first day comes again, with other rows
        incremental.merge_day(spent(spark, days[day]), path, day, buckets=4)

    def check(rows):
        rows, totals = spent(spark, rows), incremental.client_totals(spark, path)
        assert figures(incremental.state_metrics(totals, 2010)) == figures(client_metrics(rows, 2010))
        assert figures(incremental.state_months(totals, 2010).select("month", "client_id", "total_spent")) == figures(monthly_totals(rows, 2010))
        counts = rows.groupBy("client_id").count()
        assert figures(incremental.state_kpis(totals).select("client_id", F.col("transaction_count").alias("count"))) == figures(counts)

    check([r for rows in days.values() for r in rows])
    incremental.merge_day(spent(spark, []), path, others[0], buckets=4)  # and a day turns out to be empty
    check([r for day, rows in days.items() if day != others[0] for r in rows])
    with pytest.raises(ValueError, match="4 buckets"):
        incremental.merge_day(spent(spark, []), path, first, buckets=8)


def test_a_day_reads_the_buckets_that_it_touches(spark, folder, monkeypatch):
    path, when = f"{folder}/state", datetime.datetime(2010, 1, 1)
    everyone = [(c, when, "$1.00") for c in range(200)]
    incremental.merge_day(spent(spark, everyone), path, DAY, buckets=16)
    before = named(spark, path)
    read = []
    original = incremental.read_files
    monkeypatch.setattr(incremental, "read_files", lambda s, p, files, *a: read.extend(files) or original(s, p, files, *a))
    incremental.merge_day(spent(spark, [(5, when, "$2.00")]), path, DAY + datetime.timedelta(days=1), buckets=16)
    after = named(spark, path)
    old = {f for f in read if f in before}
    assert len(old) == 1 and old == before - after  # one bucket of totals, no file of the earlier day
    totals = incremental.client_totals(spark, path).where("client = 5").collect()
    assert [(r["n_rows"], float(r["total"])) for r in totals] == [(2, 3.0)]


# JSON arrays


def odd_records(n=200, seed=6):
    rnd = random.Random(seed)
    bits = ["{", "}", "[", "]", '"', "\\", ",", "é", "😀", "\n", "\t", "a", "}{", '"}', "\\\\", " "]
    return [
        {
            "id": i,
            "text": "".join(rnd.choice(bits) for _ in range(rnd.randrange(30))),
            "inner": {"list": [{"x": j} for j in range(rnd.randrange(4))], "s": rnd.choice(bits)},
        }
        for i in range(n)
    ]


SCHEMA = "id long, text string, inner struct<list: array<struct<x: int>>, s: string>"


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("block", [100, 777, 1 << 20])
def test_json_array_in_blocks(spark, folder, conf, indent, block):
    records = odd_records()
    for name, part in (("a", records[:150]), ("b", records[150:]), ("c", [])):
        with open(f"{folder}/{name}.json", "w", encoding="utf-8") as out:
            json.dump(part, out, indent=indent, ensure_ascii=name == "a")
    with open(f"{folder}/d.json", "w") as out:
        out.write("\n")
    conf(spark__sql__files__maxPartitionBytes=str(block), spark__sql__files__openCostInBytes="1")
    got = json_arrays.read_json_array(spark, f"{folder}/*.json", SCHEMA)
    rows = sorted((r.asDict(recursive=True) for r in got.collect()), key=lambda r: r["id"])
    assert rows == records
    tasks = spark.read.option("lineSep", "}").text(f"{folder}/a.json").rdd.getNumPartitions()
    assert tasks > 1 or block == 1 << 20


def test_json_blocks_are_small_beside_a_split(spark, folder, conf, monkeypatch):
    """A split is put together by several tasks; one task did before, with memory for the whole split."""
    monkeypatch.setattr(json_arrays, "CHUNK", 7)
    conf(spark__sql__files__maxPartitionBytes=str(1 << 20))
    records = odd_records(300)
    for name, part in (("a", records[:290]), ("b", records[290:])):
        with open(f"{folder}/{name}.json", "w", encoding="utf-8") as out:
            json.dump(part, out)
    texts = json_arrays.json_array_texts(spark, f"{folder}/*.json")
    assert sorted((json.loads(r["value"]) for r in texts.collect()), key=lambda r: r["id"]) == records
    assert texts.select(F.spark_partition_id().alias("task")).distinct().count() > 3


def test_json_arrays_are_staged_by_many_tasks(spark, folder):
    rows = spark.range(0, 1000, 1, 6).selectExpr("id", "concat('a\n\"', id) AS note")
    files = glob.glob(staging.write_json_array_files(rows, f"{folder}/many", "id", rows_per_file=200))
    found = [json.load(open(f)) for f in files]
    assert len(files) == 5 and max(map(len, found)) < 400
    assert sorted(r["id"] for part in found for r in part) == list(range(1000))
    assert {r["note"] for part in found for r in part} == {f'a\n"{i}' for i in range(1000)}
    empty = staging.write_json_array_files(rows.where("id < 0"), f"{folder}/none", "id")
    assert json_arrays.read_json_array(spark, empty, "id long, note string").collect() == []


def test_json_objects_without_an_array(spark, folder, conf):
    conf(spark__sql__files__maxPartitionBytes="64", spark__sql__files__openCostInBytes="1")
    records = odd_records(30)
    with open(f"{folder}/x.json", "w") as out:
        out.write("﻿" + "\n".join(map(json.dumps, records)))
    got = json_arrays.read_json_array(spark, f"{folder}/x.json", SCHEMA).collect()
    assert sorted(r["id"] for r in got) == list(range(30))


@pytest.mark.parametrize("text", ['[{"id": 1}, {"id": 2', '[{"id": 1}', '[{"id": "1}]', '[{"id": 1}]]'])
def test_json_that_is_not_closed(spark, folder, text):
    with open(f"{folder}/x.json", "w") as out:
        out.write(text)
    with pytest.raises(ValueError, match="not closed"):
        json_arrays.read_json_array(spark, f"{folder}/x.json", "id long").collect()


@pytest.mark.parametrize("text", ['[1, {"id": 1}]', '[{"id": 1}, 5]', '[[{"id": 1}]]', "5"])
def test_json_that_is_no_array_of_objects(spark, folder, text):
    with open(f"{folder}/x.json", "w") as out:
        out.write(text)
    with pytest.raises(PySparkException, match="not an object"):
        json_arrays.read_json_array(spark, f"{folder}/x.json", "id long").collect()


# Heavy keys


def test_heavy_keys(spark):
    rows = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id END AS k")
    assert heavy_keys(rows, "k", 0.05) == [7]
    assert heavy_keys(rows.where("k <> 7"), "k", 0.05) == []
    assert heavy_keys(rows.limit(0), "k", 0.05) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_heavy_client_is_in_no_single_task(spark, conf, how):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    client = "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 20 = 1 THEN NULL ELSE id % 2000 END"
    rows = spark.range(40_000).repartition(8).selectExpr("id", f"{client} AS client_id")
    clients = spark.range(1800).selectExpr("id AS client_id", "id * 2 AS twice")
    joined = join_heavy(rows, clients, "client_id", how)
    plain = rows.join(clients, "client_id", how)
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.select(*joined.columns).collect()))
    tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 3 * sorted(tasks)[len(tasks) // 2]
    # The aggregate by the same key adds no skew: its partial sums are made before the shuffle.
    assert "BroadcastHashJoin" in plan(joined) and "SortMergeJoin" in plan(joined)
    with pytest.raises(ValueError):
        join_heavy(rows, clients, "client_id", "right")


# Layouts


def test_clustered_layout_reads_fewer_rows(spark, folder):
    rnd = random.Random(9)
    start = datetime.datetime(2020, 1, 1)
    data = [(rnd.randrange(1000) ** 2, start + datetime.timedelta(hours=rnd.randrange(9000)), i) for i in range(20_000)]
    rows = spark.createDataFrame([*data, (None, None, -1)], "client long, date timestamp, id long")
    clustered.write_clustered(rows, f"{folder}/z", ["client", "date"], files=16)
    write_parquet(rows.repartitionByRange(16, "date"), f"{folder}/plain")
    filters = ["client BETWEEN 10000 AND 20000", "date BETWEEN timestamp'2020-03-01' AND timestamp'2020-03-20'", "client IS NULL"]
    read = {}
    for name in ("z", "plain"):
        for where in filters:
            found = spark.read.parquet(f"{folder}/{name}").where(where)
            want = sorted(r["id"] for r in rows.where(where).collect())
            assert sorted(r["id"] for r in found.collect()) == want
            read[name, where] = sum(scan_rows(found))
    assert read["z", filters[0]] < read["plain", filters[0]] / 2
    assert all(read["z", where] < 12_000 for where in filters)


def test_interleave(spark):
    row = spark.range(1).select(clustered.interleave([F.lit(0b101), F.lit(0b011)], 3).alias("z")).first()
    assert row["z"] == 0b100111
    with pytest.raises(ValueError):
        clustered.interleave([F.lit(1)] * 8, 8)


def test_buckets_join_without_an_exchange(spark, folder, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    raw, database = f"{folder}/raw", "cardmill_bucket_test"
    paths = JobPaths(raw, raw, f"{folder}/warehouse", database)
    stamp = "2025 AS year, 5 AS month, 1 AS day"
    schema = table_schema("transactions_data")
    rows = spark.range(500).selectExpr("id", *[f"cast(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields[1:]], stamp.split(",")[0], *stamp.split(",")[1:])
    write_parquet(rows, paths.raw_table("transactions_data"), partition_by=["year", "month", "day"])
    write_parquet(spark.range(0, 1000, 3).selectExpr("id", "'No' AS info"), paths.raw_table("train_fraud_labels"))
    try:
        for _ in range(2):  # a run that is repeated replaces its tables
            jobs.silver_buckets(spark, paths, 4)
        joined = jobs.labelled_from_buckets(spark, database)
        assert joined.count() == len(range(0, 500, 3))
        assert "Exchange" not in plan(joined)
        conf(spark__sql__legacy__bucketedTableScan__outputOrdering="true")
        sorted_join = jobs.labelled_from_buckets(spark, database)
        assert "Sort " not in plan(sorted_join) and sorted_join.count() == joined.count()
    finally:
        for table in ("transactions_data_buckets", "train_fraud_labels_buckets"):
            tables.drop_table(spark, database, table)
        spark.sql(f"DROP DATABASE IF EXISTS {database}")


def test_bucket_count(spark, folder):
    spark.range(100_000).write.parquet(f"{folder}/t")
    assert jobs.bucket_count(spark, f"{folder}/t") == 1
    assert jobs.bucket_count(spark, f"{folder}/t", target_mb=1) in (1, 2)


def test_buckets_are_counted_by_rows_not_by_files(spark, folder):
    """Files of one value a column are small, whatever a task has to sort."""
    rows = spark.range(0, 400_000, 1, 2).selectExpr("id", "repeat('x', 1000) AS text")
    rows.write.parquet(f"{folder}/t")
    assert jobs.bucket_count(spark, f"{folder}/t", target_mb=64) == 1
    assert jobs.row_bucket_count([spark.read.parquet(f"{folder}/t")], target_mb=64) == 8


# Doubtful files


def csv(folder, name, *lines):
    with open(f"{folder}/{name}.csv", "w") as out:
        out.write("\n".join(lines) + "\n")
    return f"{folder}/{name}.csv"


def test_types_of_files_that_disagree(spark, folder):
    a = csv(folder, "a", "b,i,l,d,x,day,t,s,n", "true,1,1,1,1,2020-01-02,2020-01-02,1,", "FALSE,-5,+7,2,,,,,")
    b = csv(folder, "b", "b,i,l,d,x,day,t,s,n", "True,2147483647,2147483648,1e3,99999999999999999999,2020-1-3,2020-01-02 10:11:12,2020-01-01,")
    schema = inference.infer_schema(spark, [a, b])
    assert [f.dataType.simpleString() for f in schema.fields] == [
        "boolean", "int", "bigint", "double", "decimal(38,0)", "date", "timestamp", "string", "string",
    ]
    files = inference.type_summary(inference.read_text_columns(spark, [a, b]), [F.col("_metadata.file_name").alias("file")])
    assert files.count() == 18
    assert inference.schema_of(inference.merge_summaries(files)) == schema
    alone = inference.merge_summaries(files.where("file = 'a.csv'"))
    assert [r["type"] for r in alone.orderBy("place").collect()][:5] == ["boolean", "int", "int", "int", "int"]
    rows = inference.read_inferred(spark, [a, b])
    assert rows.schema == schema
    assert {r["l"] for r in rows.collect()} == {1, 7, 2147483648}


def test_inference_is_one_scan(spark, folder):
    path = csv(folder, "a", "x,y", "1,2", "3,4.5")
    summary = inference.type_summary(inference.read_text_columns(spark, path))
    assert plan(summary).count("FileScan csv") == 1
    other = csv(folder, "b", "y,x", "1,2")
    with pytest.raises(Exception, match="header"):
        inference.infer_schema(spark, [path, other])


def test_every_line_is_accepted_or_rejected(spark, folder):
    lines = [
        "1,2010-01-01 00:00:00,5", "2,2010-13-01 00:00:00,5", "x,,99999999999", "4,later,", "5,2010-01-01 00:00:00", "6,,7,8",
        ",,", '7,"2010-01-01 00:00:00",1',
    ]
    path = csv(folder, "a", "id,date,n", *lines)
    schema = StructType.fromDDL("id bigint, date timestamp, n int")
    good, bad = rejects.ingest_with_rejects(spark, path, schema, f"{folder}/out")
    assert sorted((r["id"] is None, r["id"], r["n"]) for r in good.collect()) == [(False, 1, 5), (False, 7, 1), (True, None, None)]
    assert good.schema == schema
    found = {
        json.loads(r["record"])["id"]: [(x["column"], x["text"], x["reason"]) for x in r["rejects"]] for r in bad.collect()
    }
    assert found == {
        "2": [("date", "2010-13-01 00:00:00", "no such day or time")],
        "x": [("id", "x", "not a whole number"), ("n", "99999999999", "out of range")],
        "4": [("date", "later", "not a date")],
        "5": [(None, "5,2010-01-01 00:00:00", "wrong number of cells")],
        "6": [(None, "6,,7,8", "wrong number of cells")],
    }
    assert good.count() + bad.count() == len(lines)


def test_a_missing_cell_where_none_may_be(spark, folder):
    path = csv(folder, "a", "id,s", "1,a", ",b")
    schema = StructType([StructField("id", LongType(), False), StructField("s", StringType())])
    good, bad = rejects.ingest_with_rejects(spark, path, schema)
    assert [r["id"] for r in good.collect()] == [1]
    assert [r["rejects"][0]["reason"] for r in bad.collect()] == ["missing"]
