import json
import os
from datetime import date, datetime

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DecimalType, FloatType, StructField

from cardmill import schemas
from cardmill.operators import sizing
from cardmill.operators.cleaning import stamp_ingestion_partition
from cardmill.plans import jobs
from cardmill.session import JobPaths, drop_scratch, materialize, scratch_path
from cardmill.sinks.files import convert_json_map, write_parquet
from cardmill.sources import files, jdbc, listing, readers


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_schemas():
    transactions = schemas.table_schema("transactions_data", ingestion=True, partitions=True)
    assert len(transactions) == 16
    assert transactions["zip"].dataType.simpleString() == "double"
    assert schemas.table_schema("transactions_data")["mcc"].dataType.simpleString() == "bigint"
    assert schemas.table_schema("transactions_data", wide_keys=False)["mcc"].dataType.simpleString() == "int"
    assert schemas.table_schema("users_data")["current_age"].dataType.simpleString() == "int"
    assert schemas.ddl(schemas.table_schema("mcc_codes")) == "`id` STRING, `item` STRING"
    assert [len(schemas.table_schema(t, True)) for t in ("train_fraud_labels", "users_data", "cards_data")] == [3, 15, 14]
    with pytest.raises(KeyError):
        schemas.table_schema("nothing")


def test_create_table_statement(spark):
    rows = spark.sql(
        "SELECT 'a' s, 1 i, 2L l, 1.5D d, true b, current_timestamp() t, current_date() dt, "
        "cast(1 AS float) f, cast(1 AS decimal(15,2)) n, array(1) x"
    )
    assert schemas.create_table_ddl(rows, "public.t") == (
        'CREATE TABLE IF NOT EXISTS public.t ("s" TEXT, "i" INTEGER, "l" BIGINT, "d" DOUBLE PRECISION, "b" BOOLEAN, '
        '"t" TIMESTAMP, "dt" DATE, "f" REAL, "n" NUMERIC(15,2), "x" TEXT)'
    )
    assert schemas.postgres_type(BinaryType()) == "TEXT"
    assert schemas.postgres_type(DecimalType(10, 0)) == "NUMERIC(10,0)"
    assert schemas._quoted(StructField('a"b', FloatType())) == '"a""b" REAL'


def test_csv(spark, folder):
    path = write(folder + "/t.csv", 'id,info\n1,Yes\nx,No\n3,"a,b"\n')
    declared = schemas.table_schema("train_fraud_labels", ingestion=True)
    got = readers.read_csv(spark, path, declared)
    assert got.schema == declared
    assert [tuple(r) for r in got.select("id", "info").collect()] == [(1, "Yes"), (None, "No"), (3, "a,b")]
    inferred = readers.read_csv(spark, write(folder + "/u.csv", "a,b,c\n1,2.5,2010-01-01 10:00:00\n"))
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "double", "timestamp"]


def test_large_keys(spark, folder):
    path = write(folder + "/t.csv", "id,info\n3000000000,Yes\n1,No\n")
    assert [r.id for r in readers.read_csv(spark, path, schemas.table_schema("train_fraud_labels")).collect()] == [3000000000, 1]
    narrow = schemas.table_schema("train_fraud_labels", wide_keys=False)
    rows = readers.read_csv(spark, path, narrow)
    assert rows.schema["id"].dataType.simpleString() == "int"
    with pytest.raises(Exception, match="does not fit INT"):
        rows.collect()
    lines = write(folder + "/t.json", '{"id": 3000000000, "info": "Yes"}\n')
    with pytest.raises(Exception, match="does not fit INT"):
        readers.read_json(spark, lines, narrow, multi_line=False).collect()


def test_csv_column_missing_in_the_file_is_null(spark, folder):
    path = write(folder + "/t.csv", "id,info\n1,Yes\n")
    wider = schemas.table_schema("train_fraud_labels", ingestion=True)
    assert readers.read_csv(spark, path, wider).first().ingestion_date is None


def test_json(spark, folder):
    records = [{"id": "1", "item": "a"}, {"id": "2"}]
    path = write(folder + "/m.json", json.dumps(records, indent=2))
    got = readers.read_json(spark, path, schemas.table_schema("mcc_codes"))
    assert {tuple(r) for r in got.collect()} == {("1", "a"), ("2", None)}
    assert got.rdd.getNumPartitions() == 1
    lines = write(folder + "/l.json", "\n".join(map(json.dumps, records)))
    assert readers.read_json(spark, lines, "id string, item string", multi_line=False).count() == 2


def test_json_object_to_rows(spark, folder):
    text = '{\n "5411": "Grocery \\"A\\"",\n "1": null,\n "7": "old",\n "7": "new"\n}'
    path = write(folder + "/m.json", text)
    expected = {tuple(pair) for pair in json.loads(text).items()}
    assert {tuple(r) for r in readers.read_json_map(spark, path).collect()} == expected
    convert_json_map(spark, path, folder + "/records")
    again = readers.read_json(spark, folder + "/records", "id string, item string", multi_line=False)
    assert {tuple(r) for r in again.collect()} == expected
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_json_map(spark, write(folder + "/bad.json", "{1")).collect()


def test_latest_partition_compares_dates(spark, folder):
    path = folder + "/days"
    for i, day in enumerate((date(2025, 4, 30), date(2025, 5, 1), date(2025, 5, 22), date(2025, 5, 9))):
        rows = stamp_ingestion_partition(spark.range(1).withColumn("n", F.lit(i)), day)
        write_parquet(rows, path, "append", schemas.PARTITION_COLUMNS)
    os.makedirs(path + "/year=2026/month=1/day=1")  # a folder without files is no partition
    assert sorted(readers.partition_days(spark, path)) == [
        date(2025, 4, 30), date(2025, 5, 1), date(2025, 5, 9), date(2025, 5, 22), date(2026, 1, 1),
    ]
    assert readers.latest_partition(spark, path).endswith("year=2025/month=5/day=22")
    newest = readers.read_parquet(spark, path, latest_only=True)
    assert newest.columns == ["id", "n", "ingestion_date"]
    assert [r.n for r in newest.collect()] == [2]
    assert readers.read_parquet(spark, path, "n int", latest_only=True).columns == ["n"]
    assert readers.read_parquet(spark, path).count() == 4
    with pytest.raises(ValueError):
        readers.latest_partition(spark, folder)


def test_newest_partition_asks_for_one_file(spark, folder):
    write_parquet(stamp_ingestion_partition(spark.range(0, 30, 1, 6), date(2025, 5, 1)), folder + "/d", "append", schemas.PARTITION_COLUMNS)
    day = readers.latest_partition(spark, folder + "/d")
    assert len(listing.list_files(spark, day)) == 6
    asked = []

    class Entries:
        def hasNext(self):
            return True

        def next(self):
            asked.append(1)
            return next(real)

    real = iter(spark._jvm.org.apache.hadoop.fs.Path(day).getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(
        spark._jvm.org.apache.hadoop.fs.Path(day)))
    visible = [s for s in real if not s.getPath().getName().startswith((".", "_"))]
    real = iter(visible)
    assert listing.first_file(Entries()) and len(asked) == 1


def test_sql_scan_and_overview(spark, capfd):
    assert readers.read_sql(spark, "SELECT 1 AS one", show=2).first().one == 1
    assert "default" in readers.catalog_overview(spark)["databases"]


def test_files_are_routed(spark, folder):
    write(folder + "/a.csv", "id\n1\n")
    write(folder + "/b.json", '[{"id": "x"}]')
    write(folder + "/c.txt", "?")
    write(folder + "/s_part1.csv", "id\n1\n2\n")
    write(folder + "/s_part2.csv", "id\n3\n")
    os.makedirs(folder + "/sub")
    os.makedirs(folder + "/big.csv")
    write(folder + "/big.csv/part-0.csv", "id\n4\n5\n")
    listed = listing.list_files(spark, folder)
    assert [os.path.basename(f.path) for f in listed] == ["a.csv", "b.json", "c.txt", "s_part1.csv", "s_part2.csv"]
    assert listed[0].length == 5
    assert [os.path.basename(f.path) for f in listing.list_files(spark, folder, datasets=True)][2] == "big.csv"
    written = {}

    def keep(rows, name):
        written[name] = sorted(r.id for r in rows.collect())

    done, skipped = files.ingest_directory(
        spark, folder, keep, lambda name: "id string" if name == "b" else "id int", datasets=True
    )
    assert written == {"a": [1], "b": ["x"], "big": [4, 5], "s": [1, 2, 3]}
    assert done == ["a", "b", "big", "s"]
    assert [os.path.basename(p) for p in skipped] == ["c.txt"]


def test_two_formats_of_one_table_are_refused():
    with pytest.raises(ValueError, match="two formats"):
        files.route_files([listing.SourceFile("x/a.csv", 1), listing.SourceFile("x/a.json", 1)])


@given(size=st.integers(0, 2**50), target=st.integers(1, 4096))
def test_partitions_cover_the_size(size, target):
    n = sizing.partitions_for(size, target)
    assert n >= 1
    assert n * target * sizing.MIB >= size
    assert n == 1 or (n - 1) * target * sizing.MIB < size


def test_partition_boundaries(spark):
    sizes = [0, 1, 40 * sizing.MIB, 40 * sizing.MIB + 1]
    assert [sizing.partitions_for(s, 40) for s in sizes] == [1, 1, 1, 2]
    rows = spark.createDataFrame([(s,) for s in [*sizes, None]], "s bigint")
    got = rows.select(sizing.partitions_for_column("s", 40).alias("n")).collect()
    assert [r.n for r in got] == [1, 1, 1, 2, 1]
    with pytest.raises(ValueError):
        sizing.partitions_for(1, 0)


def test_shuffles_are_sized_by_input(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__initialPartitionNum="8")
    assert sizing.size_shuffles(spark, 10 * sizing.MIB) == 8
    assert sizing.size_shuffles(spark, 1024 * sizing.MIB) == 12
    assert spark.conf.get(sizing.INITIAL_PARTITIONS) == "12"
    assert sizing.size_shuffles(spark, 1) == 12
    assert sizing.size_shuffles(spark, 2**60) == sizing.MOST_PARTITIONS


def test_path_sizes(spark, folder):
    write(folder + "/a.csv", "x" * 10)
    write(folder + "/b.csv", "x" * 5)
    assert sizing.path_bytes(spark, folder + "/a.csv") == 10
    assert sizing.path_bytes(spark, folder) == 15
    assert sizing.path_bytes(spark, folder + "/*.csv") == 15
    assert sizing.path_bytes(spark, [folder + "/a.csv", folder + "/b.csv"]) == 15
    with pytest.raises(FileNotFoundError):
        sizing.path_bytes(spark, folder + "/none")


def test_repartition_by_size(spark, folder):
    write(folder + "/big.csv", "id\n" + "1234567\n" * 300_000)
    rows = readers.read_csv(spark, folder + "/big.csv", "id int")
    spread = sizing.repartition_by_size(rows, folder + "/big.csv", 1)
    assert spread.rdd.getNumPartitions() == 3
    assert spread.count() == 300_000


def test_scratch_is_below_the_shared_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != scratch_path(spark, "x")
    kept = materialize(spark.range(5).withColumn("t", F.lit(datetime(2010, 1, 1))), "x")
    assert kept.count() == 5
    assert "LogicalRDD" not in kept._jdf.queryExecution().analyzed().toString()


class Settings:
    """A session that has only the settings given."""

    def __init__(self, spark, master, **settings):
        self.conf, self.settings = self, settings
        self.sparkContext = self
        self.master, self.applicationId = master, "app-1"
        self._jvm, self._jsc = spark._jvm, spark._jsc

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder_comes_from_the_session(spark, folder):
    named = Settings(spark, "spark://host:7077", **{"spark.checkpoint.dir": folder + "/shared/"})
    path = scratch_path(named, "x")
    assert path.startswith(folder + "/shared/cardmill/app-1/x-")
    os.makedirs(path)
    assert drop_scratch(named)
    assert os.listdir(folder + "/shared/cardmill") == []
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Settings(spark, "spark://host:7077"), "x")
    alone = Settings(spark, "local[2]")
    assert os.path.dirname(scratch_path(alone, "x")) == os.path.dirname(scratch_path(alone, "y"))


def test_paths():
    paths = JobPaths("s", "raw/", "house/")
    assert (paths.raw_table("t"), paths.warehouse_table("t"), paths.database) == ("raw/t", "house/t", "process_data")


def test_jdbc_options(spark):
    target = jdbc.JdbcTarget("jdbc:postgresql://db/x", "me", "secret")
    assert target.options() == {
        "url": "jdbc:postgresql://db/x", "driver": "org.postgresql.Driver", "user": "me", "password": "secret",
    }
    assert "secret" not in repr(target)
    assert (target.qualified("t"), target.qualified("other.t")) == ("public.t", "other.t")
    assert jdbc.range_options("id", 1, 101, 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "101", "numPartitions": "4",
    }
    assert jdbc.bounds_query("public.t", "id") == (
        "SELECT min(id) AS lower_bound, max(id) AS upper_bound FROM public.t"
    )
    assert jdbc.page_query("t", ["id"], 3) == "SELECT * FROM t ORDER BY id LIMIT 20 OFFSET 40"
    assert jdbc.page_query("t", ["id"], 1, 5, ["info", "id"]) == 'SELECT * FROM t ORDER BY id, "info" LIMIT 5 OFFSET 0'
    gold = jdbc.JdbcTarget("jdbc:postgresql://db/x", schema="gold")
    written = jdbc.write_options(gold, "t", 4, column_types="a TEXT")
    assert written["dbtable"] == gold.qualified("t") == "gold.t"
    assert (written["numPartitions"], written["truncate"], written["createTableColumnTypes"]) == ("4", "false", "a TEXT")
    assert not {"top_10_consu", "kpi_by_consu_id", "mcc_codes"} & set(jobs.NUMERIC_KEYS)
    for page, size, order in ((0, 20, ["id"]), (1, 0, ["id"]), (1, 20, [])):
        with pytest.raises(ValueError):
            jdbc.page_query("t", order, page, size)
    assert jdbc.range_options("id", 5, 5, 4) == {}
    assert jdbc.range_options("id", 1, 9, 1) == {}
    with pytest.raises(ValueError):
        jdbc.range_options("id", 1, 9, 0)


def test_jdbc_reaches_the_driver_class(spark):
    """There is no database here; the calls must get as far as loading its driver."""
    target = jdbc.JdbcTarget("jdbc:none:x", driver="no.such.Driver")
    for call in (
        lambda: jdbc.read_jdbc(spark, target, "t", "id"),
        lambda: jdbc.write_jdbc(spark.range(1), target, "t"),
        lambda: jdbc.create_jdbc_table(spark.range(1), target, "t"),
        lambda: jdbc.save_to_jdbc(spark.range(1), target.url, "t", {"driver": target.driver}),
    ):
        with pytest.raises(Exception, match="no.such.Driver"):
            call()
