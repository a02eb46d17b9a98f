import glob
import re

import pytest
from compare import SF
from plans import plan, scan_rows, scans
from pyspark.sql import functions as F

from cardmill.catalog.queries import QUERIES
from cardmill.operators import paging
from cardmill.operators.filters import preview, require_rows
from cardmill.operators.rows import replays_in_order, split_rows, with_row_index
from cardmill.session import scratch_base


def test_pages(spark):
    rows = spark.range(45).repartition(5)
    sizes = [paging.paginate(rows, ["id"], p).count() for p in (1, 2, 3, 4)]
    assert sizes == [20, 20, 5, 0]
    for bad in ({"page": 0}, {"size": 0}, {"order_by": []}):
        with pytest.raises(ValueError):
            paging.paginate(rows, **{"order_by": ["id"], **bad})


@pytest.mark.parametrize(("first", "ranges"), [(1_000, 1_000_000), (0, 1_000_000), (25, 5)])
def test_pages_put_together_are_the_sorted_table(spark, monkeypatch, first, ranges):
    monkeypatch.setattr(paging, "FIRST_ROWS", first)
    monkeypatch.setattr(paging, "RANGE_ROWS", ranges)
    rows = spark.range(53).select("id", (F.col("id") * 7 % 10).alias("k")).repartition(6)
    pages = [paging.paginate(rows, ["k desc", "id"], p, 10).collect() for p in range(1, 8)]
    assert [r for page in pages for r in page] == rows.orderBy(F.desc("k"), "id").collect()


@pytest.mark.parametrize(("first", "ranges"), [(1_000, 1_000_000), (0, 1_000_000), (0, 100)])
def test_pages_of_equal_keys_hold_every_row_once(spark, monkeypatch, first, ranges):
    monkeypatch.setattr(paging, "FIRST_ROWS", first)
    monkeypatch.setattr(paging, "RANGE_ROWS", ranges)
    rows = spark.range(2000).select((F.col("id") % 3).alias("k"), "id", F.lit(None).cast("string").alias("s"))
    seen = [r.id for p in range(1, 5) for r in paging.paginate(rows.repartition(5), ["k"], p, 500).collect()]
    assert sorted(seen) == list(range(2000))


@pytest.mark.parametrize("order", [["t desc"], ["d desc"], ["n desc", "t"], ["b desc", "n"], ["m desc"]])
def test_falling_orders_of_all_types(spark, monkeypatch, order):
    monkeypatch.setattr(paging, "FIRST_ROWS", 0)
    rows = spark.range(60).select(
        F.when(F.col("id") % 7 > 0, F.repeat(F.lit("x"), (F.col("id") % 5).cast("int"))).alias("t"),
        F.timestamp_seconds(F.col("id") * 7919 % 100_000).alias("d"), (F.col("id") * 1.5 - 20).alias("n"),
        (F.col("id") % 2 == 0).alias("b"), (F.col("id") * 37 % 60).cast("decimal(9,2)").alias("m"),
    )
    sort = [F.col(n).desc() if down else F.col(n).asc() for n, down in paging.total_order(rows, order)]
    got = [r for p in (1, 2, 3) for r in paging.paginate(rows.repartition(4), order, p, 20).collect()]
    assert got == rows.orderBy(*sort).collect()


def test_deep_pages_sort_only_their_range(spark, monkeypatch, conf):
    """The rows of other key ranges are filtered out before the sort, and no full row is shuffled or written."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    monkeypatch.setattr(paging, "FIRST_ROWS", 0)
    rows = spark.range(0, 80_000, 1, 8).select((F.col("id") * 7919 % 80_000).alias("v"), F.lit("wide").alias("w"))
    page = paging.paginate(rows, ["v"], 4501, 10)
    assert [r.v for r in page.collect()] == list(range(45_000, 45_010))
    text = plan(page)
    assert "rangepartitioning" not in text and "Subquery" in text
    taken = [int(x) for x in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", text)]
    assert taken and max(taken) < 25_000


def test_keyset_pages(spark):
    rows, last, seen = spark.range(45).repartition(3), None, []
    while page := paging.keyset_page(rows, "id", last, 20).collect():
        last = page[-1].id
        seen += [r.id for r in page]
    assert seen == list(range(45))


def test_records(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    assert [r.record for r in paging.records(rows).collect()] == ['{"id":1,"name":"a"}', '{"id":2,"name":null}']


def test_row_index_with_a_hot_key(spark, conf):
    """A third of the rows share one key and are copies of each other; several tasks sort them."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    key = F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id"))
    rows = spark.range(0, 3000, 1, 7).select(key.alias("k"))
    indexed = with_row_index(rows, ["k"])
    got = sorted((r.row_index, r.k) for r in indexed.collect())
    assert [i for i, _ in got] == list(range(3000))
    assert [k for _, k in got] == sorted(k for _, k in got)
    ordered = rows.withColumn("i", F.monotonically_increasing_id()).orderBy("k", "i")
    tasks = ordered.withColumn("task", F.spark_partition_id()).where("k = 500").select("task").distinct()
    assert tasks.count() > 1


def test_only_stored_rows_replay_in_order(spark, sample):
    assert replays_in_order(sample.labels())
    regions = F.broadcast(sample.raw("region"))
    assert replays_in_order(sample.labels().join(regions, F.col("id") == F.col("r_regionkey")))
    assert not replays_in_order(sample.labels().repartition(3))
    assert not replays_in_order(sample.labels().groupBy("info").count())
    assert not replays_in_order(sample.labels().limit(3))
    assert not replays_in_order(sample.labels().orderBy("id").limit(3))
    cached = sample.labels().persist()
    assert not replays_in_order(cached)
    cached.unpersist()


def test_row_index_in_input_order(spark):
    rows = spark.range(0, 50, 1, 7).select((F.col("id") * 37 % 50).alias("v"))
    got = with_row_index(rows).orderBy("row_index").collect()
    assert [r.v for r in got] == [i * 37 % 50 for i in range(50)]


def test_row_index_over_several_files(spark, folder):
    """Files of unequal size come in the order of their paths."""
    sizes = [10, 3000, 50]
    for i, n in enumerate(sizes):
        start = sum(sizes[:i])
        spark.range(start, start + n, 1, 1).write.parquet(f"{folder}/f{i}")
    rows = spark.read.option("recursiveFileLookup", True).parquet(folder)
    assert all(r.row_index == r.id for r in with_row_index(rows).collect())
    assert [r.n for r in split_rows(rows, 3).groupBy("part").agg(F.max("id").alias("n")).orderBy("part").collect()] == [1019, 2039, 3059]
    with pytest.raises(ValueError, match="order"):
        with_row_index(rows.repartition(2))


@pytest.mark.parametrize(
    ("n", "parts", "sizes"),
    [(10, 4, [3, 3, 2, 2]), (8, 4, [2, 2, 2, 2]), (2, 4, [1, 1]), (1, 1, [1])],
)
def test_split_sizes(spark, n, parts, sizes):
    rows = spark.range(n).repartition(3)
    got = split_rows(rows, parts, ["id"]).orderBy("id").collect()
    assert [r.part for r in got] == [p + 1 for p, size in enumerate(sizes) for _ in range(size)]


def test_split_of_nothing(spark):
    assert split_rows(spark.range(0), 3).collect() == []


def test_guards(spark):
    assert preview(spark.range(9)).count() == 2
    assert require_rows(spark.range(1)).count() == 1
    with pytest.raises(ValueError, match="training set"):
        require_rows(spark.range(0), "training set")


def test_a_deep_page_skips_row_groups(spark, folder, conf):
    """The bounds of the first column reach the scan, NULLs included."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(0, 40_000).selectExpr("CASE WHEN id < 3000 THEN NULL ELSE id END AS k", "id")
    rows.repartitionByRange(20, "id").write.parquet(folder + "/t")
    stored = spark.read.parquet(folder + "/t")
    page = paging.paginate(stored, ["k"], page=300, size=100)
    assert [r["id"] for r in page.collect()] == list(range(29_900, 30_000))
    assert "GreaterThanOrEqual(k," in scans(page)
    assert min(scan_rows(page)) < 40_000 / 2
    first = paging.paginate(stored, ["k"], page=20, size=100)
    assert [r["id"] for r in first.collect()] == list(range(1900, 2000))


def test_split_of_two_deliveries_is_written_by_many_tasks(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    written = f"{scratch_base(spark)}/cardmill/*/two-files-*/b/part-*".removeprefix("file:")
    before = len(glob.glob(written))
    rows = QUERIES["split_two_files"](spark, SF).orderBy("id").collect()
    assert len(glob.glob(written)) - before > 1
    size, extra = divmod(len(rows), 5)
    assert [r.part for r in rows] == [p + 1 for p in range(5) for _ in range(size + (p < extra))]
