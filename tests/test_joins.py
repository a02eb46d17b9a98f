from collections import Counter

from plans import scans
from pyspark.sql import functions as F

from cardmill.operators import enrich, sizing
from cardmill.plans import marts

TX = "id int, date string, client_id int, card_id int, amount string, mcc int"
USER = (
    "id int, current_age int, gender string, per_capita_income string, yearly_income string, total_debt string, "
    "ingestion_date string"
)
CARD = "id int, client_id int, card_brand string, credit_limit string, ingestion_date string"


def frames(spark):
    tx = spark.createDataFrame(
        [
            (1, "d", 10, 100, "$1.00", 7),   # complete
            (2, "d", 11, 100, "$1.00", 7),   # unknown client
            (3, "d", 10, 101, "$1.00", 7),   # unknown card
            (4, "d", 10, 100, "$1.00", 8),   # unknown category
            (5, "d", 10, 100, "$1.00", 7),   # no label
            (6, "d", 10, 100, "$1.00", None),
        ],
        TX,
    )
    mcc = spark.createDataFrame([("7", "Books", "x")], "id string, item string, ingestion_date string")
    users = spark.createDataFrame([(10, 40, "Female", "$1", "$2", "$-3", "x")], USER)
    cards = spark.createDataFrame([(100, 99, "Visa", "$9", "x")], CARD)
    labels = spark.createDataFrame(
        [(1, "No", "x"), (1, "Yes", "x"), (2, "No", "x"), (3, "No", "x"), (4, None, "x"), (6, "No", "x")],
        "id int, info string, ingestion_date string",
    )
    return tx, mcc, users, cards, labels


def test_missing_keys_and_double_label(spark):
    got = enrich.enrich_transactions(*frames(spark))
    assert got.columns == [
        "id", "date", "client_id", "card_id", "amount", "mcc", "item", "current_age", "gender",
        "per_capita_income", "yearly_income", "total_debt", "card_brand", "credit_limit", "info",
    ]
    rows = Counter((r.id, r.item, r.info) for r in got.collect())
    assert rows == Counter([(1, "Books", "No"), (1, "Books", "Yes"), (4, None, None), (6, None, "No")])
    first = got.where("id = 4").first()
    assert (first.client_id, first.total_debt, first.credit_limit, first.amount) == (10, -3.0, 9.0, 1.0)


def test_labels_of_a_day(spark, folder):
    spark.range(0, 1000, 1, 10).selectExpr("id", "'No' AS info").write.parquet(folder + "/labels")
    labels = spark.read.parquet(folder + "/labels")
    day = spark.createDataFrame([(412,), (455,), (2000,), (None,)], "id bigint")
    near = enrich.labels_in_range(labels, day)
    assert near.agg(F.min("id"), F.max("id")).first()[:] == (412, 999)
    joined = enrich.add_labels(day, near)
    assert sorted(joined.collect()) == sorted(enrich.add_labels(day, labels).collect())
    assert "GreaterThanOrEqual(id,412)" in scans(near)
    assert enrich.labels_in_range(labels, day.limit(0)).count() == 0


def test_literal_category_key(spark):
    got = enrich.enrich_transactions(*frames(spark), mcc_key="id")
    assert {r.item for r in got.collect()} == {None}


def test_join_strategies_agree(spark, conf):
    tx, mcc, users, cards, labels = frames(spark)
    planned = enrich.enrich_transactions(tx, mcc, users, cards, labels).collect()
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    shuffled = enrich.enrich_transactions(tx, mcc, users, cards, labels, broadcast_limit=0)
    assert "Broadcast" not in shuffled._jdf.queryExecution().executedPlan().toString()
    assert Counter(shuffled.collect()) == Counter(planned)


def test_two_left_joins_keep_every_transaction(spark):
    tx = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "transaction_id int, client_id int")
    clients = spark.createDataFrame([(10, "a")], "client_id int, name string")
    fraud = spark.createDataFrame([(2, True)], "transaction_id int, is_fraud boolean")
    got = enrich.enrich_left(tx, clients, fraud)
    assert got.columns == ["client_id", "transaction_id", "name", "is_fraud"]
    assert {tuple(r) for r in got.collect()} == {(10, 1, "a", None), (11, 2, None, True), (None, 3, None, None)}


def test_mcc_labels_keep_unknown_codes(spark):
    tx = spark.createDataFrame([(1, 7), (2, 8)], "id int, mcc int")
    labels = spark.createDataFrame([(7, "Books")], "mcc int, item string")
    assert {tuple(r) for r in enrich.label_mcc(tx, labels).collect()} == {(7, 1, "Books"), (8, 2, None)}


def test_broadcast_needs_a_checked_size(spark, conf, folder):
    spark.range(50_000).withColumn("text", F.concat(F.lit("x" * 20), F.col("id"))).write.parquet(folder + "/dim")
    dim = spark.read.parquet(folder + "/dim")
    size = sizing.measured_bytes(dim)
    assert size > 50_000 * 45

    def hinted(limit, **options):
        plan = sizing.broadcast_within(dim, limit, **options)._jdf.queryExecution().analyzed().toString()
        return "ResolvedHint" in plan

    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert sizing.broadcast_room(spark) > size
    assert hinted(size)
    assert not hinted(size - 1)            # planned size fits, measured size does not
    assert not hinted(sizing.planned_bytes(dim) - 1)
    conf(spark__sql__autoBroadcastJoinThreshold="10485760")
    assert not hinted(size)                # Spark decides by itself
    assert hinted(size, always_hint=True)


def test_hot_client_is_split(spark, conf, folder):
    """A third of all rows belong to one client: its shuffle partition is read by several tasks."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100000",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    client = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000)
    rows = spark.range(0, 300_000, 1, 16).select("id", client.alias("client_id"), F.rand(1).alias("noise"))
    rows.write.parquet(folder + "/tx")
    users = spark.range(5000).select("id", F.lit(40).alias("current_age"))
    joined = enrich.add_users(spark.read.parquet(folder + "/tx"), users, broadcast_limit=0)
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 300_000
    # Also where the aggregation could have used the join's partitioning.
    columns = ("client_id", "current_age", F.lit("Male").alias("gender"), F.col("noise").alias("amount"))
    kpis = marts.client_kpis(joined.select(*columns))
    rows = {r.client_id: r.transaction_count for r in kpis.collect()}
    assert "skew=true" in kpis._jdf.queryExecution().executedPlan().toString()
    assert rows[1] > 100_000 and sum(rows.values()) == 300_000


def test_compare_variants(spark):
    got = sizing.compare_variants(spark, {"a": spark.range(3), "b": spark.range(5)}).collect()
    assert [(r.variant, r.n_rows) for r in got] == [("a", 3), ("b", 5)]
    assert all(r.seconds >= 0 for r in got)
    rows = spark.range(7)
    assert [tuple(r)[:2] for r in sizing.compare_cached(rows).collect()] == [("no_cache", 7), ("cache", 7)]
    assert not rows.is_cached
