from datetime import date, datetime

from pyspark.sql import functions as F

from cardmill.functions.money import clean_money, exact_amount, exact_mean, exact_sum, money
from cardmill.operators import cleaning


def test_money_strings(spark):
    texts = ["$5.00", "$-77.00", "-3", "", None, "$1,234.00", "abc", "NaN", "$Infinity", "1e39"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(money(F.col("t")).alias("m"))
    assert [r.m for r in rows.collect()] == [5.0, -77.0, -3.0] + [None] * 7
    assert rows.schema["m"].dataType.simpleString() == "float"


def test_cleaning_twice_changes_nothing(spark):
    rows = spark.createDataFrame([("$12345678.91",), ("$0.10",), (None,)], "credit_limit string")
    once = cleaning.clean_cards(rows)
    assert cleaning.clean_cards(once).collect() == once.collect()
    as_text = once.withColumn("credit_limit", F.col("credit_limit").cast("string"))
    assert clean_money(as_text, "credit_limit").collect() == once.collect()


def test_transactions(spark):
    rows = spark.createDataFrame(
        [(1, "2010-01-01 01:37:00", 5, 5411, "$40.00"), (2, "2010/01/01", 6, 1, "x"), (3, None, None, None, None)],
        "id int, date string, client_id int, mcc int, amount string",
    )
    got = cleaning.clean_transactions(rows).collect()
    assert [r.date for r in got] == [datetime(2010, 1, 1, 1, 37), None, None]
    assert [r.client_id for r in got] == ["5", "6", None]
    assert [r.mcc for r in got] == ["5411", "1", None]
    assert [r.amount for r in got] == [40.0, None, None]
    assert cleaning.clean_transactions(rows, text_keys=False).schema["mcc"].dataType.simpleString() == "int"


def test_users_keep_sign(spark):
    names = "per_capita_income string, yearly_income string, total_debt string"
    rows = spark.createDataFrame([("$1.00", "$2.50", "$-3.25")], names)
    assert tuple(cleaning.clean_users(rows).first()) == (1.0, 2.5, -3.25)


def test_stamps(spark):
    rows = spark.range(1)
    assert cleaning.stamp_ingestion(rows, date(2025, 5, 1)).first().ingestion_date == date(2025, 5, 1)
    stamped = cleaning.stamp_ingestion_partition(rows, date(2025, 4, 30)).first()
    assert (stamped.year, stamped.month, stamped.day) == (2025, 4, 30)
    today = cleaning.stamp_ingestion(rows).select(F.col("ingestion_date") == F.current_date()).first()[0]
    assert today is True


def test_sums_come_from_the_text(spark):
    rows = spark.createDataFrame([("$200000.01",), ("$400000.03",), ("$0.005",), ("$20000000000000.00",), ("NaN",)], "amount string")
    cleaned = cleaning.clean_transactions(
        rows.withColumns({c: F.lit(None).cast("string") for c in ("date", "mcc", "client_id")}), exact=True
    )
    assert cleaned.schema["amount"].dataType.simpleString() == "float"
    for frame in (rows, cleaned):
        assert frame.agg(exact_sum(exact_amount(frame, "amount")).alias("s")).first().s == 20000000600000.045


def test_means_do_not_depend_on_partitions(spark):
    rows = spark.range(20_000).select((F.rand(5) * 2000).cast("float").alias("amount"))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    means = {rows.repartition(n).agg(exact_mean(exact_amount(rows, "amount")).alias("m")).first().m for n in (1, 3, 16)}
    assert len(means) == 1


def test_exact_sum_ignores_order(spark):
    rows = spark.createDataFrame([(0.1,)] * 10 + [(1e9,), (-1e9,)], "a double")
    assert rows.agg(exact_sum("a").alias("s")).first().s == 1.0
