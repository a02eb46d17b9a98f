import pytest
from pyspark.sql import functions as F

from cardmill.functions.hashing import hash_split, random_split
from cardmill.ml import features, training


def test_split_is_complete_disjoint_and_repeatable(spark):
    rows = spark.range(5000)
    train, test = hash_split(rows, "id")
    ids = [r.id for r in train.collect()], [r.id for r in test.collect()]
    assert sorted(ids[0] + ids[1]) == list(range(5000))
    assert 0.77 < len(ids[0]) / 5000 < 0.83
    again = hash_split(rows.repartition(7), "id")[0]
    assert sorted(r.id for r in again.collect()) == sorted(ids[0])
    other = hash_split(rows, "id", seed=43)[0]
    assert sorted(r.id for r in other.collect()) != sorted(ids[0])
    missing = spark.createDataFrame([(None,), (1,)], "id int")
    assert sum(part.count() for part in hash_split(missing, "id", (70, 30))) == 2
    with pytest.raises(ValueError):
        hash_split(rows, "id", (80, 30))
    assert sum(part.count() for part in random_split(rows)) == 5000


def test_chip_flags(spark):
    rows = spark.createDataFrame([("YES",), ("NO",), (None,), (" yes ",), ("1",), ("0",)], "has_chip string")
    got = rows.select(features.yes_no_flag("has_chip", 1).alias("f")).collect()
    assert [r.f for r in got] == [1, 0, 1, 1, 1, 0]


def test_gaps_are_filled(spark):
    names = ["amount", *features.AMOUNT_DEFAULTS]
    rows = spark.createDataFrame([tuple([None] * len(names))], ", ".join(f"{n} string" for n in names))
    got = features.amount_features(rows).first().asDict()
    assert got.pop("amount") is None
    assert got == features.AMOUNT_DEFAULTS


def test_brand_features(spark):
    rows = spark.createDataFrame(
        [("Visa", "4344676511950444"), ("Amex", "x"), ("Other", "1"), (None, "1")],
        "card_brand string, card_number string",
    )
    got = {r.card_brand: (r.prefix1, r.prefix2, r.prefix4, r.length) for r in features.brand_features(rows).collect()}
    assert got == {"Visa": (4, 43, 4344, 16), "Amex": (None, None, None, 1)}


def test_index_by_frequency_then_name(spark):
    rows = spark.createDataFrame([(v,) for v in "b b a c c d".split()] + [(None,)], "k string")
    assert {r.k: r.idx for r in features.index_mapping(rows, "k").collect()} == {"b": 0.0, "c": 1.0, "a": 2.0, "d": 3.0}


def test_evaluators_agree_with_the_frames(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 1.0)], "label double, prediction double")
    assert training.rmse_frame(rows, "label").first().rmse == pytest.approx(training.rmse(rows, "label"))
    assert training.accuracy_frame(rows, "label").first().accuracy == pytest.approx(training.accuracy(rows, "label"))


def test_rmse_keeps_every_row(spark):
    rows = spark.createDataFrame([(1.0, 0.5), (0.0, 1e20), (None, 3.0), (2.0, None)], "label double, prediction double")
    assert training.rmse_frame(rows, "label").first().rmse == pytest.approx(1e20 / 2**0.5)
    exact = spark.createDataFrame([("0.10", 0.123456), ("0.20", 0.2)], "label string, prediction double")
    assert training.rmse_frame(exact, "label").first().rmse == pytest.approx(0.023456 / 2**0.5, rel=1e-9)


def test_auc_by_ranks(spark):
    rows = spark.range(0, 400, 1, 5).select((F.hash("id") % 3 == 0).alias("label"), (F.col("id") * 7 % 13).cast("double").alias("score"))
    expected = training.area_under_roc(rows.select(F.col("label").cast("double").alias("label"), F.col("score").alias("rawPrediction")), "label")
    assert training.auc_frame(rows, "label").first().auc == pytest.approx(expected)
    assert training.auc_frame(rows.where("label"), "label").first().auc is None


def learnable(spark, n=600):
    hot = (F.hash("id") % 2 == 0)
    return spark.range(n).select(
        "id", F.when(hot, 500.0).otherwise(20.0).alias("amount"), hot.alias("is_fraud"),
        F.timestamp_seconds(F.lit(1262304000) + F.col("id") * 86400).alias("date"),
        F.when(hot, "Visa").otherwise("Amex").alias("card_brand"),
        F.when(hot, "4000000000000000").otherwise("300000000000000").alias("card_number"),
        F.when(hot, 800).otherwise(400).alias("credit_score"), F.lit(2).alias("num_credit_cards"),
        F.lit("YES").alias("has_chip"), F.lit("No").alias("card_on_dark_web"), F.lit(1.0).alias("yearly_income"),
        F.lit(1.0).alias("total_debt"), F.lit(1.0).alias("credit_limit"), F.lit(1.0).alias("per_capita_income"),
        F.lit("Male").alias("gender"), F.lit("Debit").alias("card_type"),
    )


def test_models_beat_guessing(spark):
    rows = learnable(spark)
    _, predictions, error = training.train_amount_model(rows, iterations=3)
    assert 0 <= error < 100  # the spread of the label is 240
    assert predictions.count() == hash_split(rows, "id")[1].count()
    _, _, share = training.train_brand_classifier(rows)
    assert share == 1.0
    scores = training.compare_fraud_models(rows, ["credit_score"], key="id")
    assert set(scores) == {"LogisticRegression", "RandomForest", "GBT"}
    assert all(0.99 < s <= 1.0 for s in scores.values())


def test_calendar_model_from_groups_is_that_of_the_rows(spark, monkeypatch):
    rows = spark.range(6000).select(
        "id", F.timestamp_seconds(F.lit(1262304000) + F.col("id") % 200 * 86400).alias("date"),
        (F.month("date") * 100 + F.hash("id") % 50).cast("double").alias("amount"),
    )
    fitted, fit = [], training.Pipeline.fit
    monkeypatch.setattr(training.Pipeline, "fit", lambda self, df: fitted.append(df.count()) or fit(self, df))
    _, predictions, _ = training.train_calendar_amount_model(rows, iterations=5)
    assert max(fitted) <= 200  # the days
    monkeypatch.undo()
    parts = features.calendar_features(rows)
    trees = training.GBTRegressor(featuresCol="features", labelCol="amount", maxIter=5)
    plain = training.Pipeline(stages=[features.assembler(features.CALENDAR_FEATURES), trees]).fit(hash_split(parts, "id")[0])
    expected = {r.id: r.prediction for r in plain.transform(hash_split(parts, "id")[1]).collect()}
    assert {r.id: r.prediction for r in predictions.collect()} == pytest.approx(expected, rel=1e-9)


def test_calendar_model(spark):
    rows = learnable(spark, 300).withColumn("amount", F.month("date") * 100.0)
    model, predictions, error = training.train_calendar_amount_model(rows, iterations=5)
    assert 0 <= error < 150
    assert {"id", "amount", "prediction", "day_of_week"} <= set(predictions.columns)
    assert len(model.stages) == 2
    with pytest.raises(ValueError, match="set has no rows"):
        training.train_calendar_amount_model(rows.where("id < 1"))
