"""Amount, card-brand and fraud models.

Training and test rows are split by a hash of their key and written once to the shared folder, because every
trainer reads its input many times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import IndexToString
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardmill.functions.hashing import hash_split
from cardmill.functions.money import EXACT_TYPE
from cardmill.ml.features import (
    AMOUNT_FEATURES,
    AMOUNT_STRINGS,
    BRAND_FEATURES,
    CALENDAR_FEATURES,
    amount_features,
    assembler,
    brand_features,
    calendar_features,
    string_indexer,
)
from cardmill.operators.filters import require_rows
from cardmill.operators.rows import with_row_index
from cardmill.session import materialize


def train_test(
    df: DataFrame, key: str, percents: Sequence[int] = (80, 20), seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; an error if either is empty."""
    train, test = hash_split(materialize(df, "training"), key, percents, seed)
    return require_rows(train, "training set"), require_rows(test, "test set")


def rmse(predictions: DataFrame, label: str, prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse").evaluate(predictions)


def accuracy(predictions: DataFrame, label: str, prediction: str = "prediction") -> float:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName="accuracy"
    ).evaluate(predictions)


def area_under_roc(predictions: DataFrame, label: str) -> float:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(predictions)


def rmse_frame(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """RMSE of money predictions as one row ``rmse``, over all rows that have both values.

    Errors are taken to six places and squared and summed as decimals, so the result does not depend on the order of
    rows. Where one of them is beyond 10**12, all are summed as doubles instead; none is left out.
    """
    # As wide as a square can be without losing places.
    exact = (F.col(label).try_cast(EXACT_TYPE) - F.col(prediction).try_cast(EXACT_TYPE)).try_cast("decimal(18,6)")
    plain = F.col(label).cast("double") - F.col(prediction).cast("double")
    rows = predictions.select(F.try_multiply(exact, exact).alias("exact"), plain.alias("plain"))
    rows = rows.where(F.col("plain").isNotNull())
    squares = F.when(F.count("exact") == F.count("plain"), F.try_sum("exact").cast("double"))
    total = F.coalesce(squares, F.sum(F.col("plain") * F.col("plain")))
    return rows.agg(F.sqrt(total / F.count("plain").cast("double")).alias("rmse"))


def accuracy_frame(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Share of equal labels and predictions as one row ``accuracy``."""
    hits = F.count(F.when(F.col(label) == F.col(prediction), 1)).cast("double")
    return predictions.agg((hits / F.count(F.lit(1)).cast("double")).alias("accuracy"))


def auc_frame(scores: DataFrame, label: str, score: str = "score") -> DataFrame:
    """Area under ROC as one row ``auc``, by ranks with ties averaged; null where a class is missing.

    Positions come from ``with_row_index``, whose sort is distributed, and rows with equal scores share the mean of
    their first and last position: no window or task sees all rows.
    """
    rows = scores.select(F.col(label).cast("boolean").alias("_label"), F.col(score).alias("_score")).dropna()
    placed = with_row_index(rows, ["_score"], "_position")
    ties = placed.groupBy("_score").agg(
        F.count_if("_label").alias("_hits"),
        F.count(F.lit(1)).alias("_n"),
        (F.min("_position") + F.max("_position") + 2).alias("_twice_rank"),
    )
    hits, others = F.sum("_hits"), F.sum(F.col("_n") - F.col("_hits"))
    twice = F.sum(F.col("_hits") * F.col("_twice_rank")) - hits * (hits + 1)
    return ties.agg(F.try_divide(twice.cast("double"), (2 * hits * others).cast("double")).alias("auc"))


def beats_mean(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row ``beats_mean``: whether the squared error is at most that of always guessing the mean."""
    error = F.avg(F.pow(F.col(label) - F.col(prediction), 2))
    return predictions.agg((error <= F.var_pop(label) * (1 + 1e-9)).alias("beats_mean"))


WEIGHT = "_weight"


def grouped_by_features(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row for each set of features, with the mean of its labels and its number of rows as ``WEIGHT``.

    Least-squares trees grown from these are those grown from the rows: rows of equal features always share a leaf, the
    sums of a node are the same, and the spread inside a group is in every candidate split of a node alike. So
    boosting reads as many rows as there are sets of features, however many rows there are.
    """
    means = rows.groupBy(*features).agg(F.avg(F.col(label).cast("double")).alias(label), F.count(F.lit(1)).cast("double").alias(WEIGHT))
    return materialize(means, "training-groups")


def train_calendar_amount_model(
    df: DataFrame,
    date_col: str = "date",
    label_col: str = "amount",
    key: str = "id",
    iterations: int = 20,
) -> tuple[PipelineModel, DataFrame, float]:
    """Amounts from calendar features: the model, its test predictions and their RMSE."""
    rows = calendar_features(df, date_col, label_col).select(key, label_col, *CALENDAR_FEATURES)
    train, test = train_test(rows, key)
    trees = GBTRegressor(featuresCol="features", labelCol=label_col, weightCol=WEIGHT, maxIter=iterations)
    model = Pipeline(stages=[assembler(CALENDAR_FEATURES), trees]).fit(grouped_by_features(train, CALENDAR_FEATURES, label_col))
    predictions = model.transform(test)
    return model, predictions, rmse(predictions, label_col)


def train_amount_model(
    df: DataFrame, key: str = "id", iterations: int = 20
) -> tuple[PipelineModel, DataFrame, float]:
    """Amounts from client and card features: the model, its test predictions and their RMSE.

    Rows without an amount have no label and are left out.
    """
    rows = amount_features(df).where(F.col("amount").isNotNull())
    plain = [c for c in AMOUNT_FEATURES if not c.endswith("_index")]
    train, test = train_test(rows.select(key, "amount", *plain, *AMOUNT_STRINGS), key)
    indexers = [string_indexer(c) for c in AMOUNT_STRINGS]
    trees = GBTRegressor(featuresCol="features", labelCol="amount", maxIter=iterations)
    model = Pipeline(stages=[*indexers, assembler(AMOUNT_FEATURES), trees]).fit(train)
    predictions = model.transform(test)
    return model, predictions, rmse(predictions, "amount")


def train_brand_classifier(
    df: DataFrame, key: str = "id", seed: int = 12345, invalid: str = "error"
) -> tuple[PipelineModel, DataFrame, float]:
    """Card brand from number prefixes: the model, its test predictions and their accuracy."""
    rows = brand_features(df).select(key, "card_brand", *BRAND_FEATURES)
    train, test = train_test(rows, key, seed=seed)
    # The label index covers both subsets, so that a brand seen only in the test set has an index.
    labels = string_indexer("card_brand", "label", "error").fit(train.unionByName(test))
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", seed=seed)
    names = IndexToString(inputCol="prediction", outputCol="predicted_brand", labels=labels.labels)
    model = Pipeline(stages=[labels, assembler(BRAND_FEATURES, invalid), forest, names]).fit(train)
    predictions = model.transform(test)
    return model, predictions, accuracy(predictions, "label")


def fraud_algorithms() -> dict[str, object]:
    common = {"featuresCol": "features", "labelCol": "label"}
    return {
        "LogisticRegression": LogisticRegression(**common),
        "RandomForest": RandomForestClassifier(**common),
        "GBT": GBTClassifier(**common),
    }


def score_fraud_models(
    df: DataFrame,
    features: Sequence[str],
    label_col: str = "is_fraud",
    key: str = "transaction_id",
    seed: int = 42,
) -> dict[str, DataFrame]:
    """The predictions of three classifiers for the test rows of one 70/30 split, which they share.

    The positive class is a true ``label_col``. Rows without a flag are left out.
    """
    rows = df.where(F.col(label_col).isNotNull()).select(
        key, F.col(label_col).cast("boolean").cast("double").alias("label"), *features
    )
    train, test = train_test(rows, key, (70, 30), seed)
    vectors = assembler(list(features))
    return {
        name: Pipeline(stages=[vectors, algorithm]).fit(train).transform(test)
        for name, algorithm in fraud_algorithms().items()
    }


def compare_fraud_models(
    df: DataFrame,
    features: Sequence[str],
    label_col: str = "is_fraud",
    key: str = "transaction_id",
    seed: int = 42,
) -> dict[str, float]:
    """Area under ROC of the three classifiers of ``score_fraud_models``."""
    predictions = score_fraud_models(df, features, label_col, key, seed)
    return {name: area_under_roc(rows, "label") for name, rows in predictions.items()}


def training_run(spark: SparkSession, database: str = "process_data") -> tuple[PipelineModel, DataFrame, float]:
    """The calendar model of the processed table: the model, its test predictions and their RMSE."""
    return train_calendar_amount_model(spark.table(f"`{database}`.transactions_data_processed"))


def run_training(spark: SparkSession, database: str = "process_data") -> float:
    """Train the calendar model on the processed table and return its RMSE."""
    return training_run(spark, database)[2]
