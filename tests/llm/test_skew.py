"""Hot keys: the joins behind aggregates are split by AQE, since the aggregates are written first."""

import random

import pytest
from pyspark.sql import functions as F

from cardmill.llm import components, embedding_dedup, line_dedup, minhash_dedup, suffix_dedup


@pytest.fixture
def split(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2000",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__files__maxPartitionBytes="20000",
        spark__sql__files__openCostInBytes="1",
    )


@pytest.fixture
def plans(monkeypatch):
    """The executed plans of all copies that a module writes, by label."""
    seen = {}

    def watch(module):
        original = module.materialize

        def spy(df, label):
            df.collect()
            seen[label] = df._jdf.queryExecution().executedPlan().toString()
            return original(df, label)

        monkeypatch.setattr(module, "materialize", spy)
        return seen

    return watch


def test_a_line_of_all_documents(spark, split):
    docs = spark.range(0, 6000, 1, 8).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("the line of all documents\nown line number "), "id").alias("text")
    )
    out = line_dedup.dedup_lines(docs)
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    assert kept[0].startswith("the line") and kept[5999] == "own line number 5999"


def test_a_node_of_very_many_edges(spark, split, folder):
    edges = spark.range(1, 60_000, 1, 8).selectExpr("id AS a", "CASE WHEN id % 3 = 0 THEN id - 1 ELSE 0 END AS b")
    edges.write.parquet(f"{folder}/edges")
    star, _ = components._large_star(spark.read.parquet(f"{folder}/edges"))
    star.collect()
    assert "skew=true" in star._jdf.queryExecution().executedPlan().toString()


def test_a_passage_of_very_many_documents(spark, split, plans):
    seen = plans(suffix_dedup)
    rnd = random.Random(1)
    passage = " ".join(f"word{rnd.randrange(10**6)}" for _ in range(60))
    own = F.concat_ws(" ", *[F.hash(F.col("id"), F.lit(i)).cast("string") for i in range(20)])
    docs = spark.range(0, 1500, 1, 8).select("id", F.concat(own, F.lit(f" {passage} "), own).alias("text"))
    out = suffix_dedup.remove_repeats(docs)
    assert out.where("n_removed > 300").count() == 1500
    assert "skew=true" in seen["open-pieces"]


def test_a_region_of_very_many_sets(spark, split, plans):
    seen = plans(minhash_dedup)
    words = [f"w{i}" for i in range(400)]
    docs = spark.createDataFrame([(i, " ".join([*words, f"x{i}"])) for i in range(900)], "doc_id long, text string").repartition(8)
    out = minhash_dedup.near_documents(docs)
    assert out.select("component_id").distinct().count() == 1
    assert any("skew=true" in plan for label, plan in seen.items() if label.startswith("region-depth"))


def test_a_cell_of_very_many_vectors(spark, split):
    rnd = random.Random(2)
    data = [(i, [1.0 + rnd.random() / 1e4, rnd.random() / 1e4, 0.5, 0.2], 1) for i in range(700)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(8)
    out = embedding_dedup.near_vectors(vectors)
    assert {(r["n_links"], r["component_id"]) for r in out.collect()} == {(699, 0)}
