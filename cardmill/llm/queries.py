"""One query for each operator, over the whole given table: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardmill.llm import (
    byte_bpe, embedding_dedup, line_dedup, merkle, minhash_dedup, mixing, periodic, quality, secrets, suffix_dedup, token_files,
    toxicity, url_templates,
)
from cardmill.llm.common import ascii_lower, table, words_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _crc32(key: str):
    """The unsigned checksum of an integer's decimal text."""
    return F.crc32(F.col(key).cast("string").cast("binary"))


def _digest(text: str):
    return F.sha2(F.col(text).cast("binary"), 256)


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", _digest("text").alias("kept_sha256"))


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return embedding_dedup.near_vectors(vectors).select("vec_id", "n_links", "component_id", "kept")


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash_dedup.near_documents(docs).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels")
    rows = toxicity.training_sample(docs, labels, ~held_out, "doc_id", "text", "toxic")
    counts = toxicity.class_counts(labels, ~held_out, "doc_id", "toxic")
    scored = toxicity.score_texts(docs, toxicity.fit(rows, counts))
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs).select("doc_id", F.col("secret_spans").alias("s"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("s", lambda x: x["kind"] != "entropy")
    counts = [count(kind) for kind in secrets.KINDS[:3]]
    digest = F.sha2(joined(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, joined(F.col("s")).alias("spans"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_report(docs).select("doc_id", *quality.METRICS, "base_failed", "kept")


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix_dedup.remove_repeats(docs, passages_col="n_passage_words")
    # What is left as text; a cut inside a character leaves a replacement character.
    left = F.make_valid_utf8(F.col("kept_bytes").cast("string")).alias("text")
    kept = F.sha2("kept_bytes", 256).alias("kept_sha256")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", kept, "n_passage_words", left)


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN).drop("text")


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = token_files.write_token_files(docs, path, token_files.token_folder(spark))
    return token_files.read_token_files(manifest)


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    tampered = {"text": ascii_lower(F.col("text"))}
    return merkle.merkle_manifest(docs, claimed=tampered, claimed_where=_crc32("doc_id") % 5 == 0)


URL_RULES = [
    url_templates.Rule("allow", "com/"),
    url_templates.Rule("block", "example.com/en/"),
    url_templates.Rule("allow", "www.example.com/en/"),
    url_templates.Rule("block", "net/es/"),
    url_templates.Rule("block", "net/fr/"),
]


@query
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_templates.judge_urls(pages, URL_RULES).drop("url")


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of a tenth of the documents, chosen by the checksum of their id, made periodic from a word on."""
    n = F.size("_words")
    step = F.floor(F.col("_hash") / 10)
    first = (step % n).cast("int")
    period = (1 + F.floor((n - first) / (3 + step % 8))).cast("int")

    def word(i):
        place = F.when(i < F.col("_first"), i).otherwise(F.col("_first") + (i - F.col("_first")) % F.col("_period"))
        return F.get(F.col("_words"), place)

    planted = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    chosen = (F.col("_hash") % 10 == 0) & (F.size("_words") > 0)
    words = F.when(F.col("_hash") % 10 == 0, words_of(F.col("text"))).otherwise(F.array().cast("array<string>"))
    rows = docs.withColumn("_hash", _crc32("doc_id")).withColumn("_words", words)
    rows = rows.withColumns({"_first": F.when(chosen, first), "_period": F.when(chosen, period)})
    return rows.select("doc_id", F.when(chosen, planted).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.find_runs(docs).withColumn("best", periodic.strongest_run("periodic_runs"))
    line = F.transform("periodic_runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        _digest("collapsed").alias("collapsed_sha256"),
    )
