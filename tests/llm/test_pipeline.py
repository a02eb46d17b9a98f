"""The pipeline stage by stage against plain Python."""

import collections
import hashlib
import re

import tiktoken

import corpus_pipeline
import public_tokenizers
from cardmill.llm.byte_bpe import read_ranks
from cardmill.llm.mixing import mix
from cardmill.session import materialize
from test_lines_and_quality import metrics
from test_near_copies import brute_documents, shingles, tail_pairs

SF = "/root/testdata/sf0.001"
KEY_SPACES = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def kept_by_rules(text):
    n, chars, symbols, lines, repeats = metrics(text)
    return not (n < 50 or 100 * repeats > 50 * n or 2 * symbols > n or chars < 2 * n or chars > 15 * n or 10 * lines > 3 * n)


def without_shared_lines(texts):
    first = {}
    for i in sorted(texts):
        for line in texts[i].split("\n"):
            first.setdefault(line.strip(KEY_SPACES).translate(LOWER), i)
    out = {}
    for i, text in texts.items():
        keys = [(line, line.strip(KEY_SPACES).translate(LOWER)) for line in text.split("\n")]
        out[i] = "\n".join(line for line, key in keys if len(key) < 10 or first[key] == i)
    return out


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "minhash_dedup", "mix_sources", "byte_bpe"]
    expected = {r.doc_id: r.text for r in docs.collect() if kept_by_rules(r.text)}

    step = materialize(stages["quality_rules"](spark, docs, SF), "t1")
    assert {r.doc_id: r.text for r in step.collect()} == expected and 0 < len(expected) < docs.count()
    expected = without_shared_lines(expected)
    step = materialize(stages["line_dedup"](spark, step, SF), "t2")
    assert {r.doc_id: r.text for r in step.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in step.collect())
    _, root, _ = brute_documents(list(expected.items()))
    expected = {i: t for i, t in expected.items() if root[i] == i}
    step = materialize(stages["minhash_dedup"](spark, step, SF), "t3")
    assert {r.doc_id: r.text for r in step.collect()} == expected
    times = {r.doc_id: r.taken // r.size for r in mix(step).collect() if r.size}
    step = materialize(stages["mix_sources"](spark, step, SF), "t4")
    assert step.columns == docs.columns
    assert collections.Counter(r.doc_id for r in step.collect()) == collections.Counter({i: n for i, n in times.items() if n})
    last = corpus_pipeline.run(spark, SF).collect()
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert collections.Counter(r.doc_id for r in last) == collections.Counter({i: n for i, n in times.items() if n})
    for r in last:
        text = expected[r.doc_id]
        assert r.ids == exact.encode_ordinary(text) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert re.fullmatch(r"[0-9a-f]{64}", last[0].ids_sha256)


def test_near_stage_links_from_80_percent(spark, docs):
    texts = tail_pairs(20, 104, 10, 3) + tail_pairs(20, 104, 12, 4)
    alike = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for a, b in zip(texts[::2], texts[1::2])]
    assert all(0.80 <= x < 0.85 for x in alike[:20]) and all(x < 0.80 for x in alike[20:])
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["minhash_dedup"](spark, docs(*texts), SF).collect()}
    assert kept == set(range(0, 40, 2)) | set(range(40, 80))


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
    assert docs.count() == 0
