"""Operator 5, toxicity by compression distance: which of two zstandard dictionaries shortens a text more."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cardmill.llm.common import free, ship

WINDOW_BYTES = 128
LEVEL = 9
SHARED_BYTES, OWN_BYTES = 8192, 2048
TELLING_SHARE, TELLING_RATIO = 0.01, 20
# Bound of the training sample: documents of each class, and bytes of a document that may be in it.
TOXIC_DOCS, ORDINARY_DOCS, SAMPLE_DOC_BYTES = 3000, 6000, 16384
FITTED = 0.7  # the part of the sample that makes the dictionaries; the rest calibrates


@dataclass
class ToxicityModel:
    """Two dictionaries of equal length and the weights that turn window differences into a probability."""

    ordinary: bytes
    toxic: bytes
    weights: list[float] = field(default_factory=lambda: [-4.0, 0.0, 0.0, 0.0])


def windows(text: bytes) -> Iterator[bytes]:
    """Pieces of at most WINDOW_BYTES that cover the whole text, cut at a blank where there is one."""
    at, n = 0, len(text)
    while at < n:
        end = min(n, at + WINDOW_BYTES)
        if end < n:
            blank = text.rfind(b" ", at + WINDOW_BYTES // 2, end)
            end = blank if blank > 0 else end
        yield text[at:end]
        at = end


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


class Scorer:
    """Compressors of a model; one for each task."""

    def __init__(self, model: ToxicityModel) -> None:
        self.weights = np.array(model.weights)
        self.ordinary, self.toxic = (self._compressor(x) for x in (model.ordinary, model.toxic))

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def features(self, text: bytes) -> tuple[float, float, float]:
        """Bytes saved by the toxic dictionary: the most in a window, the mean, and the share of windows over 1."""
        n = total = high = 0
        best = 0
        for piece in windows(text):
            saved = len(self.ordinary.compress(piece)) - len(self.toxic.compress(piece))
            n, total, high, best = n + 1, total + saved, high + (saved >= 2), max(best, saved)
        return (best, total / n, high / n) if n else (0.0, 0.0, 0.0)

    def score(self, text: bytes) -> float:
        logit = self.weights[0] + float(np.dot(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, ridge: float = 1e-2) -> list[float]:
    """Weights of a logistic curve by Newton steps on standardised columns; each row counts as often as ``times``."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z.T * (times * p * (1 - p))) @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, z.T @ (times * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[1:] / scale
    return [float(w[0] - slopes @ mean), *map(float, slopes)]


def _contexts(texts: list[bytes]) -> Counter:
    """For each word the number of different words before it; copies of a text or passage add nothing."""
    pairs: set[tuple[bytes, bytes]] = set()
    for text in texts:
        words = text.split()
        pairs.update(zip([b"", *words], words, strict=False))
    return Counter(word for _, word in pairs)


def fit(sample: Iterable[tuple[bytes, int]], counts: tuple[int, int] | None = None) -> ToxicityModel:
    """Train on (text, toxic) pairs in a stable order.

    ``counts`` are the ordinary and the toxic documents that the sample was drawn from, by default those in it. The
    curve is fitted with the classes in these shares, so a score means the same however the sample was bounded.

    Both dictionaries end in the same part, trained on ordinary text. Before it the toxic one holds a part trained
    on toxic text reduced to telling words: those with at least TELLING_SHARE contexts a toxic text, and with
    TELLING_RATIO times as many as in ordinary ones; the ordinary dictionary holds filler there. So a window
    is shortened by what toxic texts share alone. A sample without toxic text gives a low score to everything.
    """
    rows = list(sample)
    split = {0: [], 1: []}
    for text, label in rows:
        split[int(label)].append(text)
    cut = {k: max(1, int(len(v) * FITTED)) for k, v in split.items()}
    ordinary, toxic = split[0][: cut[0]], split[1][: cut[1]]
    if not toxic or not ordinary:
        return ToxicityModel(b"\0" * 16, b"\0" * 16)
    known, found = _contexts(ordinary), _contexts(toxic)
    least = max(3, math.ceil(len(toxic) * TELLING_SHARE))
    ratio = TELLING_RATIO * len(toxic) / len(ordinary)
    telling_words = {w for w, n in found.items() if n >= least and n >= ratio * known[w]}
    telling = [b" ".join(w for w in t.split() if w in telling_words) for t in toxic]
    own = _dictionary([t for t in telling if len(t) > 8], OWN_BYTES)
    shared = _dictionary([w for t in ordinary for w in windows(t)], SHARED_BYTES)
    model = ToxicityModel(b"\0" * len(own) + shared, own + shared)
    rest = [(t, k) for k in (0, 1) for t in (split[k][cut[k] :] or split[k])]
    scorer = Scorer(model)
    x = np.array([scorer.features(t) for t, _ in rest], dtype=float)
    y = np.array([k for _, k in rest])
    of_class = np.array(counts if counts and all(counts) else [len(split[k]) for k in (0, 1)], dtype=float)
    times = of_class / of_class.sum() * len(y) / np.bincount(y, minlength=2)
    model.weights = _logistic(x, y.astype(float), times[y])
    return model


def _labelled(labels: DataFrame, usable: Column, id_col: str, label_col: str) -> DataFrame:
    """One row for each id with a usable label."""
    mine = labels.where(usable & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_llm_id"))
    return mine.agg(F.max(label_col).alias("_llm_label"))


def class_counts(labels: DataFrame, usable: Column, id_col: str, label_col: str) -> tuple[int, int]:
    """How many ids the usable labels call ordinary and toxic, over the whole table."""
    rows = _labelled(labels, usable, id_col, label_col).groupBy("_llm_label").count().collect()
    n = {int(r["_llm_label"]): r["count"] for r in rows}
    return n.get(0, 0), n.get(1, 0)


def training_sample(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str, label_col: str
) -> list[tuple[bytes, int]]:
    """At most TOXIC_DOCS and ORDINARY_DOCS labelled texts of at most SAMPLE_DOC_BYTES, in an order by id hash.

    This is the one thing that comes to the driver: its size is bounded by these three parameters. The bounds
    change the shares of the classes; ``class_counts`` has the true ones.
    """
    mine = _labelled(labels, usable, id_col, label_col).withColumn("_llm_order", F.xxhash64("_llm_id"))
    picked = None
    for label, most in ((1, TOXIC_DOCS), (0, ORDINARY_DOCS)):
        part = mine.where(F.col("_llm_label") == label).orderBy("_llm_order", "_llm_id").limit(most)
        picked = part if picked is None else picked.union(part)
    texts = docs.select(F.col(f"`{id_col}`").alias("_llm_id"), F.col(f"`{text_col}`").cast("binary").alias("_llm_text"))
    short = texts.where(F.octet_length("_llm_text").between(1, SAMPLE_DOC_BYTES))
    rows = short.join(F.broadcast(picked), "_llm_id").select("_llm_order", "_llm_id", "_llm_text", "_llm_label")
    # Ids that repeat in the table could exceed the bound.
    rows = rows.orderBy("_llm_order", "_llm_id", "_llm_text").limit(TOXIC_DOCS + ORDINARY_DOCS).collect()
    return [(bytes(r["_llm_text"]), r["_llm_label"]) for r in rows]


def score_texts(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Adds the probability that a text is toxic, over all windows of the whole text.

    Null and empty texts have no window and get the score of no difference. Equal texts get equal scores; other
    columns pass through, and an input column named like the score is replaced.
    """
    docs = free(docs, score_col)
    ship(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in source:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.large_binary()).to_pylist()
            scores = pa.array([scorer.score(t or b"") for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, score_col])

    return docs.mapInArrow(batches, StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))
