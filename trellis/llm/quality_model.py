"""Quality classifier from supervised subword embeddings.

A word stands for a set of hashed features: itself and its character n-grams (with word
ends).  Each feature has a learned vector; a word's vector is the mean over its features, a
text's the mean over its words and one end mark.  One more feature counts words whose
three-word window occurred before in the text.  A softmax over two classes follows.  Vectors
and output weights are learned together by stochastic gradient descent in numpy.

Training reads a bounded sample of the labelled rows (``max_rows``, the rows of smallest hash
of the id) in one task; labels, class shares and scores cover all rows.  The output is linear
in the text's mean vector, so scoring needs one number per feature, and a word's number is
remembered in a bounded cache.

Defined results: a null text counts as empty and has the end mark alone; a row labelled more
than once counts with its lowest label; rows without a label are not learned from; without
labels of both classes every score is the share of label 1 (0.5 if there are none); repeated
rows are scored alike; other columns are never read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.llm.common import register, table

FOLDS = 4
HELD_OUT = 2
THRESHOLD = 0.7
MAX_ROWS = 6_000
BUCKETS = 1 << 16          # hashed word and n-gram features
DIM = 8
EPOCHS = 4
RATE = 0.2
GRAMS = (3, 4)
CACHE = 300_000
END, SEEN = BUCKETS, BUCKETS + 1


def word_features(word: str) -> list[int]:
    """Hashed features of a word: the word and its character n-grams."""
    whole = f"<{word}>"
    out = [zlib.crc32(whole.encode("utf-8", "surrogatepass")) % BUCKETS]
    for k in GRAMS:
        out += [zlib.crc32(whole[i:i + k].encode("utf-8", "surrogatepass"), k) % BUCKETS for i in range(len(whole) - k + 1)]
    return out


def split_words(text: str | None) -> list[str]:
    """Words between ASCII white space."""
    return [w.decode("utf-8", "surrogatepass") for w in (text or "").encode("utf-8", "surrogatepass").split()]


def windows_seen(words: list[str]) -> int:
    """Three-word windows that occurred before in the text."""
    n = len(words) - 2
    return n - len(set(zip(words, words[1:], words[2:]))) if n > 1 else 0


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct features, their weights; the weights sum to 1)."""
    words = split_words(text)
    weight = Counter()
    for word, n in Counter(words).items():
        ids = word_features(word)
        for f in ids:
            weight[f] += n / len(ids)
    weight[END] = 1.0
    seen = windows_seen(words)
    if seen:
        weight[SEEN] = float(seen)
    ids = np.fromiter(weight.keys(), np.int64, len(weight))
    w = np.fromiter(weight.values(), np.float64, len(weight))
    return ids, w / w.sum()


@dataclass(frozen=True)
class Model:
    """Log-odds of label 1: the weighted mean of ``value`` over the features, plus ``bias``."""

    value: np.ndarray
    bias: float


def train(texts: list[str | None], labels: list[int], seed: int = 7) -> Model:
    """Learn feature vectors and output weights."""
    share = (sum(labels) + 1) / (len(labels) + 2) if labels else 0.5
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS + 2, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + 2, DIM))
    out, bias = np.zeros((DIM, 2)), np.zeros(2)
    rows = [text_features(t) for t in texts]
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            rate = RATE * (1 - done / steps)
            done += 1
            ids, w = rows[i]
            mean = w @ vectors[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1                     # gradient of the loss in z
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * p
            vectors[ids] -= (rate / (w @ w)) * w[:, None] * back     # moves the mean by rate * back
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


class WordValues(dict):
    """Mean feature value of a word, remembered up to a bound."""

    def __init__(self, value: np.ndarray):
        super().__init__()
        self.value = value

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHE:
            self.clear()
        ids = word_features(word.decode("utf-8", "surrogatepass"))
        self[word] = out = float(self.value[ids].mean())
        return out


def score(texts: list[str | None], model: Model, values: WordValues) -> np.ndarray:
    """Probability of label 1 for each text."""
    out = np.empty(len(texts))
    end, seen_value = float(model.value[END]), float(model.value[SEEN])
    for i, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        seen = windows_seen(words)
        total = sum(map(values.__getitem__, words)) + end + seen * seen_value
        out[i] = total / (len(words) + 1 + seen) + model.bias
    return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def fold_of(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, text, label of at most ``max_rows`` rows to learn from: never the held-out fold.

    An id stands once, with the least of its texts, however many rows it has."""
    known = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("label"))
             .filter(fold_of(F.col("doc_id")) != HELD_OUT))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")      # at most max_rows ids
            .groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("label").alias("label")))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Train in one task on the bounded sample; only the model comes to the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        rows = (pd.concat(parts) if parts else pd.DataFrame(columns=["doc_id", "text", "label"]))
        rows = rows.sort_values("doc_id")
        model = train(rows["text"].tolist(), [int(x) for x in rows["label"]])
        yield pd.DataFrame({"value": [model.value.tobytes()], "bias": [model.bias]})

    got = (training_rows(docs, labels, max_rows).repartition(1)
           .mapInPandas(run, "value binary, bias double").first())          # one row
    if got is None:                                                         # no labelled row at all
        return train([], [])
    return Model(np.frombuffer(got["value"], np.float32), got["bias"])


def add_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # a fixed number of features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = WordValues(shared.value.value)
        for b in batches:
            scores = score(b.column("text").to_pylist(), shared.value, values)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


@register("op7_quality_embeddings")
def op7_quality_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; the held-out fold was never learned from."""
    docs = table(spark, sf_dir, "documents")
    scored = add_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
