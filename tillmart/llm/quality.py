"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features of a text are its word unigrams and bigrams and the unigrams and bigrams of word shapes
(letter case, digits, signs, whether the word repeats the one before), hashed into a fixed number of
buckets; a feature's value is its share of the text's n-grams. Training takes a bounded sample of
labelled rows (``SAMPLE`` pairs of id and text, smallest hash of the id first), dealt over ``SHARDS`` tasks; each runs the
per-coordinate FTRL-proximal update document by document, and the shards' weights are averaged.
Scoring is a sparse dot product per document in numpy with the broadcast weights.

Defined cases: null and empty texts have the score of the bias alone. Labels other than 0 and 1 and
rows without id are left out; of several labels of one id the mean decides, 0.5 counts as 1. Rows that
repeat an id and a text train once, an id with several texts once a text, and the bound holds for all of
them. Without training rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.frames import add_columns
from tillmart.llm.hashing import mix, segment_sums, span_hashes, text_bytes, word_spans

BUCKETS = 1 << 18
SAMPLE = 20_000
SHARDS = 8
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
#: Shares of a text are small; this brings them to the size that ALPHA suits.
SCALE = 8.0

_KIND = np.zeros(256, np.uint8)  # 1 capital, 2 digit, 3 sign, 4 other letter
_KIND[33:127] = 3
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 4, 2, 4


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, and per text the offset of its first."""
    raw, offsets = text_bytes(texts)
    starts, ends, first = word_spans(raw, offsets)
    words = span_hashes(raw, starts, ends)
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), first * 4
    kinds = _KIND[raw]
    sums = [np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int64)]) for k in (1, 2, 3, 4)]
    capital, digit, sign, letter = (s[ends] - s[starts] for s in sums)
    begins = np.zeros(n, bool)
    begins[first[:-1][first[:-1] < n]] = True
    before = np.where(begins, np.uint64(1), np.roll(words, 1))
    shape = np.minimum(capital, 2) + 3 * np.minimum(digit, 2) + 9 * np.minimum(sign, 3) + 36 * np.minimum(letter, 3)
    last = np.where(kinds[ends - 1] == 3, raw[ends - 1], 0)
    shape = (shape * 256 + last) * 2 + ((words == before) & ~begins)
    shapes = mix(shape.astype(np.uint64) + np.uint64(0x51ED2701))
    shapes_before = np.where(begins, np.uint64(3), np.roll(shapes, 1))
    grams = np.empty((n, 4), np.uint64)
    grams[:, 0], grams[:, 2] = words, shapes
    grams[:, 1] = words * np.uint64(0x9E3779B97F4A7C15) + before
    grams[:, 3] = shapes * np.uint64(0xC2B2AE3D27D4EB4F) + shapes_before
    grams[:, 1::2] = mix(grams[:, 1::2].copy())
    return (grams.reshape(-1) >> np.uint64(46)).astype(np.int64), first * 4


def _documents(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    buckets, offsets = features(texts)
    for low, high in zip(offsets[:-1], offsets[1:], strict=True):
        at, n = np.unique(buckets[low:high], return_counts=True)
        yield at, n * (SCALE / max(1, high - low))


class Ftrl:
    """Logistic regression with per-coordinate learning rates; the last weight is the bias."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.bias = size

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        size = np.abs(z) - L1
        return np.where(size > 0, -np.sign(z) * size / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2), 0.0)

    def update(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, self.bias), np.append(x, 1.0)
        w = self.weights(at)
        gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient**2) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + gradient**2


def _fit(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["turn", "doc_id", "own"])
    model = Ftrl(BUCKETS)
    for _ in range(EPOCHS):
        for start in range(0, len(frame), 256):
            part = frame.iloc[start : start + 256]
            for (at, x), label in zip(_documents(pa.array(part["text"], pa.large_string())), part["label"], strict=True):
                model.update(at, x, label)
    weights = model.weights().astype(np.float32)
    return pd.DataFrame({"shard": [int(frame["shard"].iloc[0])], "rows": [len(frame)], "weights": [weights.tobytes()]})


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text") -> DataFrame:
    """At most ``SAMPLE`` labelled rows of ``docs``: doc_id, own (hash of the text), text, label and turn."""
    turn = F.xxhash64(F.lit(17), "doc_id")
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    rows = docs.select("doc_id", F.col(text).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("own"))
    sample = rows.select("doc_id", "own").distinct().join(marked, "doc_id")  # ids that can't train take no place
    sample = sample.select("doc_id", "own", "label", turn.alias("turn")).orderBy("turn", "doc_id", "own").limit(SAMPLE)
    return rows.join(F.broadcast(sample), ["doc_id", "own"]).dropDuplicates(["doc_id", "own"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text") -> np.ndarray:
    """Weights learned from the labelled rows of ``docs``; the last one is the bias."""
    rows = training_rows(docs, labels, label, text)
    shards = rows.withColumn("shard", F.pmod(F.xxhash64("turn", "own"), F.lit(SHARDS)).cast("int")).groupBy("shard")
    fitted = shards.applyInPandas(_fit, "shard int, rows bigint, weights binary").collect()
    if not fitted:
        return np.zeros(BUCKETS + 1, np.float32)
    parts = [np.frombuffer(r["weights"], np.float32).astype(float) * r["rows"] for r in sorted(fitted, key=lambda r: r["shard"])]
    return (np.sum(parts, 0) / sum(r["rows"] for r in fitted)).astype(np.float32)


def predict(df: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """``df`` with ``score``, the probability of label 1, and ``predicted``."""
    held = df.sparkSession.sparkContext.broadcast(weights)

    def score(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        w = held.value.astype(float)
        for column in columns:
            buckets, offsets = features(column)
            dots = segment_sums(w[buckets], offsets) * (SCALE / np.maximum(1, np.diff(offsets))) + w[-1]
            p = 1 / (1 + np.exp(-np.clip(dots, -35, 35)))
            yield [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return add_columns(df, text, fields, score)
