"""Toxicity classifier: a factorization machine over hashed terms.

Terms of a text are its distinct lower-case words, without the signs around and inside them, and the
words' first four and five bytes, hashed into ``BUCKETS`` buckets. A text's score is the logistic function of
bias + sum of w[i] x[i] + sum over pairs i < j of <v[i], v[j]> x[i] x[j]: an additive part and learned
interactions, so that two terms that are harmless alone can count together. The pairs cost one pass per
factor: half of (sum of v x) squared minus the sum of (v x) squared. x falls slowly with the number of terms, so
a long text is not toxic by its length and one insult in it still counts.

Training takes a bounded sample of labelled rows (``SAMPLE`` pairs of id and text, smallest hash first), whose terms
are taken where the texts stand. ``SHARDS`` tasks learn row by row from a common start, weights by FTRL-proximal steps, factors
by AdaGrad; what they learned is averaged, and the average is the next round's start, so factors keep their
directions. Scoring is one pass over all texts with the broadcast model, whose size is fixed.

Defined cases: null and empty texts, and texts without a letter or digit, have the score of the bias alone.
Labels other than 0 and 1 and rows without id are left out; of several labels of one id the mean decides, 0.5
counts as 1. Rows that repeat an id and a text train once, an id with several texts once a text, and the bound
holds for all of them. Without training rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.frames import add_columns
from tillmart.llm.hashing import segment_sums, span_hashes, text_bytes, word_spans
from tillmart.workspace import Workspace

BITS, FACTORS = 17, 8
BUCKETS = 1 << BITS
SAMPLE, SHARDS, ROUNDS = 20_000, 4, 4
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.7, 1e-3
RATE, SHRINK, SPREAD = 0.02, 1e-3, 0.01
#: x is the number of a text's terms to this power.
FALL = -0.25
#: Bytes of a word's beginnings that are terms too.
STEMS = (4, 5)

#: Columns of what a shard's learner has moved, see ``Learner.moved``.
_MOVED = ("weights_at", "weights", "factors_at", "factors")

_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # a row per factor

    def scores(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of every text, given its distinct buckets."""
        x = np.maximum(1, np.diff(offsets)) ** FALL
        out = self.bias + x * segment_sums(self.weights[buckets].astype(float), offsets)
        for v in self.factors:
            own = v[buckets].astype(float)
            out += 0.5 * x * x * (segment_sums(own, offsets) ** 2 - segment_sums(own * own, offsets))
        return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of every text's terms, in order, and per text the offset of its first."""
    raw, offsets = text_bytes(texts)
    raw = np.where(_TERM[raw], raw, np.uint8(32))
    starts, ends, first = word_spans(raw, offsets)
    of = np.repeat(np.arange(len(texts)), np.diff(first))
    found = [np.zeros(0, np.int64)]
    for kind, most in enumerate((None, *STEMS)):
        hashes = span_hashes(raw, starts, ends if most is None else np.minimum(ends, starts + most))
        salt = np.uint64((kind * 0x9E3779B97F4A7C15) % 2**64)
        found.append(((hashes ^ salt) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(64 - BITS)).astype(np.int64) + (of << BITS))
    pairs = np.unique(np.concatenate(found))
    return pairs & (BUCKETS - 1), np.searchsorted(pairs >> BITS, np.arange(len(texts) + 1))


class Learner:
    """The state of training: FTRL-proximal sums for weights and bias (the last), so that rare terms stay at
    0, and factors, whose AdaGrad sums begin anew with every round."""

    def __init__(self, start: tuple[np.ndarray, ...] | None = None) -> None:
        fresh = start or (np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1), np.random.default_rng(13).normal(0, SPREAD, (BUCKETS, FACTORS)))
        self.z, self.n, self.v = [a.copy() for a in fresh]
        self.seen = np.ones((BUCKETS, FACTORS))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        free = np.where(np.arange(BUCKETS + 1)[at] == BUCKETS, 0.0, L1)
        return -np.sign(z) * np.maximum(np.abs(z) - free, 0) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def update(self, at: np.ndarray, label: int) -> None:
        x = max(1, len(at)) ** FALL
        both, w = np.append(at, BUCKETS), np.full(len(at) + 1, x)
        w[-1] = 1.0
        weights, own = self.weights(both), self.v[at] * x
        total = own.sum(0)
        z = weights @ w + 0.5 * (total @ total - (own * own).sum())
        g = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - label
        n = self.n[both]
        self.n[both] = n + (g * w) ** 2
        self.z[both] += g * w - (np.sqrt(self.n[both]) - np.sqrt(n)) / ALPHA * weights
        slope = g * x * (total - own) + SHRINK * self.v[at]
        self.seen[at] += slope**2
        self.v[at] -= RATE * slope / np.sqrt(self.seen[at])

    def model(self) -> Model:
        w = self.weights()
        return Model(float(w[-1]), w[:-1].astype(np.float32), np.ascontiguousarray(self.v.T, np.float32))

    def state(self) -> tuple[np.ndarray, ...]:
        """What a round starts from; ``seen`` begins anew with every round."""
        return self.z, self.n, self.v

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """The state in single precision: z and n as columns, and the factors."""
        return np.stack([self.z, self.n], 1).astype(np.float32), self.v.astype(np.float32)

    def moved(self, start: Learner) -> list[bytes]:
        """Buckets whose numbers differ from the start's, and by how much."""
        sent = []
        for own, was in zip(self.packed(), start.packed()):
            at = np.flatnonzero((own != was).any(1))
            sent += [at.astype(np.int32).tobytes(), (own[at] - was[at]).tobytes()]
        return sent

    def mix(self, others: Iterable[Sequence[bytes]]) -> None:
        """Take over what learners that started from this state have learned, as ``moved`` tells it: every number
        moves by the mean over the learners that moved it, so a term that one of them met counts in full."""
        new = self.packed()
        sums, times = [np.zeros_like(a) for a in new], [np.zeros(a.shape, np.int8) for a in new]
        for sent in others:
            for k in range(len(new)):
                at = np.frombuffer(sent[2 * k], np.int32)
                by = np.frombuffer(sent[2 * k + 1], np.float32).reshape(len(at), new[k].shape[1])
                sums[k][at] += by
                times[k][at] += by != 0
        pairs, self.v = [a + (s / np.maximum(1, t, dtype=float)) for a, s, t in zip(new, sums, times)]
        self.z, self.n = pairs[:, 0].copy(), pairs[:, 1].copy()
        self.seen = np.ones(self.v.shape)


def _learning(sent: Broadcast, turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """What one task learns from its rows, in an order that changes from round to round."""

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        start = Learner(sent.value)
        own = Learner(sent.value)
        frame = frame.sort_values(["key", "doc_id"])
        for k in np.random.default_rng(turn).permutation(len(frame)):
            own.update(np.asarray(frame["terms"].iloc[k]), int(frame["label"].iloc[k]))
        return pd.DataFrame([(int(frame["shard"].iloc[0]), *own.moved(start))], columns=["shard", *_MOVED])

    return learn


def train(docs: DataFrame, labels: DataFrame, workspace: Workspace, label: str = "toxic", text: str = "text") -> Model:
    """The model learned from the labelled rows of ``docs``."""
    spark = docs.sparkSession
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    rows = docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
    keyed = rows.withColumn("key", F.xxhash64(F.lit(17), "doc_id", "text"))
    sample = keyed.select("doc_id", "key").distinct().join(marked, "doc_id").orderBy("key", "doc_id").limit(SAMPLE)
    # At most SAMPLE ids and keys go to all tasks; equal rows become one again after their terms are taken.
    chosen = keyed.join(F.broadcast(sample), ["doc_id", "key"]).select("doc_id", "key", "label", "text")

    def cut(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for column in columns:
            buckets, offsets = terms(column)
            yield [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(buckets, pa.int32()))]

    held = add_columns(chosen, "text", [T.StructField("terms", T.ArrayType(T.IntegerType(), False))], cut).drop("text")
    held = held.dropDuplicates(["doc_id", "key"]).withColumn("shard", F.pmod(F.col("key"), F.lit(SHARDS)).cast("int"))
    held = workspace.store("terms", held)
    learner = Learner()
    for turn in range(ROUNDS):
        # The driver holds one round's state: a start of 10 MB, destroyed after its round, and of every shard what moved.
        sent = spark.sparkContext.broadcast(learner.state())
        told = ", ".join(f"{c} binary" for c in _MOVED)
        parts = held.groupBy("shard").applyInPandas(_learning(sent, turn), f"shard int, {told}").collect()
        sent.destroy()
        if not parts:
            return Model(0.0, np.zeros(BUCKETS, np.float32), np.zeros((FACTORS, BUCKETS), np.float32))
        learner.mix([p[c] for c in _MOVED] for p in sorted(parts, key=lambda p: p["shard"]))
    return learner.model()


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score``, the probability of label 1, and ``predicted``."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def score(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for column in columns:
            p = held.value.scores(*terms(column))
            yield [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    return add_columns(df, text, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], score)
