"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of code points per language and hash bucket in all training documents;
the counts are summed by Spark. The model is one row of log-probabilities per language, of a
fixed number of buckets, broadcast ``AT_ONCE`` languages at a time. Scoring adds up rows per batch in numpy.

Defined cases: a null text or one without a letter is ``und`` with score 0; without any training
row every text is ``und``. Ties go to the smallest language name. Languages are the distinct
non-null values of ``lang``; more than ``AT_ONCE`` of them are counted and scored in several passes, with the
same result, so neither the driver nor a task holds more than that many rows of the matrix.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.frames import add_columns
from tillmart.llm.hashing import segment_sums, slices

UNKNOWN = "und"
BUCKETS = 1 << 15
ORDERS = (2, 3)
SMOOTHING = 0.5
#: Languages whose rows of the matrix (a quarter of a megabyte each) are held at a time.
AT_ONCE = 256
_ASCII_LETTER = re.compile("[A-Za-z]")
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(c.isalpha() for c in text))


def char_ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order the bucket of the n-gram at every code point (``BUCKETS``: it leaves the text), and
    the texts' offsets."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in lowered], dtype=np.int64)])
    for n in ORDERS:
        total = len(points)
        buckets = np.full(total, BUCKETS, np.int64)
        if total >= n:
            mixed = np.full(total - n + 1, np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF), np.uint32)
            for k in range(n):
                mixed = (mixed ^ points[k : total - n + 1 + k]) * _MULTIPLIERS[k]
                mixed ^= mixed >> np.uint32(15)
            buckets[: total - n + 1] = mixed % np.uint32(BUCKETS)
            for k in range(1, n):
                ends = offsets[1:] - k
                buckets[ends[ends >= offsets[:-1]]] = BUCKETS
        yield buckets, offsets


@dataclass
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray  # per language
    log_prob: np.ndarray  # language x bucket; one more column of zeros
    documents: float  # that the model was trained on

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.repeat(self.log_prior[None, :], len(texts), 0)
        for buckets, offsets in char_ngrams(texts):
            for k, row in enumerate(self.log_prob):
                out[:, k] += segment_sums(row[buckets], offsets)
        return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one task, per language and bucket; bucket -1 counts documents."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch):
            langs = np.array(part.column(0).to_pylist(), object)
            texts = np.array([t or "" for t in part.column(1).to_pylist()], object)
            for lang in set(langs):
                own = [t for t in texts[langs == lang]]
                held = counts.setdefault(lang, np.zeros(BUCKETS + 2, np.int64))
                held[BUCKETS + 1] += len(own)
                for buckets, _ in char_ngrams(own):
                    held[: BUCKETS + 1] += np.bincount(buckets, minlength=BUCKETS + 1)
    for lang, held in counts.items():
        held[BUCKETS] = 0  # n-grams cut off by the end of a text
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at)), pa.array(np.where(at > BUCKETS, -1, at), pa.int32()), pa.array(held[at])],
            names=["lang", "bucket", "n"],
        )


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """The model of all rows whose language is known. Counts reach the driver as at most
    languages x buckets sums."""
    known = rows.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = known.mapInArrow(_counted, "lang string, bucket int, n bigint")
    sums = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names, buckets = np.array(sums["lang"].to_pylist(), object), sums["bucket"].to_numpy()
    n = sums["n"].to_numpy().astype(float)
    languages = sorted(set(names))
    prior = np.ones(len(languages))
    prob = np.zeros((len(languages), BUCKETS + 1))
    for k, name in enumerate(languages):
        own, grams = names == name, (names == name) & (buckets >= 0)
        prior[k] = n[own & (buckets < 0)].sum()
        prob[k, buckets[grams]] = n[grams]
        prob[k, :BUCKETS] = np.log((prob[k, :BUCKETS] + SMOOTHING) / (prob[k].sum() + SMOOTHING * BUCKETS))
    return LanguageModel(languages, np.log(prior / prior.sum()) if len(prior) else prior, prob, prior.sum())


def predict(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the posterior probability of that language."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def score(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        own = held.value
        for column in columns:
            raw = column.to_pylist()
            names, best = [UNKNOWN] * len(raw), np.zeros(len(raw))
            if own.languages:
                logs = own.scores([t or "" for t in raw])
                at = logs.argmax(1)
                top = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
                for i, t in enumerate(raw):
                    if has_letter(t):
                        names[i], best[i] = own.languages[at[i]], top[i]
            yield [pa.array(names, pa.string()), pa.array(best, pa.float64())]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return add_columns(df, text, fields, score)


def _ranked(df: DataFrame, model: LanguageModel, text: str) -> DataFrame:
    """``df`` with ``part_`` (name, log and log of the sum): the best language of one model, and what all of
    its languages add up to; null without a letter."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def score(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        own = held.value
        for column in columns:
            raw = column.to_pylist()
            logs = own.scores([t or "" for t in raw]) + np.log(own.documents)
            at, top = logs.argmax(1), logs.max(1)
            total = top + np.log(np.exp(logs - top[:, None]).sum(1))
            rows = [{"name": own.languages[at[i]], "log": top[i], "total": total[i]} if has_letter(t) else None for i, t in enumerate(raw)]
            yield [pa.array(rows, pa.struct([("name", pa.string()), ("log", pa.float64()), ("total", pa.float64())]))]

    kind = T.StructType([T.StructField("name", T.StringType()), T.StructField("log", T.DoubleType()), T.StructField("total", T.DoubleType())])
    return add_columns(df, text, [T.StructField("part_", kind)], score)


def identify(df: DataFrame, rows: DataFrame, text: str = "text", lang: str = "lang", train_text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, learned from ``rows``, whatever the number of languages."""
    names = rows.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang")).distinct().orderBy("lang")
    found = [r["lang"] for r in names.limit(AT_ONCE + 1).collect()]
    if len(found) <= AT_ONCE:
        return predict(df, train(rows, train_text, lang), text)
    best = F.lit(None).cast("struct<name: string, log: double, total: double>")
    df = df.withColumn("best_", best)
    while found:
        some = found[:AT_ONCE]
        df = _ranked(df, train(rows.where(F.col(lang).between(some[0], some[-1])), train_text, lang), text)
        high, low = F.greatest("best_.total", "part_.total"), F.least("best_.total", "part_.total")
        total = (high + F.log1p(F.exp(low - high))).alias("total")
        winner = F.when(F.col("part_.log") > F.col("best_.log"), F.col("part_")).otherwise(F.col("best_"))  # ties: the smaller name
        both = F.struct(winner["name"].alias("name"), winner["log"].alias("log"), total)
        df = df.withColumn("best_", F.when(F.col("best_").isNull(), F.col("part_")).when(F.col("part_").isNull(), F.col("best_")).otherwise(both)).drop("part_")
        found = [r["lang"] for r in names.where(F.col("lang") > some[-1]).limit(AT_ONCE).collect()]
    score = F.coalesce(F.exp(F.col("best_.log") - F.col("best_.total")), F.lit(0.0))
    return df.withColumns({"lang_pred": F.coalesce("best_.name", F.lit(UNKNOWN)), "score": score}).drop("best_")
