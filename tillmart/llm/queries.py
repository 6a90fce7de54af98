"""The operators as named queries over the given tables."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import bpe, brown, exact, factors, language, lines, merkle, minhash, mixing, quality, spots, turns, warc
from tillmart.llm.frames import fold
from tillmart.llm.oracle import ORACLE
from tillmart.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = table(spark, folder, "documents").select("doc_id", "text"), fold("doc_id", 3) == 1
    weights = quality.train(docs.where(~held_out), table(spark, folder, "labels"))
    return quality.predict(docs, weights).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def near_groups(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.groups(table(spark, folder, "documents"), Workspace(spark)).drop("own")


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.digests(docs, VOCABULARY).drop("text", "ids", "decoded")


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = fold("doc_id", 5) == 1
    docs = table(spark, folder, "documents").select("doc_id", "text", (~held_out).alias("train"))
    return brown.score(docs, Workspace(spark)).withColumn("held_out", ~F.col("train")).drop("train")


def warc_records(spark: SparkSession, folder: str) -> DataFrame:
    headers, payloads = warc.write(table(spark, folder, "pages"), Workspace(spark))
    return warc.read(headers, payloads).drop("record")


def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = table(spark, folder, "documents").select("doc_id", "text", "lang"), fold("doc_id", 5) == 0
    return language.identify(docs.drop("lang"), docs.where(~held_out)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def line_report(spark: SparkSession, folder: str) -> DataFrame:
    """What happens to the lines of every document, and a digest of the text that is left."""
    done = lines.dedup(table(spark, folder, "documents"), Workspace(spark))
    return done.withColumn("cleaned_sha256", F.sha2("text", 256)).drop("text")


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), Workspace(spark))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def exact_groups(spark: SparkSession, folder: str) -> DataFrame:
    return exact.groups(table(spark, folder, "documents"), Workspace(spark)).drop("n_keep")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's code to the executors once per application, as ``--py-files`` would."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        archive = f"{tempfile.mkdtemp(prefix='tillmart-code-')}/tillmart"
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", root, "tillmart"))
        _SHIPPED.add(application)


def _shipping(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


def text_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return spots.fingerprints(table(spark, folder, "documents"), Workspace(spark))


def manifest_proofs(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = F.coalesce(fold("doc_id", 7) == 0, F.lit(False))
    return merkle.audit(table(spark, folder, "documents"), Workspace(spark), columns, {"n_chars": F.col("n_chars") + 1}, changed)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` dropped, emptied, cut, repeated or given another role by their checksum."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = (F.crc32(F.concat_ws(":", *names)) % 20).alias("kind")
    role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role, text, kind).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repaired_conversations(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    found = turns.summary(turns.repair(damaged(conversations), Workspace(spark))).withColumnRenamed("conv_id", "conv_")
    every = conversations.select("conv_id").distinct()
    joined = every.join(found, every["conv_id"].eqNullSafe(found["conv_"]), "left")
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = table(spark, folder, "documents").select("doc_id", "text"), fold("doc_id", 5) == 0
    model = factors.train(docs.where(~held_out), table(spark, folder, "labels"), Workspace(spark))
    return factors.predict(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def registry() -> dict[str, Query]:
    named: dict[str, Query] = {
        "op1_quality": quality_scores,
        "op2_minhash": near_groups,
        "op3_bpe": token_digests,
        "op4_lm": model_scores,
        "op5_warc": warc_records,
        "op6_language": languages,
        "op7_line_dedup": line_report,
        "op8_mixing": mixture,
        "op9_exact_dedup": exact_groups,
        "op10_spotsigs": text_fingerprints,
        "op11_merkle": manifest_proofs,
        "op12_conversations": repaired_conversations,
        "op13_toxicity": toxicity_scores,
    }
    return {name: _shipping(query) for name, query in named.items()}



def oracle() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return dict(ORACLE)
