"""A training corpus from raw documents, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the
next stage's ``docs``. All but the last return the columns of ``docs``.

| Stage | Keeps |
|---|---|
| language | documents whose language the model names with a probability of 0.5 or more |
| exact_dedup | of equal texts the longest, then the smallest id |
| near_dedup | of every group of near copies the document with the smallest id |
| mixing | every document as often as the mix takes it: complete epochs, then the fractional part |
| tokens | ids, n_tokens, the decoded text and digests of the ids and of that text beside each document's id |

Empty tables pass through all stages. Rows that repeat an id and a text are one document after exact
dedup. An id stays with all its texts if one of them stays; in exact dedup documents without an id are
treated as one id in this respect, in near dedup each goes by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import bpe, exact, language, minhash, mixing
from tillmart.llm.frames import fold
from tillmart.llm.queries import VOCABULARY, ship
from tillmart.workspace import Workspace

LEAST_PROBABILITY = 0.5


def _own(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select([F.col(f"`{c}`") for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents whose language is given; drops those of no known language."""
    ship(spark)
    # The prediction's column names must not clash with the documents' own.
    named = docs.select(*[F.col(f"`{c}`").alias(f"own_{c}") for c in docs.columns])
    found = language.identify(named, docs.where(fold("doc_id", 5) != 0), "own_text")
    known = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_PROBABILITY))
    return known.select(*[F.col(f"`own_{c}`").alias(c) for c in docs.columns])


def _kept(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id, or null, is in ``kept``."""
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id_"]), "left_semi")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops copies. Ids that are there several times, with equal texts, are rare: only their rows are
    compared once more."""
    ship(spark)
    workspace = Workspace(spark)
    found = exact.groups(docs, workspace).where("kept").select(F.col("doc_id").alias("kept_id_"), "n_keep")
    found = workspace.store("kept", found)
    repeated = found.where("n_keep > 1").select("kept_id_").distinct()
    if repeated.isEmpty():
        return _kept(docs, found)
    once = _kept(docs, found.join(repeated, found["kept_id_"].eqNullSafe(repeated["kept_id_"]), "left_anti"))
    normal = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", "")
    again = _kept(docs, repeated).withColumn("key_", F.md5(normal)).dropDuplicates(["doc_id", "key_"])
    return once.unionAll(_own(again, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = minhash.groups(docs, Workspace(spark))
    kept = found.where("kept").select(F.col("doc_id").alias("kept_id_"), F.col("own").alias("kept_text_")).distinct()
    same = docs["doc_id"].eqNullSafe(kept["kept_id_"]) & (minhash.text_hash("text") == kept["kept_text_"])
    return docs.join(kept, same, "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix; one that is taken n times has n rows. Empty documents are taken as often
    as their source's epochs say."""
    workspace = Workspace(spark)
    rows = mixing.mix(docs, workspace).select(F.col("doc_id").alias("mixed_id_"), F.col("tie").alias("tie_"), "copies")
    rows = rows.groupBy("mixed_id_", "tie_").agg(F.sum("copies").alias("copies_"), F.count(F.lit(1)).alias("rows_"))
    mixed = workspace.store("mixed", rows)

    def taken(part: DataFrame) -> DataFrame:
        same = docs["doc_id"].eqNullSafe(part["mixed_id_"]) & (mixing.tie_of("text") == part["tie_"])
        return docs.join(part.where("copies_ > 0"), same)

    repeated = mixed.where("rows_ > 1")
    found = taken(mixed.where("rows_ = 1"))
    if not repeated.isEmpty():  # equal rows: one of them is repeated as often as all are taken
        found = found.unionAll(taken(repeated).dropDuplicates(["mixed_id_", "tie_"]))
    return _own(found.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("copies_").cast("int")))), docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.digests(docs.select("doc_id", "text"), VOCABULARY).drop("text")


STAGES = [
    ("language", identify_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: SQL can't express the tokeniser, the language model and the signatures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    workspace = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = workspace.store(f"stage_{name}", stage(spark, docs, sf_dir))
    return docs
