import pytest
from pyspark.sql import functions as F

from tillmart.llm.queries import ship
from tillmart.workspace import Workspace

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "The quick brown fox. " * 9000
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b\x0c\r ", "en", "a", 7),
    (4, "one", "en", "a", 3),
    (5, LONG, "en", "b", len(LONG)),
    (6, LONG, "en", "b", len(LONG)),
    (6, LONG, "en", "b", len(LONG)),
    (7, "日本語 😀 ñ É ß \x00 end", "es", "b", 20),
    (8, "1234 5678 !!! ???", None, "c", 17),
    (None, "a text without an id", "en", "c", 20),
    (None, None, None, None, None),
    (9, "One\n", "fr", None, 4),
]
#: Names that operators use themselves.
CLASHING = ["key", "score", "size", "tie", "node", "label", "bucket", "ids", "block", "train", "copies", "packed"]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture()
def workspace(spark):
    return Workspace(spark)


@pytest.fixture()
def docs(spark):
    def make(rows, clashing=False):
        df = spark.createDataFrame(rows, SCHEMA)
        return df.withColumns({c: F.lit("own") for c in CLASHING}) if clashing else df

    return make


@pytest.fixture()
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
