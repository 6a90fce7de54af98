"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tillmart.llm.hashing import pieces, slices

#: Per Arrow batch of texts: an iterator of the columns to add, in the order of the fields.
Scorer = Callable[[Iterator[pa.Array]], Iterator[list[pa.Array]]]


def add_columns(
    df: DataFrame, text: str, fields: list[T.StructField], scorer: Scorer, most_bytes: int | None = None, with_text: bool = True
) -> DataFrame:
    """``df`` with ``fields`` computed from its text column; columns of those names are replaced. Batches are
    cut by rows, or with ``most_bytes`` by their size. Without ``with_text`` the texts don't come back from Python."""
    names = {f.name for f in fields}
    df = df.select([F.col(f"`{c}`") for c in df.columns if c not in names])
    at = df.columns.index(text)
    back = [k for k in range(len(df.columns)) if with_text or k != at]
    schema = T.StructType([*(df.schema.fields[k] for k in back), *fields])
    added = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def texts() -> Iterator[pa.Array]:
            for batch in batches:
                for part in pieces(batch, most_bytes) if most_bytes else slices(batch):
                    waiting.append(part)
                    yield part.column(at)

        for columns in scorer(texts()):
            part = waiting.pop(0)
            arrays = [c.cast(f.type) for c, f in zip(columns, added, strict=True)]
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in back), *arrays], names=schema.names)

    return df.mapInArrow(run, schema)


def fold(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo n; a null counts as remainder -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % n, F.lit(-1))


#: Bound of the table that ``maybe_among`` broadcasts.
SLOTS = 1 << 20


def maybe_among(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key may be in the only column of ``wanted``: all that are, and some others.

    Saves a shuffle of rows that a join with ``wanted`` would drop anyway. What is broadcast are the
    hash values of the wanted keys, modulo SLOTS: at most SLOTS numbers, whatever the data."""
    slots = wanted.select(F.pmod(F.xxhash64(wanted.columns[0]), F.lit(SLOTS)).cast("int").alias("slot_")).distinct()
    return df.withColumn("slot_", F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")).join(F.broadcast(slots), "slot_", "left_semi").drop("slot_")
