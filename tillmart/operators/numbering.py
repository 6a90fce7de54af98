"""Dense, reproducible surrogate keys without a single-partition sort."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.workspace import Workspace

_SLICE = "_slice"
_ROW = "_row"
_ROW_BITS = 33  # low bits of monotonically_increasing_id: position inside the partition


def number_rows(df: DataFrame, order: Sequence[str], key: str, workspace: Workspace, name: str) -> DataFrame:
    """Add ``key`` = 1..N in ascending ``order``, NULLs first.

    ``order`` must be total. Rows are range-partitioned on all of it, so a frequent first
    column is split like any other. The sorted slices are written once with their position;
    the key is the position plus the number of rows in the slices before, which come from a table
    of one row per slice. The result does not depend on where Spark cuts the slices.
    """
    ascending = [F.col(c).asc_nulls_first() for c in order]
    sliced = df.repartitionByRange(*ascending).sortWithinPartitions(*ascending)
    placed = sliced.select(
        "*",
        F.spark_partition_id().alias(_SLICE),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(_ROW),
    )
    stored = workspace.store(name, placed)
    counts = stored.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("_n"), F.max(_ROW).alias("_last"))
    before = F.sum("_n").over(W.orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1))  # over slices, not rows
    starts = counts.withColumn("_before", F.coalesce(before, F.lit(0)))
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    torn = F.coalesce(F.sum((F.col("_last") + 1 != F.col("_n")).cast("int")), F.lit(0))
    starts = workspace.store(f"{name}_starts", starts.observe(seen, torn.alias("torn")))
    if seen.get["torn"]:
        raise ValueError(f"a slice of {name} has more than 2**{_ROW_BITS} rows; use more shuffle partitions")
    # One row per slice: as small as the list of a scan's files, whatever the rows.
    placed_at = stored.join(F.broadcast(starts.select(_SLICE, "_before")), _SLICE)
    return placed_at.select(*df.columns, (F.col("_before") + F.col(_ROW) + 1).alias(key))


def same_values(left: DataFrame, right: DataFrame, columns: Sequence[str], prefix: str = "_known_") -> Column:
    """Whether rows agree in ``columns``, NULLs included; on the right they carry ``prefix``."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[prefix + c]) for c in columns])


def number_onto(df: DataFrame, known: DataFrame, order: Sequence[str], key: str, workspace: Workspace, name: str) -> DataFrame:
    """Add ``key``: rows that agree with a row of ``known`` (key and ``order`` columns) in ``order`` get its
    key, the others the numbers after the largest known one, in ascending ``order``.

    ``order`` must be total in both. Only rows without a known key are numbered, so a load that brings
    few new members sorts few.
    """
    held = known.select(F.col(key), *[F.col(c).alias(f"_known_{c}") for c in order])
    found = df.join(held, same_values(df, held, order), "left").select(*df.columns, key)
    found = workspace.store(f"{name}_found", found)
    last = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("_last"))  # one row
    fresh = number_rows(found.where(F.col(key).isNull()).drop(key), order, key, workspace, name)
    fresh = fresh.join(F.broadcast(last)).select(*df.columns, (F.col(key) + F.col("_last")).alias(key))
    return found.where(F.col(key).isNotNull()).unionAll(fresh)
