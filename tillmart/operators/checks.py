"""Integrity checks of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, or are NULL: ``key, rows``."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where((F.col("rows") > 1) | F.col(key).isNull())


def orphan_keys(fact: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """Foreign keys without a member and their row count: ``key, rows``.

    The fact is reduced to its distinct keys first, so a frequent key travels once per map
    task. NULL is no reference and no orphan.
    """
    used = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(members.select(key), key, "left_anti")


def violation_counts(found: DataFrame) -> DataFrame:
    """Number of violating keys and of the rows that carry them."""
    return found.agg(F.count(F.lit(1)).alias("bad_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("bad_rows"))


def key_extent(df: DataFrame, key: str) -> DataFrame:
    """One row: ``n_rows, n_keys`` (not NULL), ``n_distinct, low, high``.

    Distinct keys are counted exactly, in bitmaps of 32,768 keys each. What is shuffled is one bitmap of four
    kilobytes per range of keys and map task: with dense keys, stored in order, about a bit per key.
    """
    value = F.col(key).cast("bigint")
    ranges = df.groupBy(F.bitmap_bucket_number(value).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(value).alias("keys"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(value))).alias("distinct"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    known = F.when(F.col("range").isNotNull(), F.col("distinct"))
    return ranges.agg(
        total("rows").alias("n_rows"), total("keys").alias("n_keys"), total(known).alias("n_distinct"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
