"""Exact sales measures that roll up.

A report never averages averages: it keeps sums and non-null counts, which add up over any
grouping, and divides once at the end. Money stays decimal until it is published.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ["units", "units_known", "revenue", "revenue_known", "sales"]


def total_sales(fact: DataFrame, *keys: str) -> DataFrame:
    """Sums and counts of the fact per ``keys``; combined on the map side."""
    return fact.groupBy(*keys).agg(
        F.sum("quantity").alias("units"),
        F.count("quantity").alias("units_known"),
        F.sum("total_price").alias("revenue"),
        F.count("total_price").alias("revenue_known"),
        F.count(F.lit(1)).alias("sales"),
    )


def roll_up(totals: DataFrame, *keys: str) -> DataFrame:
    """The same measures on a coarser grouping."""
    return totals.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def amount(column: Column | str) -> Column:
    """Published form of an exact decimal sum."""
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def mean(total: Column | str, count: Column | str) -> Column:
    """Average from an exact sum and a count of known values; NULL if there is none."""
    count = F.col(count) if isinstance(count, str) else count
    return amount(total) / F.when(count > 0, count)
