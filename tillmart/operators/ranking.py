"""Deterministic top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], tie_break: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows; equal ranks are resolved by ``tie_break``, ascending, NULLs first.

    Sort and limit become one operator that keeps k rows per task, not a full sort.
    """
    return df.orderBy(*order, *[F.col(c).asc_nulls_first() for c in tie_break]).limit(k)
