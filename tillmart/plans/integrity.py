"""Integrity of a whole star: one row of violation counts per key.

Keys are numbered 1..N, which proves most stars right without a join. A member table whose N rows hold N
distinct keys from 1 to N has no key twice, none missing and no gaps; a foreign key between 1 and N then
has a member. The members are read once by key, the fact once for the least and largest value of all its
keys. Only what this doesn't prove is counted key by key, with the joins that this takes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.operators.checks import duplicate_keys, key_extent, orphan_keys, violation_counts
from tillmart.schema import FOREIGN_KEYS, PRIMARY_KEYS


def _counted(found: DataFrame, **labels: str) -> DataFrame:
    return violation_counts(found).select(*[F.lit(v).alias(k) for k, v in labels.items()], "bad_keys", "bad_rows")


def _together(spark, label: str, proven: list[str], counts: list[DataFrame]) -> DataFrame:
    """One row per key: nothing wrong where that is proven, else what was counted."""
    fine = spark.createDataFrame([(name, 0, 0) for name in proven], f"{label} string, bad_keys bigint, bad_rows bigint")
    return reduce(DataFrame.unionAll, [*([fine] if proven or not counts else []), *counts])


def dense_members(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Number of members of every table whose keys are proven to be 1..N, by one job."""
    extents = [key_extent(tables[t], key).withColumn("table_name", F.lit(t)) for t, key in PRIMARY_KEYS.items() if t in tables]
    found = reduce(DataFrame.unionAll, extents).collect()
    dense = lambda r: r["n_rows"] == r["n_keys"] == r["n_distinct"] == (r["high"] or 0) and (r["low"] or 1) == 1
    return {r["table_name"]: r["n_rows"] for r in found if dense(r)}


def primary_key_violations(tables: dict[str, DataFrame], dense: dict[str, int] | None = None) -> DataFrame:
    """Repeated or missing member keys: ``table_name, bad_keys, bad_rows``."""
    dense = dense_members(tables) if dense is None else dense
    counts = [_counted(duplicate_keys(tables[t], key), table_name=t) for t, key in PRIMARY_KEYS.items() if t not in dense]
    return _together(tables["fact_sales"].sparkSession, "table_name", [t for t in PRIMARY_KEYS if t in dense], counts)


def keys_within(fact: DataFrame, dense: dict[str, int]) -> list[str]:
    """Foreign keys whose values all lie between 1 and the number of members, by one scan of the fact."""
    asked = [(key, t) for key, t in FOREIGN_KEYS if t in dense]
    if not asked:
        return []
    ends = [end(key).alias(f"{name}_{key}") for key, _ in asked for name, end in (("low", F.min), ("high", F.max))]
    found = fact.agg(*ends).first()
    within = lambda key, n: found[f"low_{key}"] is None or 1 <= found[f"low_{key}"] and found[f"high_{key}"] <= n
    return [key for key, t in asked if within(key, dense[t])]


def foreign_key_violations(tables: dict[str, DataFrame], dense: dict[str, int] | None = None) -> DataFrame:
    """Fact keys without a member: ``foreign_key, bad_keys, bad_rows``."""
    fact = tables["fact_sales"]
    proven = keys_within(fact, dense_members(tables) if dense is None else dense)
    counts = [_counted(orphan_keys(fact, key, tables[t]), foreign_key=key) for key, t in FOREIGN_KEYS if key not in proven]
    return _together(fact.sparkSession, "foreign_key", proven, counts)


def violations(tables: dict[str, DataFrame]) -> int:
    """Number of violating keys in the star."""
    dense = dense_members(tables)
    keys = primary_key_violations(tables, dense).select("bad_keys")
    references = foreign_key_violations(tables, dense).select("bad_keys")
    return keys.unionAll(references).agg(F.sum("bad_keys")).first()[0]
