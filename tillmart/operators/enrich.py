"""The fact with its dimension attributes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.schema import DIMENSIONS, TABLES

# Dimension attributes of the enriched relation and their names in it.
ENRICHED: dict[str, dict[str, str]] = {
    "product": {
        "product_name": "product_name",
        "category": "category",
        "price": "price",
        "brand": "brand",
        "rating": "rating",
        "reviews": "reviews",
        "weight": "weight",
        "color": "color",
        "size": "size",
        "material": "material",
    },
    "customer": {
        "first_name": "customer_first_name",
        "last_name": "customer_last_name",
        "email": "customer_email",
        "country": "customer_country",
        "age": "customer_age",
    },
    "time": {
        "year": "year",
        "month": "month",
        "day": "day",
        "quarter": "quarter",
        "week_day": "week_day",
    },
    "store": {
        "store_name": "store_name",
        "city": "store_city",
        "state": "store_state",
        "country": "store_country",
        "phone": "store_phone",
        "email": "store_email",
    },
    "supplier": {
        "supplier_name": "supplier_name",
        "contact": "supplier_contact",
        "email": "supplier_email",
        "phone": "supplier_phone",
        "city": "supplier_city",
        "country": "supplier_country",
    },
}

# Most members first: the rows are still narrow when they are shuffled to a large dimension,
# and small dimensions are broadcast without moving the rows.
JOIN_ORDER = ("customer", "product", "supplier", "store", "time")

FACT_COLUMNS = TABLES["fact_sales"].names


def attributes(members: DataFrame, name: str, need: Iterable[str] | None = None) -> DataFrame:
    """Key and the needed attributes of one dimension, under their enriched names."""
    wanted = ENRICHED[name] if need is None else {k: v for k, v in ENRICHED[name].items() if v in set(need)}
    return members.select(DIMENSIONS[name].key, *[F.col(k).alias(v) for k, v in wanted.items()])


def attach(rows: DataFrame, members: DataFrame, name: str, need: Iterable[str] | None = None) -> DataFrame:
    """Left join one dimension on its key; rows without a member keep NULL attributes."""
    return rows.join(attributes(members, name, need), DIMENSIONS[name].key, "left")


def enrich(fact: DataFrame, members: dict[str, DataFrame], need: Iterable[str] | None = None) -> DataFrame:
    """The wide sales relation, all 41 columns or the ``need``-ed ones.

    Keys are unique in a dimension, so a dimension that gives no needed column changes
    nothing and is not joined.
    """
    asked = [*FACT_COLUMNS, *[c for cols in ENRICHED.values() for c in cols.values()]]
    if need is not None:
        unknown = set(need) - set(asked)
        if unknown:
            raise ValueError(f"unknown columns: {sorted(unknown)}")
        asked = [c for c in asked if c in set(need)]
    rows = fact
    for name in JOIN_ORDER:
        if any(c in asked for c in ENRICHED[name].values()):
            rows = attach(rows, members[name], name, asked)
    return rows.select(*asked)
