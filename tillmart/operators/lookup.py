"""Lookup of surrogate keys and the sales fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.operators.numbering import number_onto, number_rows
from tillmart.schema import DIMENSIONS, SALE_DAY, Dimension, conform
from tillmart.workspace import Workspace

BUSINESS_KEY = "business_key"  # all columns of the dimension: one fact per sale
LEAD_COLUMN = "lead_column"  # the lead column alone: one fact per matching member
LOOKUPS = (BUSINESS_KEY, LEAD_COLUMN)

# Small dimensions first: once their key is known their wide columns are dropped, so the
# rows are narrow when they meet a dimension that has to be shuffled.
JOIN_ORDER = ("time", "store", "seller", "supplier", "product", "customer")

# Members of a dimension whose keys are looked up before the sales are numbered: about as many as Spark broadcasts.
EARLY = 500_000

_NEEDED = tuple(DIMENSIONS["customer"].sources)


def match_columns(dim: Dimension, lookup: str) -> list[str]:
    if lookup not in LOOKUPS:
        raise ValueError(f"lookup must be one of {LOOKUPS}, not {lookup!r}")
    return dim.match if lookup == BUSINESS_KEY else [dim.lead]


def find_key(
    sales: DataFrame, dim: Dimension, numbered: DataFrame, lookup: str = BUSINESS_KEY, how: str = "inner"
) -> DataFrame:
    """Add the dimension's key. A NULL lead finds nothing, unless NULL leads are ordinary members of the
    dimension; other NULLs match each other.

    No join hint: the members are Parquet, so Spark knows their size and broadcasts them
    only below its threshold; otherwise it shuffles, and adaptive execution splits a
    frequent key.
    """
    columns = match_columns(dim, lookup)
    member = numbered.select(dim.key, *[F.col(c).alias(f"_{c}") for c in columns])
    lead, *others = columns
    safe = dim.null_lead and lookup == BUSINESS_KEY
    first = F.col(lead).eqNullSafe(F.col(f"_{lead}")) if safe else F.col(lead) == F.col(f"_{lead}")
    same = [first] + [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in others]
    return sales.join(member, reduce(lambda a, b: a & b, same), how).drop(*[f"_{c}" for c in columns])


def _digest(name: str) -> str:
    return f"_digest_{name}"


def member_digest(dim: Dimension) -> Column:
    """64 bits of a member's columns, and of which of them are NULL; NULL for a row that belongs to no member."""
    values = F.xxhash64(*dim.match, *[F.col(c).isNull() for c in dim.match])
    return values if dim.null_lead else F.when(F.col(dim.lead).isNotNull(), values)


def digested(sales: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """Sales with a digest per dimension beside its columns, which whoever looks up its key drops."""
    return sales.withColumns({_digest(name): member_digest(dim) for name, dim in dims.items()})


def digest_table(dim: Dimension, numbered: DataFrame, workspace: Workspace) -> DataFrame | None:
    """Digest and key of every member that has one; None if two members share a digest.

    Written, so that Spark knows its size and broadcasts it below its threshold.
    """
    digest = _digest(dim.name)
    members = workspace.store(f"digests_{dim.name}", numbered.select(member_digest(dim).alias(digest), dim.key).where(F.col(digest).isNotNull()))
    return members if members.groupBy(digest).count().where("count > 1").isEmpty() else None


def key_by_digest(sales: DataFrame, dim: Dimension, numbered: DataFrame, digests: DataFrame | None) -> DataFrame:
    """Add the key of ``sales`` whose members are all among ``numbered``; NULL without a lead. As :func:`find_key`
    with a left join, but eight bytes per row are looked up. That is exact, as no two members have one digest; if
    some have (no ``digests``), the columns are compared."""
    digest = _digest(dim.name)
    rows = find_key(sales, dim, numbered, how="left") if digests is None else sales.join(digests, digest, "left")
    return rows.drop(digest)


def all_found(rows: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """Numbered sales that are facts: all leads are known, so the id and every key that was looked up is."""
    needed = [d.lead if n == "customer" else d.key for n, d in dims.items()]
    return rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed]))


def leads_known(clean: DataFrame, dims: dict[str, Dimension], lookup: str = BUSINESS_KEY) -> DataFrame:
    """Rows that have every lead column; only these can become facts."""
    needed = [d.lead for d in dims.values() if not (d.null_lead and lookup == BUSINESS_KEY)]
    return clean.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed]))


def keyed_sales(
    clean: DataFrame, dims: dict[str, Dimension], numbered: dict[str, DataFrame], lookup: str = BUSINESS_KEY
) -> DataFrame:
    """Sale id, the six keys, quantity, price and day of every sale that has all leads."""
    rows = leads_known(clean, dims, lookup)
    for name in JOIN_ORDER:
        rows = find_key(rows, dims[name], numbered[name], lookup)
    return keyed_columns(rows, dims)


def keyed_sales_by_digest(clean: DataFrame, dims: dict[str, Dimension], numbered: dict[str, DataFrame], workspace: Workspace) -> DataFrame:
    """:func:`keyed_sales` by business keys, but a sale carries eight bytes per dimension instead of its columns."""
    digests = {n: digest_table(dims[n], numbered[n], workspace) for n in JOIN_ORDER}
    compared = [c for n in JOIN_ORDER if digests[n] is None for c in dims[n].match]
    carried = dict.fromkeys(["id", "sale_quantity", "sale_total_price", SALE_DAY, *[_digest(n) for n in JOIN_ORDER], *compared])
    rows = digested(leads_known(clean, dims), dims).select(*carried)
    for name in JOIN_ORDER:
        rows = key_by_digest(rows, dims[name], numbered[name], digests[name])
    return keyed_columns(rows, dims)


def placed_sales(
    clean: DataFrame, dims: dict[str, Dimension], numbered: dict[str, DataFrame], workspace: Workspace, known: DataFrame | None = None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """All clean sales with a customer key by rank of the sale's id, as one sale is one customer, after the customers
    that are ``known``, and with the keys of the other dimensions. Both the customer dimension and the fact are
    read from this table.

    Of dimensions with more than ``EARLY`` members the sales have the digest only. To look it up takes a shuffle,
    which whoever needs the key does without the customer's columns: :func:`late_keys` with the returned tables.
    """
    found = [n for n in JOIN_ORDER if n != "customer"]
    digests = {n: digest_table(dims[n], numbered[n], workspace) for n in found}
    late = {n: digests[n] for n in found if digests[n] is not None and workspace.rows[f"digests_{n}"] > EARLY}
    rows = digested(clean, {n: dims[n] for n in found})
    for name in found:
        rows = rows if name in late else key_by_digest(rows, dims[name], numbered[name], digests[name])
        rows = rows.drop(*[c for c in dims[name].sources if c not in (*_NEEDED, SALE_DAY)])
    customer = dims["customer"]
    if known is not None:
        return number_onto(rows, known, customer.match, customer.key, workspace, "numbered_sales"), late
    return number_rows(rows, customer.match, customer.key, workspace, "numbered_sales"), late


def late_keys(placed: DataFrame, late: dict[str, DataFrame]) -> DataFrame:
    """``placed`` sales with the keys that were not looked up before."""
    for name, digests in late.items():
        placed = placed.join(digests, _digest(name), "left").drop(_digest(name))
    return placed


def numbered_sales(
    clean: DataFrame, dims: dict[str, Dimension], numbered: dict[str, DataFrame], workspace: Workspace, known: DataFrame | None = None
) -> DataFrame:
    """All clean sales with all six keys, see :func:`placed_sales`."""
    return late_keys(*placed_sales(clean, dims, numbered, workspace, known))


def keyed_columns(rows: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    return rows.select(
        "id",
        *[d.key for d in dims.values()],
        F.col("sale_quantity").alias("quantity"),
        F.col("sale_total_price").alias("total_price"),
        F.col(SALE_DAY).alias("sale_date"),
    )


def fact_sales(keyed: DataFrame) -> DataFrame:
    return conform(keyed, "fact_sales")


def fanout_totals(clean: DataFrame, dims: dict[str, Dimension], numbered: dict[str, DataFrame]) -> DataFrame:
    """Totals of the lead-column fact without building its repeated rows.

    A sale appears once per combination of members that share its lead values. Per lead the
    number of members and the sum of their keys suffice: every lookup multiplies the row
    count, and a key's sum is its own sum times the counts of the other dimensions.
    """
    rows = leads_known(clean, dims, LEAD_COLUMN)
    for name in JOIN_ORDER:
        dim = dims[name]
        lead = F.col(dim.lead).alias(f"_{dim.lead}")
        variants = numbered[name].groupBy(lead).agg(
            F.count(F.lit(1)).alias(f"{name}_n"), F.sum(dim.key).alias(f"{name}_sum")
        )
        rows = rows.join(variants, F.col(dim.lead) == F.col(f"_{dim.lead}"), "inner")
    # decimal counts cannot overflow when several are multiplied
    count = {name: F.col(f"{name}_n").cast("decimal(12,0)") for name in dims}
    copies = reduce(lambda a, b: (a * b).cast("decimal(28,0)"), count.values())

    def key_sum(name: str):
        others = reduce(lambda a, b: (a * b).cast("decimal(18,0)"), [n for k, n in count.items() if k != name])
        return F.sum(F.col(f"{name}_sum").cast("decimal(19,0)") * others).cast("bigint").alias(f"{name}_id_sum")

    return rows.agg(
        F.sum(copies).cast("bigint").alias("fact_rows"),
        F.sum(copies * F.col("sale_quantity")).cast("bigint").alias("quantity"),
        F.sum(copies * F.col("sale_total_price")).alias("total_price"),
        *[key_sum(name) for name in dims],
    )
