"""Dimension members: distinct source columns plus a dense key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.functions.calendar import calendar_parts
from tillmart.operators.numbering import number_onto, number_rows
from tillmart.schema import SALE_DAY, Dimension, conform
from tillmart.workspace import Workspace


def members(clean: DataFrame, dim: Dimension, workspace: Workspace, known: DataFrame | None = None) -> DataFrame:
    """Key plus source columns, one row per member. A NULL lead is a member, too.

    With the members ``known`` from an earlier load those keep their keys, also if no sale has them any
    more, and new members get the next numbers."""
    rows = clean.select(*dim.sources)
    if dim.lead != "id":  # ids are unique already
        rows = rows.distinct()
    if known is None:
        return number_rows(rows, dim.match, dim.key, workspace, dim.table)  # ``match`` is a total order of members
    numbered = number_onto(rows, known, dim.match, dim.key, workspace, dim.table)
    return with_former(numbered, known, dim)


def with_former(numbered: DataFrame, known: DataFrame, dim: Dimension) -> DataFrame:
    """``numbered`` members and those ``known`` ones that are not among them."""
    columns = [dim.key, *dim.sources]
    now = numbered.select(F.col(dim.key).alias("_known_key"))
    former = known.join(now, known[dim.key] == F.col("_known_key"), "left_anti")
    return numbered.select(columns).unionAll(former.select(columns))


def stored_form(numbered: DataFrame, dim: Dimension) -> DataFrame:
    """The dimension as a table: stored column names and types."""
    named = numbered.withColumnsRenamed(dim.attributes)
    if SALE_DAY in dim.attributes:
        named = named.withColumns(calendar_parts(dim.attributes[SALE_DAY]))
    return conform(named, dim.table)
