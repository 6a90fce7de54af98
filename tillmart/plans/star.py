"""The star schema, built on demand: clean rows, then dimensions, then the fact.

Clean rows, members and fact are each written once to the workspace; whatever reads them
later reads those rows and columns, nothing is computed twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame

from tillmart.operators.clean import stored_clean_sales
from tillmart.operators.dimensions import members, stored_form, with_former
from tillmart.operators.lookup import BUSINESS_KEY, all_found, fact_sales, keyed_columns, keyed_sales, keyed_sales_by_digest, late_keys, placed_sales
from tillmart.operators.numbering import number_rows
from tillmart.schema import dimensions
from tillmart.workspace import Workspace


def key_map(name: str) -> str:
    """Table of a dimension's members and keys, kept for the next load."""
    return f"keys_{name}"


class StarPlan:
    """One star schema over ``raw`` sales rows.

    ``order`` decides which of several rows with one id survives. ``lookup`` and ``grain``
    select the fact's key lookup and the customer dimension, see the README. ``known`` are the
    members of an earlier load by dimension, as :meth:`key_maps` gives them: they keep their keys.
    ``near`` names a column of ``raw`` that rows with one id usually share and that they are dealt out by.
    """

    def __init__(
        self,
        raw: DataFrame,
        workspace: Workspace,
        order: Sequence[str] = (),
        lookup: str = BUSINESS_KEY,
        grain: str = "sale",
        known: Mapping[str, DataFrame] | None = None,
        near: str = "",
    ):
        self.raw = raw
        self.workspace = workspace
        self.order = order
        self.lookup = lookup
        self.grain = grain
        self.dims = dimensions(grain)
        self.known = dict(known or {})
        self.near = near
        self._built: dict = {}
        self._stored: dict[str, DataFrame] = {}
        self._locks = {name: Lock() for name in ("clean", "keyed", "numbered", "sale_ids", *self.dims)}

    def variant(self, lookup: str | None = None, grain: str | None = None) -> StarPlan:
        """The same clean rows with another lookup or customer grain; what agrees is shared."""
        known = {n: df for n, df in self.known.items() if n != "customer" or (grain or self.grain) == self.grain}
        other = StarPlan(self.raw, Workspace(self.workspace.spark), self.order, lookup or self.lookup,
                         grain or self.grain, known, self.near)
        self.clean  # noqa: B018  (written before it is shared)
        shared = [n for n in ("clean", *self.dims) if n == "clean" or self.dims[n] == other.dims[n]]
        shared += ["numbered"] if self.dims == other.dims else []
        other._built.update({n: self._built[n] for n in shared if n in self._built})
        return other

    def load(self, ids: Column, known: Mapping[str, DataFrame] | None = None) -> StarPlan:
        """The star of the sales that meet ``ids``, a condition on the sale's id alone: which of several rows with
        one id survives does not depend on it, so the clean rows of all loads are written once."""
        other = StarPlan(self.raw.where(ids), Workspace(self.workspace.spark), self.order, self.lookup, self.grain, known, self.near)
        other._built["clean"] = self.clean.where(ids)
        return other

    def _once(self, name: str, build):
        with self._locks[name]:
            if name not in self._built:
                self._built[name] = build()
        return self._built[name]

    @property
    def clean(self) -> DataFrame:
        return self._once("clean", lambda: stored_clean_sales(self.raw, self.order, self.workspace, self.near))

    @property
    def one_customer_per_sale(self) -> bool:
        return self.dims["customer"].unique_lead

    @property
    def _placed(self) -> tuple[DataFrame, dict[str, DataFrame]]:
        others = {n: self.members(n) for n in self.dims if n != "customer"}
        return self._once("numbered", lambda: placed_sales(self.clean, self.dims, others, self.workspace, self.known.get("customer")))

    @property
    def numbered(self) -> DataFrame:
        """Clean sales with all six keys, where one sale is one customer."""
        return late_keys(*self._placed)

    def members(self, name: str) -> DataFrame:
        """Key and source columns of a dimension."""
        if name == "customer" and self.one_customer_per_sale:
            customer = self.dims[name]
            now = self._placed[0].select(customer.key, *customer.sources)
            return with_former(now, self.known[name], customer) if name in self.known else now
        return self._once(name, lambda: self._members(name))

    def _members(self, name: str) -> DataFrame:
        found = members(self.clean, self.dims[name], self.workspace, self.known.get(name))
        # What is known already comes from a join; without it members are read from the numbered table.
        return self.workspace.store(f"members_{name}", found) if name in self.known else found

    def dimension(self, name: str) -> DataFrame:
        """A dimension in its stored form."""
        members = self.members(name)
        if name not in self._stored:
            self._stored[name] = stored_form(members, self.dims[name])
        return self._stored[name]

    def keyed_plan(self) -> DataFrame:
        """The fact with the id of its sale, computed by whoever reads it."""
        self.prepare()
        if self.one_customer_per_sale and self.lookup == BUSINESS_KEY:
            return keyed_columns(all_found(self.numbered, self.dims), self.dims)
        numbered = {name: self.members(name) for name in self.dims}
        if self.lookup == BUSINESS_KEY:
            return keyed_sales_by_digest(self.clean, self.dims, numbered, self.workspace)
        return keyed_sales(self.clean, self.dims, numbered, self.lookup)

    @property
    def keyed(self) -> DataFrame:
        """The same, written once."""
        return self._once("keyed", lambda: self.workspace.store("fact_sales", self.keyed_plan()))

    @property
    def fact(self) -> DataFrame:
        return fact_sales(self.keyed)

    @property
    def fact_with_sale_id(self) -> DataFrame:
        """The fact with a dense ``sale_id`` by day, sale, then the member keys."""
        order = ["sale_date", "id", *[d.key for d in self.dims.values()]]
        return self._once(
            "sale_ids", lambda: number_rows(self.keyed, order, "sale_id", self.workspace, "fact_sale_ids")
        )

    def prepare(self) -> None:
        """Build all dimensions; their jobs are independent and share the cluster."""
        self.clean  # noqa: B018  (written first, all dimensions read it)
        run = inheritable_thread_target(self.workspace.spark)(self.members)
        with ThreadPoolExecutor(len(self.dims)) as pool:
            list(pool.map(run, self.dims))

    def tables(self, write_fact: bool = True) -> dict[str, DataFrame]:
        """The seven stored tables. A caller that reads the fact once need not have it written first."""
        fact = self.fact if write_fact else fact_sales(self.keyed_plan())
        return {**{d.table: self.dimension(name) for name, d in self.dims.items()}, "fact_sales": fact}

    def key_maps(self) -> dict[str, DataFrame]:
        """Members with all columns that tell them apart, by table name: what a later load needs to keep
        their keys. Dimension tables lack some of these columns."""
        return {key_map(name): self.members(name) for name in self.dims}

    def dimension_tables(self) -> dict[str, DataFrame]:
        return {name: self.dimension(name) for name in self.dims}
