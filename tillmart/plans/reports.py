"""The nineteen marts and four additions.

Marts on sales first total the fact per member key, then attach the member's attributes to
the totals and roll them up. The join thus meets one row per member instead of one per
sale, and a member with a third of all sales is combined on the map side. Where a measure is the
product's and the group the supplier's, pairs of both would hardly be fewer than sales: there the
product's price is attached to the narrow fact, and one total per supplier follows.

Full sorts end with columns that tell all rows apart: the order is reproducible, and a
value that many rows share does not put them all into one sort task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.functions.measures import amount, mean, roll_up, total_sales
from tillmart.operators.enrich import attach, attributes
from tillmart.operators.ranking import top_k
from tillmart.schema import DIMENSIONS
from tillmart.workspace import Workspace


SHARED = ("customer", "product", "supplier", "store", "time")  # dimensions that several reports total by


class Marts:
    """Inputs of the reports: a fact, its dimensions, and totals that several reports share.

    With a workspace the totals of a shared dimension are written when the first report asks
    for them, and the fact is scanned once for all reports of that dimension. Customer totals can
    be as many as sales; written once they still save the second report the scan and the shuffle.

    ``ordered=False`` leaves out the final sort of reports that are not cut off. A stored
    table keeps no order, so a job that only writes them saves the range shuffle; top-k
    reports always rank.
    """

    def __init__(
        self,
        fact: DataFrame,
        dims: dict[str, DataFrame],
        workspace: Workspace | None = None,
        ordered: bool = True,
    ):
        self.ordered = ordered
        self.fact = fact
        self.dims = dims
        self.workspace = workspace
        self._stored: dict[str, DataFrame] = {}
        self._locks = {name: Lock() for name in SHARED}

    def totals(self, *names: str) -> DataFrame:
        """Sales measures per member of the named dimensions."""
        fresh = total_sales(self.fact, *[DIMENSIONS[n].key for n in names])
        if self.workspace is None or len(names) > 1 or names[0] not in SHARED:
            return fresh
        (name,) = names
        with self._locks[name]:
            if name not in self._stored:
                self._stored[name] = self.workspace.store(f"totals_{name}", fresh)
        return self._stored[name]

    def by(self, name: str, *columns: str) -> DataFrame:
        """Sales measures per attribute values of one dimension; unknown members are NULL."""
        return roll_up(attach(self.totals(name), self.dims[name], name, columns), *columns)

    def sort(self, df: DataFrame, *order: Column) -> DataFrame:
        return df.orderBy(*order) if self.ordered else df


#: Dimensions that the reports of a showcase read, unless a report names others.
READS = {
    "products": ("product",), "customers": ("customer",), "time": ("time",), "stores": ("store",),
    "suppliers": ("supplier",), "quality": ("product",),
}


@dataclass(frozen=True)
class Report:
    showcase: str
    table: str
    build: Callable[[Marts], DataFrame]
    reads: tuple[str, ...] = tuple(DIMENSIONS)


REPORTS: dict[str, Report] = {}
ADDITIONS: dict[str, Report] = {}


def tables_needed(reports: Iterable[Report]) -> list[str]:
    """Star tables that the reports read."""
    read = {name for report in reports for name in report.reads}
    return ["fact_sales", *[d.table for name, d in DIMENSIONS.items() if name in read]]


def _report(showcase: str, registry: dict[str, Report] = REPORTS, reads: tuple[str, ...] = ()):
    def register(build: Callable[[Marts], DataFrame]) -> Callable[[Marts], DataFrame]:
        registry[build.__name__] = Report(showcase, build.__name__, build, reads or READS[showcase])
        return build

    return register


def _down(column: str):
    return F.col(column).desc_nulls_last()


def _up(column: str):
    return F.col(column).asc_nulls_first()


def _revenue():
    return amount("revenue").alias("total_revenue")


def _orders():
    return F.col("sales").alias("order_count")


# --- products -----------------------------------------------------------------------------


@_report("products")
def top_products(m: Marts) -> DataFrame:
    sold = m.by("product", "product_name").select("product_name", F.col("units").alias("total_quantity_sold"))
    return top_k(sold, [_down("total_quantity_sold")], ["product_name"], 10)


@_report("products")
def revenue_by_category(m: Marts) -> DataFrame:
    by_category = m.sort(m.by("product", "category"), _down("revenue"), _up("category"))
    return by_category.select("category", _revenue())


@_report("products")
def product_ratings(m: Marts) -> DataFrame:
    rated = m.dims["product"].where(F.col("rating").isNotNull())
    ordered = m.sort(rated, _down("rating"), _up("product_id"))
    return ordered.select("product_name", "rating", "reviews", "category")


# --- customers ----------------------------------------------------------------------------


@_report("customers")
def top_customers(m: Marts) -> DataFrame:
    # the key decides name and email: ten keys are ranked, and only their members are joined
    best = top_k(m.totals("customer"), [_down("revenue")], ["customer_id"], 10)
    who = ["customer_first_name", "customer_last_name", "customer_email"]
    named = attributes(m.dims["customer"], "customer", who).join(
        F.broadcast(best.select("customer_id")), "customer_id", "left_semi"
    )
    return (
        best.join(F.broadcast(named), "customer_id", "left")  # at most ten members: keys are unique
        .orderBy(_down("revenue"), _up("customer_id"))
        .select("customer_id", *who, amount("revenue").alias("total_spent"))
    )


@_report("customers")
def customers_by_country(m: Marts) -> DataFrame:
    counted = m.dims["customer"].groupBy("country").agg(F.count(F.lit(1)).alias("customer_count"))
    return m.sort(counted, _down("customer_count"), _up("country"))


@_report("customers")
def customer_avg_order(m: Marts) -> DataFrame:
    who = ["customer_first_name", "customer_last_name"]
    averages = attach(m.totals("customer"), m.dims["customer"], "customer", who).select(
        "customer_id", *who, mean("revenue", "revenue_known").alias("avg_order_value"), _orders(),
        amount("revenue").alias("total_spent"),
    )
    return m.sort(averages, _down("avg_order_value"), _up("customer_id"))


# --- time ---------------------------------------------------------------------------------


@_report("time")
def monthly_trends(m: Marts) -> DataFrame:
    return m.sort(m.by("time", "year", "month"), _up("year"), _up("month")).select(
        "year", "month", amount("revenue").alias("monthly_revenue"), _orders(), F.col("units").alias("total_quantity")
    )


@_report("time")
def yearly_comparison(m: Marts) -> DataFrame:
    by_year = m.sort(m.by("time", "year"), _up("year"))
    return by_year.select("year", amount("revenue").alias("yearly_revenue"), _orders())


@_report("time")
def monthly_avg_order_size(m: Marts) -> DataFrame:
    return m.sort(m.by("time", "year", "month"), _up("year"), _up("month")).select(
        "year", "month", mean("units", "units_known").alias("avg_order_size"),
        mean("revenue", "revenue_known").alias("avg_order_value"),
    )


# --- stores -------------------------------------------------------------------------------


@_report("stores")
def top_stores(m: Marts) -> DataFrame:
    keys = ["store_name", "store_city", "store_country"]
    return top_k(m.by("store", *keys), [_down("revenue")], keys, 5).select(*keys, _revenue(), _orders())


@_report("stores")
def sales_by_location(m: Marts) -> DataFrame:
    keys = ["store_country", "store_city"]
    located = m.sort(m.by("store", *keys), _down("revenue"), *map(_up, keys))
    return located.select(*keys, _revenue(), _orders())


@_report("stores")
def store_avg_check(m: Marts) -> DataFrame:
    keys = ["store_name", "store_city"]
    check = mean("revenue", "revenue_known").alias("avg_check")
    checked = m.by("store", *keys).select(*keys, check, _orders(), _revenue())
    return m.sort(checked, _down("avg_check"), *map(_up, keys))


# --- suppliers ----------------------------------------------------------------------------


@_report("suppliers")
def top_suppliers(m: Marts) -> DataFrame:
    keys = ["supplier_name", "supplier_country"]
    return top_k(m.by("supplier", *keys), [_down("revenue")], keys, 5).select(*keys, _revenue(), _orders())


@_report("suppliers", reads=("supplier", "product"))
def supplier_avg_price(m: Marts) -> DataFrame:
    """List price per sale and number of sales of a named product, per supplier name."""
    sold = attach(m.fact.select("supplier_id", "product_id"), m.dims["product"], "product", ["price", "product_name"])
    per_supplier = sold.groupBy("supplier_id").agg(
        F.sum("price").alias("list_price"), F.count("price").alias("priced"), F.count("product_name").alias("named")
    )
    per_name = (
        attach(per_supplier, m.dims["supplier"], "supplier", ["supplier_name"])
        .groupBy("supplier_name")
        .agg(*[F.sum(c).alias(c) for c in ("list_price", "priced", "named")])
    )
    prices = per_name.select(
        "supplier_name", mean("list_price", "priced").alias("avg_price"), F.col("named").alias("product_count")
    )
    return m.sort(prices, _down("avg_price"), _up("supplier_name"))


@_report("suppliers")
def sales_by_supplier_country(m: Marts) -> DataFrame:
    by_country = m.sort(m.by("supplier", "supplier_country"), _down("revenue"), _up("supplier_country"))
    return by_country.select("supplier_country", _revenue(), _orders())


# --- product quality ----------------------------------------------------------------------


@_report("quality")
def products_highest_rating(m: Marts) -> DataFrame:
    rated = m.dims["product"].where(F.col("rating").isNotNull())
    best = top_k(rated, [_down("rating"), _down("reviews")], ["product_id"], 10)
    return best.select("product_name", "rating", "reviews", "category", "brand")


@_report("quality")
def products_lowest_rating(m: Marts) -> DataFrame:
    rated = m.dims["product"].where(F.col("rating").isNotNull())
    worst = top_k(rated, [_up("rating"), _down("reviews")], ["product_id"], 10)
    return worst.select("product_name", "rating", "reviews", "category", "brand")


@_report("quality")
def rating_sales_correlation(m: Marts) -> DataFrame:
    keys = ["product_name", "rating", "category"]
    rated = m.by("product", *keys).where(F.col("rating").isNotNull())
    sales = rated.select(*keys, F.col("units").alias("total_sales"), _revenue(), _orders())
    return m.sort(sales, _down("total_sales"), *map(_up, keys))


@_report("quality")
def products_most_reviews(m: Marts) -> DataFrame:
    reviewed = m.dims["product"].where(F.col("reviews").isNotNull())
    most = top_k(reviewed, [_down("reviews")], ["product_id"], 10)
    return most.select("product_name", "reviews", "rating", "category", "brand")


# --- additions, not part of the nineteen --------------------------------------------------


@_report("additions", ADDITIONS, ("time",))
def yearly_comparison_delta(m: Marts) -> DataFrame:
    """Each year's revenue beside that of the year before it in the data."""
    by_year = m.by("time", "year").where(F.col("year").isNotNull()).select("year", "revenue")
    before = F.lag("revenue").over(W.orderBy("year"))  # one row per calendar year
    return by_year.withColumn("before", before).select(
        "year",
        amount("revenue").alias("yearly_revenue"),
        amount("before").alias("previous_revenue"),
        amount(F.col("revenue") - F.col("before")).alias("revenue_change"),
    )


@_report("additions", ADDITIONS, ("product",))
def rating_sales_corr(m: Marts) -> DataFrame:
    """Pearson correlation of rating and units sold over the rows of the rating report."""
    rated = m.by("product", "product_name", "rating", "category").where(F.col("rating").isNotNull())
    linear = F.corr(F.col("rating").cast("double"), F.col("units").cast("double"))
    return rated.agg(F.round(linear, 6).alias("correlation"), F.count(F.lit(1)).alias("products"))


@_report("additions", ADDITIONS, ("product",))
def product_rating_avg(m: Marts) -> DataFrame:
    """Average rating and number of reviews per product name, over the variants rated."""
    rated = m.dims["product"].where(F.col("rating").isNotNull()).groupBy("product_name")
    return rated.agg(
        mean(F.sum("rating"), F.count("rating")).alias("avg_rating"), F.sum("reviews").alias("total_reviews")
    )
