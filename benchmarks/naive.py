"""The same work in a naive shape, as a yardstick for ``bench.py --compare``.

Keys come from a window without partitions, nothing is stored between steps, every table
recomputes its lineage from the feed, every report joins all five dimensions, is written
and then counted in a second pass. Results are those of the engine.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.functions.measures import total_sales
from tillmart.operators.clean import clean_sales
from tillmart.operators.dimensions import stored_form
from tillmart.operators.enrich import enrich
from tillmart.operators.lookup import fact_sales, keyed_sales
from tillmart.plans.publish import load_star
from tillmart.plans.reports import REPORTS, Marts
from tillmart.schema import DIMENSIONS
from tillmart.sources.tables import Target
from tillmart.workspace import Workspace


class WideMarts(Marts):
    """Reports that always group the fully joined relation."""

    def __init__(self, fact: DataFrame, dims: dict[str, DataFrame]):
        super().__init__(fact, dims)
        self.wide = enrich(fact, dims)

    def totals(self, *names: str) -> DataFrame:
        return total_sales(self.wide, *[DIMENSIONS[n].key for n in names])

    def by(self, name: str, *columns: str) -> DataFrame:
        return total_sales(self.wide, *columns)


def _write_and_count(df: DataFrame, target: Target, table: str) -> None:
    df.write.mode("overwrite").parquet(f"{target.location}/{table}")
    df.count()


def naive_phases(spark: SparkSession, raw: DataFrame) -> dict[str, float]:
    """Seconds of the load and of the reports."""
    target = Target(Workspace(spark).path("naive_star"))
    marts_target = Target(Workspace(spark).path("naive_marts"))

    start = time.perf_counter()
    raw.count()
    clean = clean_sales(raw)
    numbered = {
        name: clean.select(*dim.sources).distinct().withColumn(
            dim.key, F.row_number().over(W.orderBy(*[F.col(c).asc_nulls_first() for c in dim.sources]))
        )
        for name, dim in DIMENSIONS.items()
    }
    fact = fact_sales(keyed_sales(clean, DIMENSIONS, numbered))
    fact.count()
    for name, dim in DIMENSIONS.items():
        target.write(stored_form(numbered[name], dim), dim.table)
    target.write(fact, "fact_sales")
    loaded = time.perf_counter()

    star = load_star(spark, target)
    marts = WideMarts(star["fact_sales"], {name: star[d.table] for name, d in DIMENSIONS.items()})
    for report in REPORTS.values():
        _write_and_count(report.build(marts), marts_target, report.table)
    return {"load": round(loaded - start, 4), "reports": round(time.perf_counter() - loaded, 4)}
