"""Times the whole pipeline and every mart; prints one JSON line.

    BENCH_SF_DIR   folder with the tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads            (default 8)
    BENCH_TIMES    copies of the rows in the feed, with ids of their own (default 1)

The wide sales rows are staged once, untimed, as a folder of ten CSV files: the input of
the load job. Its phases are timed in order: CSV to clean rows, dimensions, then the
fact while the star tables are written. Marts run on the stored star, as the report job does. Every number is the median
of BENCH_RUNS warm runs (default 3).
``--compare`` prints the same for a naive shape of the pipeline, see ``benchmarks/naive.py``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.fixture.sales import sales_raw
from tillmart.plans.ingest import Ingest
from tillmart.plans.publish import load_star, publish, store_star
from tillmart.plans.reports import ADDITIONS, REPORTS, Marts
from tillmart.plans.star import StarPlan
from tillmart.schema import DIMENSIONS, SALES_COLUMNS
from tillmart.sources.csv_feed import SOURCE_FILE, scan_csv_folder
from tillmart.sources.tables import Target
from tillmart.workspace import Workspace

FEED_FILES = 10


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillmart bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    """Execute a plan completely without a sink."""
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 4)


def stage_feed(spark: SparkSession, folder: str, times: int = 1) -> str:
    """The wide sales rows of the tables as CSV files; ``times`` copies with ids of their own."""
    feed = Workspace(spark).path("feed")
    copies = spark.range(times).withColumnRenamed("id", "copy_")
    rows = sales_raw(spark, folder).select(*SALES_COLUMNS).crossJoin(F.broadcast(copies))
    rows = rows.withColumn("id", F.col("id") + F.col("copy_") * 10**12).drop("copy_")
    rows.repartition(FEED_FILES * times).write.option("header", True).csv(feed)
    return feed


def load_phases(spark: SparkSession, feed: str) -> tuple[dict[str, float], Target]:
    """One load: each phase reads what the one before has written."""
    workspace = Workspace(spark)
    ingest = Ingest(scan_csv_folder(spark, feed, source_file=True, rejects=True))  # what the load job scans
    star = StarPlan(ingest.rows, workspace, [SOURCE_FILE])
    target = Target(workspace.path("star"))
    phases = {
        "etl_clean": timed(lambda: star.clean),
        "etl_dimensions": timed(star.prepare),
        "etl_fact_and_store": timed(lambda: store_star(star.tables(write_fact=False), target)),
    }
    return phases, target


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = int(os.environ.get("BENCH_TIMES", "1"))
    spark = session(cpus)
    feed = stage_feed(spark, folder, times)
    load_phases(spark, feed)  # warm-up: class loading, code generation, file cache

    repeated = [load_phases(spark, feed) for _ in range(runs)]
    queries = {name: statistics.median(p[name] for p, _ in repeated) for name in repeated[0][0]}

    star = load_star(spark, repeated[-1][1])
    dims = {name: star[d.table] for name, d in DIMENSIONS.items()}
    marts = Marts(star["fact_sales"], dims)
    for name, report in {**REPORTS, **ADDITIONS}.items():
        run(report.build(marts))
        queries[name] = statistics.median(timed(lambda: run(report.build(marts))) for _ in range(runs))

    def publish_all() -> None:
        workspace = Workspace(spark)
        publish(Marts(star["fact_sales"], dims, workspace, ordered=False), Target(workspace.path("marts")))

    queries["publish_19_marts"] = statistics.median(timed(publish_all) for _ in range(runs))
    phases = ("etl_clean", "etl_dimensions", "etl_fact_and_store", "publish_19_marts")
    result = {
        "metric": "load the star schema and publish 19 marts",
        "value": round(sum(queries[p] for p in phases), 4),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if "--compare" in sys.argv:
        from benchmarks.naive import naive_phases

        raw = scan_csv_folder(spark, feed, source_file=True)
        measured = [naive_phases(spark, raw) for _ in range(runs)]
        result["naive"] = {k: statistics.median(m[k] for m in measured) for k in measured[0]}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
