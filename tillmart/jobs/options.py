"""Command-line options that the jobs share."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tillmart.sources.tables import Target, folder_bytes

PARTITION_BYTES = 128 * 1024 * 1024  # input per shuffle partition that a task sorts without much spilling
LARGE_PARTITION_BYTES = 1024 * 1024 * 1024  # from MANY partitions on: fewer, larger blocks to fetch
MANY = 20_000


def add_target(parser: argparse.ArgumentParser, name: str, text: str) -> None:
    parser.add_argument(f"--{name}", required=True, metavar="LOCATION", help=f"{text}: folder or JDBC URL")
    parser.add_argument(f"--{name}-format", default="parquet", help="Spark data source, or jdbc")
    parser.add_argument(f"--{name}-prefix", default="", help="put before each table name, e.g. star_schema.")
    parser.add_argument(
        f"--{name}-option", action="append", default=[], metavar="KEY=VALUE", help="passed to Spark, repeatable"
    )
    parser.add_argument(f"--{name}-swap", action="store_true", help="write database tables beside the old ones, then swap them")


def target(options: argparse.Namespace, name: str) -> Target:
    given = vars(options)
    pairs = dict(text.split("=", 1) for text in given[f"{name}_option"])
    return Target(given[name], given[f"{name}_format"], pairs, given[f"{name}_prefix"], given[f"{name}_swap"])


def session(app: str) -> SparkSession:
    """The session that spark-submit configures.

    Adaptive execution merges partitions that turn out small, so too many cost little.
    """
    return SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").getOrCreate()


def shuffle_partitions(spark: SparkSession, input_bytes: int) -> int:
    """Partitions for an input; their size grows with it, from 128 MB to 1 GB, results don't depend on it."""
    size = min(LARGE_PARTITION_BYTES, max(PARTITION_BYTES, input_bytes // MANY))
    return max(spark.sparkContext.defaultParallelism, -(-input_bytes // size))


def size_partitions(spark: SparkSession, folder: str | None, input_bytes: int | None) -> None:
    """Shuffle partitions by the given size, else by that of the folder's files."""
    size = input_bytes or (folder_bytes(spark, folder) if folder else 0)
    if size:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(spark, size)))
