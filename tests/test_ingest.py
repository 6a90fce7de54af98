"""Counts of what was loaded stay right when Spark repeats tasks."""

import glob
import os
import subprocess
import sys

import pytest
from frames import sales
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillmart.operators.clean import first_per_key
from tillmart.plans.ingest import Ingest
from tillmart.sources.csv_feed import REJECT, REJECTED
from tillmart.workspace import Workspace


def feed(spark, folder):
    """600 rows in six files, with two rows per id and twenty rejected values."""
    rows = sales(spark, *[{"id": i % 300} for i in range(600)])
    rows.repartition(6).write.parquet(folder)
    reject = F.struct(F.lit("customer_age").alias("column_name"), F.lit("old").alias("value"), F.lit("unreadable").alias("reason"))
    return spark.read.parquet(folder).withColumn(REJECTED, F.when(F.col("id") < 10, F.array(reject)).otherwise(F.array()).cast(REJECT))


@pytest.fixture
def scan(spark, tmp_path):
    return feed(spark, str(tmp_path / "feed"))


def test_counts_of_an_undisturbed_load(spark, scan):
    ingest = Ingest(scan)
    assert Workspace(spark).store("t", first_per_key(ingest.rows, "id")).count() == 300
    assert not ingest.repeated and (ingest.loaded, ingest.rejected) == (600, 20)


def test_an_empty_scan(spark, scan):
    ingest = Ingest(scan.limit(0))
    Workspace(spark).store("t", ingest.rows)
    assert (ingest.loaded, ingest.rejected) == (0, 0)


def lose_a_shuffle(folder):
    """A load whose first task that has read its part of the shuffle deletes the files, as if their
    executor was lost: Spark then repeats the tasks that wrote them."""
    options = {
        "spark.ui.enabled": "false", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "40",
        "spark.sql.files.openCostInBytes": str(1 << 40), "spark.local.dir": f"{folder}/local",
    }
    spark = SparkSession.builder.master("local[4]").config(map=options).getOrCreate()
    scan = feed(spark, f"{folder}/feed")

    def lose(batches):
        for batch in batches:
            try:
                os.close(os.open(f"{folder}/lost", os.O_CREAT | os.O_EXCL))
                for path in glob.glob(f"{folder}/local/*/*/shuffle_*"):
                    os.remove(path)
            except FileExistsError:
                pass
            yield batch

    ingest = Ingest(scan)
    rows = first_per_key(ingest.rows, "id")
    stored = Workspace(spark).store("t", rows.mapInArrow(lose, rows.schema)).count()
    print("found", stored, ingest._seen.get["loaded"], ingest.repeated, ingest.loaded, ingest.rejected)
    spark.stop()


def test_counts_survive_a_lost_shuffle(tmp_path):
    """In a process of its own, as Spark gives up the executor whose shuffle is gone."""
    here = os.path.dirname(os.path.abspath(__file__))
    paths = os.pathsep.join([here, os.path.dirname(here), os.environ.get("PYTHONPATH", "")])
    script = f"import test_ingest; test_ingest.lose_a_shuffle({str(tmp_path)!r})"
    done = subprocess.run([sys.executable, "-c", script], env={**os.environ, "PYTHONPATH": paths}, capture_output=True, text=True, timeout=300)
    (told,) = [line.split() for line in done.stdout.splitlines() if line.startswith("found")]
    stored, seen, repeated, loaded, rejected = told[1:]
    assert int(seen) > 600 and repeated == "True"
    assert (int(stored), int(loaded), int(rejected)) == (300, 600, 20)
