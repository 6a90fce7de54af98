import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.operators.numbering import number_rows
from tillmart.workspace import Workspace


def plan_of(df):
    return df._jdf.queryExecution().toString()


def numbered(spark, df, order):
    return number_rows(df, order, "key", Workspace(spark), "numbered")


def same_rows(a, b):
    columns = sorted(a.columns)
    a, b = a.select(columns), b.select(columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture
def wide_shuffle(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    merge = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)


def global_window(df, order):
    window = W.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("key", F.row_number().over(window).cast("long"))


def test_equals_global_window_with_nulls(spark, folder, wide_shuffle):
    rows = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.when(F.col("o_custkey") % 9 == 0, None).otherwise(F.col("o_orderstatus")).alias("lead"), "o_orderkey"
    )
    order = ["lead", "o_orderkey"]
    assert same_rows(numbered(spark, rows, order), global_window(rows, order))


def test_hot_lead_is_split(spark, wide_shuffle):
    """90 % of the rows share the lead: the slices are still of similar size."""
    rows = spark.range(20000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(5).alias("lead"), "id")
    workspace = Workspace(spark)
    result = number_rows(rows, ["lead", "id"], "key", workspace, "hot")
    sizes = [r["count"] for r in spark.read.parquet(workspace.path("hot")).groupBy("_slice").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 20000 / 4
    assert same_rows(result, global_window(rows, ["lead", "id"]))


def test_rows_need_no_single_partition_and_no_shuffle(spark):
    result = numbered(spark, spark.range(100), ["id"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning" not in plan


def test_plan_does_not_grow_with_slices(spark):
    sizes = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("3", "60"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        sizes.append(len(plan_of(numbered(spark, spark.range(1000), ["id"]))))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert abs(sizes[0] - sizes[1]) < 100


def test_empty_and_single_row(spark):
    assert numbered(spark, spark.range(0), ["id"]).collect() == []
    assert [tuple(r) for r in numbered(spark, spark.range(5, 6), ["id"]).collect()] == [(5, 1)]


def test_same_keys_whatever_the_partitions(spark, folder):
    rows = spark.read.parquet(f"{folder}/part.parquet").select("p_brand", "p_partkey")
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "5", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(numbered(spark, rows.repartition(int(n)), ["p_brand", "p_partkey"]))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert same_rows(results[0], results[1]) and same_rows(results[1], results[2])
