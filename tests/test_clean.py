import datetime
import random
from decimal import Decimal

import pytest
from conftest import rows_of
from frames import sales
from pyspark.sql import functions as F

from tillmart.fixture import sales as raw_sales
from tillmart.fixture.queries import _READ, registry
from tillmart.operators.clean import clean_sales, first_per_key, first_rows
from tillmart.sources.tables import folder_bytes
from tillmart.workspace import Workspace


def test_bad_row_can_win_over_good_one(spark):
    raw = sales(spark, {"id": 1, "product_name": "a", "product_price": Decimal("0.00")}, {"id": 1, "product_name": "b"})
    assert clean_sales(raw, ["product_name"]).count() == 0
    assert [r["id"] for r in clean_sales(raw, ["product_price"]).collect()] == []
    good_first = raw.withColumn("rank", F.when(F.col("product_name") == "b", 1).otherwise(2))
    assert [r["product_name"] for r in clean_sales(good_first, ["rank"]).collect()] == ["b"]


def test_null_ids_are_one_key(spark):
    raw = sales(spark, {"id": None, "store_city": "x"}, {"id": None, "store_city": "a"}, {"id": 7})
    kept = first_per_key(raw, "id").select("id", "store_city").collect()
    assert sorted((r["id"] or 0, r["store_city"]) for r in kept) == [(0, "a"), (7, "store_city")]


def test_filters(spark):
    raw = sales(
        spark,
        {"customer_age": None},
        {"product_price": None},
        {"product_price": Decimal("0.00")},
        {"product_price": Decimal("-1.00")},
        {"product_price": Decimal("0.01")},
    )
    assert [r["id"] for r in clean_sales(raw).collect()] == [5]


def test_dates(spark):
    texts = ["7/4/2021", "12/31/1999", "02/03/2020", "13/40/2021", "2021-07-04", "", None]
    raw = sales(spark, *[{"sale_date": t} for t in texts])
    days = {r["sale_date"]: r["sale_day"] for r in clean_sales(raw).collect()}
    assert days["7/4/2021"] == datetime.date(2021, 7, 4)
    assert days["12/31/1999"] == datetime.date(1999, 12, 31)
    assert days["02/03/2020"] == datetime.date(2020, 2, 3)
    assert [days[t] for t in texts[3:]] == [None] * 4


def test_winner_does_not_depend_on_partitions(spark):
    random.seed(5)
    rows = [{"id": i % 50, "store_city": str(random.random()), "customer_email": str(i)} for i in range(2000)]
    raw = sales(spark, *rows)
    expected = {}
    for r in rows:
        expected[r["id"]] = min(expected.get(r["id"], r["store_city"]), r["store_city"])
    for n in (1, 3, 16):
        kept = first_per_key(raw.repartition(n), "id", ["store_city"])
        assert {r["id"]: r["store_city"] for r in kept.collect()} == expected


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of the rows share one id: each map task sends one of them."""
    rows = spark.range(30000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"), F.col("id").alias("v")
    )
    kept = first_per_key(rows, "id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "row_number(), 1, Final" in above and "row_number(), 1, Partial" in below
    assert kept.where("id = -1").collect()[0]["v"] == 0
    assert kept.count() == 20001


def test_first_rows_equal_first_per_key(spark):
    """Keys under one value of the near column and under several, repeated rows and NULLs."""
    rng = random.Random(3)
    pick = lambda n: rng.choice([None, *range(n)])
    rows = [(pick(40), pick(6), pick(3), pick(3)) for _ in range(600)] + [(100 + k, k, pick(3), pick(3)) for k in range(50) for _ in range(3)]
    df = spark.createDataFrame(rows, "id bigint, near bigint, a int, b int")
    for part in (df, df.where("id >= 100")):  # the second has no key under several values
        found = first_rows(part, "id", ["b"], Workspace(spark), "near")
        assert rows_of(found) == rows_of(first_per_key(part, "id", ["b"]))


def test_dedup_by_id_leaves_rows_where_they_are(spark, folder):
    """Whole rows are not dealt out by their id once more."""
    plan = registry()["dedup_by_id"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id#" not in plan


@pytest.mark.parametrize("name", ["load_counts", "check_fk_orphans"])
def test_raw_rows_are_dealt_into_parts_of_bounded_size(spark, folder, monkeypatch, name):
    """What the clean rows of these queries are found from: the more input, the more parts, whatever Spark would merge."""
    monkeypatch.setattr(raw_sales, "PART_BYTES", 1000)
    assert {"lineitem", "orders"} <= set(_READ) and name in registry()
    parts = -(-sum(folder_bytes(spark, f"{folder}/{t}.parquet") for t in ("lineitem", "orders")) // 1000)
    raw = raw_sales.sales_raw(spark, folder)
    assert f", {parts}), REPARTITION_BY_NUM" in raw._jdf.queryExecution().executedPlan().toString()
    assert raw.count() == spark.read.parquet(f"{folder}/lineitem.parquet").count()
