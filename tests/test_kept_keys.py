"""Members keep their keys over loads that ask for it."""

import random

from frames import sales

from tillmart.jobs import load_star as load_job
from tillmart.operators.numbering import number_onto
from tillmart.plans.integrity import dense_members, violations
from tillmart.plans.publish import load_keys, load_star, store_star
from tillmart.plans.star import StarPlan
from tillmart.schema import DIMENSIONS
from tillmart.sources.tables import Target
from tillmart.sources.versions import Versions
from tillmart.workspace import Workspace


def keys(df, *columns):
    return {tuple(r[1:]): r[0] for r in df.select(*columns).collect()}


def test_known_rows_keep_their_numbers(spark):
    rng = random.Random(5)
    pairs = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2, 3, 4])) for _ in range(60)]
    rows = spark.createDataFrame(sorted(set(pairs), key=repr), "x string, y int")
    old = {p: 10 * i + 7 for i, p in enumerate(rows.where("y > 2 OR x IS NULL").collect())}
    known = spark.createDataFrame([(k, *p) for p, k in old.items()], "n bigint, x string, y int")
    found = keys(number_onto(rows, known, ["x", "y"], "n", Workspace(spark), "t"), "n", "x", "y")
    assert len(found) == rows.count() and all(found[tuple(p)] == k for p, k in old.items())
    fresh = sorted((p for p in found if p not in {tuple(q) for q in old}), key=lambda p: (p[0] or "", p[1] is not None, p[1] or 0))
    assert [found[p] for p in fresh] == [max(old.values()) + 1 + i for i in range(len(fresh))]
    nothing = number_onto(rows, known.limit(0), ["x", "y"], "n", Workspace(spark), "t")
    assert sorted(keys(nothing, "n", "x", "y").values()) == list(range(1, rows.count() + 1))


def products(spark, *names, first=0):
    return sales(spark, *[{"id": first + i, "product_name": n, "customer_age": 20 + i} for i, n in enumerate(names)])


def test_star_after_star(spark, tmp_path):
    target = Target(str(tmp_path))
    one = StarPlan(products(spark, "m", "z", None), Workspace(spark))
    assert load_keys(spark, target, DIMENSIONS) == {}
    store_star({**one.tables(), **one.key_maps()}, target)
    two = StarPlan(products(spark, "a", "z", "b", None, first=1), Workspace(spark), known=load_keys(spark, target, DIMENSIONS))
    tables = {**two.tables(), **two.key_maps()}
    store_star(tables, target, check=True)
    assert keys(two.dimension("product"), "product_id", "product_name") == {(None,): 1, ("m",): 2, ("z",): 3, ("a",): 4, ("b",): 5}
    customers = keys(two.members("customer"), "customer_id", "id", "customer_age")
    assert customers == {(0, 20): 1, (1, 20): 2, (2, 21): 3, (3, 22): 4, (4, 23): 5}  # ages are those of the last load
    assert violations(two.tables()) == 0 and len(dense_members(two.tables())) == 6
    named = two.fact.join(two.dimension("product"), "product_id").select("customer_id", "product_name")
    assert sorted(map(tuple, named.collect())) == [(2, "a"), (3, "z"), (4, "b")]
    three = StarPlan(products(spark, "m"), Workspace(spark), known=load_keys(spark, target, DIMENSIONS), lookup="lead_column")
    assert three.fact.select("product_id", "customer_id").collect() == [(2, 1)]


def test_job_keeps_keys(spark, tmp_path):
    feed, stored = str(tmp_path / "feed"), str(tmp_path / "star")
    options = ["--feed", feed, "--star", stored, "--keep-keys", "--check"]
    products(spark, "m", "z").write.option("header", True).csv(feed)
    assert load_job.main(options) == 0
    products(spark, "a", first=9).write.mode("append").option("header", True).csv(feed)
    assert load_job.main(options) == 0
    found = keys(load_star(spark, Target(stored))["dim_product"], "product_id", "product_name")
    assert found == {("m",): 1, ("z",): 2, ("a",): 3}
    customers = load_star(spark, Target(stored))["dim_customer"].select("customer_id", "age").collect()
    assert sorted(map(tuple, customers)) == [(1, 20), (2, 21), (3, 20)]


def test_keys_are_not_kept_over_another_load(spark, tmp_path, monkeypatch, capsys):
    """Keys that were numbered after one version must not be published on top of another."""
    feed, stored = str(tmp_path / "feed"), str(tmp_path / "star")
    products(spark, "m", "z").write.option("header", True).csv(feed)
    store = load_job.store_star

    def late(tables, goal, **options):
        versions = Versions(spark, stored)
        versions.commit(versions.stage(), versions.number())
        return store(tables, goal, **options)

    monkeypatch.setattr(load_job, "store_star", late)
    assert load_job.main(["--feed", feed, "--star", stored, "--keep-keys"]) == 3
    assert "was published" in capsys.readouterr().out and Versions(spark, stored).number() == 1
