import os
import time

import pytest
from frames import sales
from pyspark.sql import functions as F

from tillmart.jobs import load_star as load_job
from tillmart.jobs import publish_marts as publish_job
from tillmart.operators.checks import duplicate_keys, key_extent, orphan_keys
from tillmart.plans import integrity
from tillmart.plans.integrity import dense_members, foreign_key_violations, keys_within, primary_key_violations, violations
from tillmart.plans.publish import FAIL, BrokenStar, failures, load_star, publish, store_star
from tillmart.plans.reports import ADDITIONS, REPORTS, Marts, Report
from tillmart.plans.star import StarPlan
from tillmart.schema import DIMENSIONS, TABLES
from tillmart.sources.tables import Target
from tillmart.sources.versions import LeaseLost, Superseded, Versions
from tillmart.workspace import Workspace


@pytest.fixture(scope="module")
def star(spark):
    rows = [{"product_name": f"p{i % 4}", "sale_date": f"{1 + i % 12}/1/2020"} for i in range(40)]
    return StarPlan(sales(spark, *rows), Workspace(spark))


@pytest.fixture
def marts(star):
    return Marts(star.fact, star.dimension_tables())


def test_one_failure_does_not_stop_the_others(marts, tmp_path):
    def broken(_):
        raise RuntimeError("no such luck")

    reports = [REPORTS["top_stores"], Report("x", "bad", broken), REPORTS["monthly_trends"]]
    manifest = publish(marts, Target(str(tmp_path)), reports)
    rows = {r["table_name"]: r for r in manifest.collect()}
    assert failures(manifest) == ["bad"]
    assert "no such luck" in rows["bad"]["error"] and rows["bad"]["rows"] is None
    assert rows["monthly_trends"]["rows"] == 12 and rows["top_stores"]["rows"] == 1


def test_empty_star_publishes_empty_marts(spark, tmp_path):
    empty = StarPlan(sales(spark, {"customer_age": None}), Workspace(spark))
    workspace = Workspace(spark)
    manifest = publish(Marts(empty.fact, empty.dimension_tables(), workspace), Target(str(tmp_path)))
    assert failures(manifest) == []
    assert [r["rows"] for r in manifest.collect()] == [0] * 19


def test_shared_totals_are_written_once(spark, star, tmp_path):
    workspace = Workspace(spark)
    publish(Marts(star.fact, star.dimension_tables(), workspace), Target(str(tmp_path)))
    assert sorted(workspace.rows) == ["totals_customer", "totals_product", "totals_store", "totals_supplier", "totals_time"]


def test_reload_replaces(spark, star, tmp_path):
    target = Target(str(tmp_path))
    first = store_star(star.tables(), target)
    assert store_star(star.tables(), target) == first
    again = load_star(spark, target)
    assert {t: df.count() for t, df in again.items()} == first
    for table, df in again.items():
        assert df.schema == TABLES[table]
        assert df.exceptAll(star.tables()[table]).count() == 0


def broken_fact(star):
    boom = F.raise_error(F.lit("no such luck")).cast("bigint")
    return star.fact.withColumn("customer_id", F.when(F.col("customer_id") == 7, boom).otherwise(F.col("customer_id")))


def test_failed_reload_leaves_the_old_star(spark, star, tmp_path):
    target = Target(str(tmp_path))
    written = store_star(star.tables(), target)
    before = target.current(spark)
    with pytest.raises(Exception, match="no such luck"):
        store_star({**star.tables(), "fact_sales": broken_fact(star)}, target)
    assert target.current(spark) == before
    assert {t: df.count() for t, df in load_star(spark, target).items()} == written
    orphaned = {**star.tables(), "dim_product": star.dimension("product").where("product_id <> 3")}
    with pytest.raises(BrokenStar, match="1 keys"):
        store_star(orphaned, target, check=True)
    assert target.current(spark) == before
    assert len(folders(tmp_path)) == 1


def folders(path):
    return sorted(p.name for p in (path / "versions").iterdir() if p.is_dir() and p.name != "log")


def interleaved(star, target, spark, **second):
    """The star's tables, whose fact is written only after another load has published."""
    other = {}

    class Tables(dict):
        def __getitem__(self, name):
            if name == "dim_seller" and not other:  # in the middle of the first load
                other.update(store_star(star.tables(), target, **second))
            return dict.__getitem__(self, name)

    return Tables(star.tables()), other


def test_two_loads_end_whole(spark, star, tmp_path):
    target = Target(str(tmp_path))
    store_star(star.tables(), target)
    tables, other = interleaved(star, target, spark, check=True)
    written = store_star(tables, target, check=True)
    assert other == written
    versions = Versions(spark, str(tmp_path))
    assert versions.number() == 3 and len(folders(tmp_path)) == 2
    for number in (2, 3):  # the second load published first, the first one on top of it
        tables = {t: target.version(versions.named(number)).read(spark, t) for t in TABLES}
        assert {t: df.count() for t, df in tables.items()} == written and violations(tables) == 0


def test_a_superseded_load_can_fail(spark, star, tmp_path):
    target = Target(str(tmp_path))
    tables, other = interleaved(star, target, spark)
    with pytest.raises(Superseded):
        store_star(tables, target, superseded=FAIL)
    assert {t: df.count() for t, df in load_star(spark, target).items()} == other
    assert Versions(spark, str(tmp_path)).number() == 1 and len(folders(tmp_path)) == 1


def test_one_of_two_commits_wins(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    a, b = versions.stage(), versions.stage()
    look = versions.number
    versions.number = lambda: 0  # the second commit looks before the first one renames
    assert versions.commit(a, 0) == 1
    with pytest.raises(Superseded):
        versions.commit(b, 0)
    versions.number = look
    assert versions.current() == a and versions.commit(b, 1) == 2 and versions.current() == b


def test_only_expired_leases_are_cleaned(spark, tmp_path):
    versions = Versions(spark, str(tmp_path), lease_seconds=3600)
    published, running, crashed = (versions.stage() for _ in range(3))
    versions.commit(published, 0)
    lease = tmp_path / "versions" / crashed / "_lease"
    os.utime(lease, (lease.stat().st_mtime - 4000,) * 2)
    assert versions.clean() == [crashed]
    assert folders(tmp_path) == sorted([published, running])
    with pytest.raises(LeaseLost):
        versions.commit(crashed, 1)
    with versions.leased(running, every=0.05):
        before = (tmp_path / "versions" / running / "_lease").stat().st_mtime_ns
        time.sleep(0.5)
        assert (tmp_path / "versions" / running / "_lease").stat().st_mtime_ns > before
    assert versions.commit(running, 1) == 2


def test_a_star_from_before_the_log_is_still_found(spark, star, tmp_path):
    old = Target(str(tmp_path)).version("old")
    for name, df in star.tables().items():
        old.write(df, name)
    (tmp_path / "versions" / "current").write_text("old")
    target = Target(str(tmp_path))
    assert load_star(spark, target)["fact_sales"].count() == 40
    store_star(star.tables(), target)
    assert "old" in folders(tmp_path) and target.current(spark) != old


def test_readers_keep_their_version(spark, star, tmp_path):
    target = Target(str(tmp_path))
    store_star(star.tables(), target)
    reading = load_star(spark, target)
    store_star(star.tables(), target, check=True)
    assert reading["fact_sales"].count() == 40  # the version before stays for one more load
    store_star(star.tables(), target)
    assert len(folders(tmp_path)) == 2


def test_workspace_retries_in_a_fresh_folder(spark, tmp_path):
    workspace = Workspace(spark, str(tmp_path / "run"))
    bad = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("not yet"))).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="not yet"):
        workspace.store("t", bad)
    assert workspace.store("t", spark.range(5)).count() == 5
    assert workspace.rows == {"t": 5}


@pytest.mark.parametrize("name", list({**REPORTS, **ADDITIONS}))
def test_reports_read_the_tables_they_name(spark, star, name):
    report = {**REPORTS, **ADDITIONS}[name]
    dims = {n: df for n, df in star.dimension_tables().items() if n in report.reads}
    assert report.build(Marts(star.fact, dims)).columns


@pytest.mark.parametrize("format", ["orc", "json", "csv"])
def test_other_formats(spark, star, tmp_path, format):
    target = Target(str(tmp_path), format)
    store_star(star.tables(), target)
    read = load_star(spark, target)
    for table, df in star.tables().items():
        assert read[table].exceptAll(df).count() == 0 and read[table].count() == df.count()


def test_checks(spark, star):
    products = star.dimension("product")
    assert duplicate_keys(products, "product_id").count() == 0
    twice = products.unionAll(products.where("product_id = 2"))
    assert [tuple(r) for r in duplicate_keys(twice, "product_id").collect()] == [(2, 2)]
    nameless = products.withColumn("product_id", F.when(F.col("product_id") > 1, F.col("product_id")))
    assert duplicate_keys(nameless, "product_id").collect()[0]["rows"] == 1
    assert orphan_keys(star.fact, "product_id", products).count() == 0
    missing = orphan_keys(star.fact, "product_id", products.where("product_id <> 3"))
    assert [tuple(r) for r in missing.collect()] == [(3, 10)]
    null_key = star.fact.withColumn("product_id", F.lit(None).cast("long"))
    assert orphan_keys(null_key, "product_id", products).count() == 0


def test_violations_of_a_whole_star(star):
    tables = star.tables()
    assert violations(tables) == 0
    broken = {**tables, "dim_product": tables["dim_product"].where("product_id <> 3")}
    broken["dim_time"] = tables["dim_time"].unionAll(tables["dim_time"].where("time_id <= 2"))
    assert violations(broken) == 3


def test_good_stars_are_proven_without_joins(spark, star, monkeypatch):
    tables = star.tables()
    sizes = {t: tables[t].count() for t in tables if t != "fact_sales"}
    assert dense_members(tables) == sizes
    assert len(keys_within(tables["fact_sales"], sizes)) == 6
    plans = [primary_key_violations(tables), foreign_key_violations(tables)]
    assert [r["bad_keys"] for df in plans for r in df.collect()] == [0] * 12
    assert not any("Join" in df._jdf.queryExecution().executedPlan().toString() for df in plans)

    def never(*_):
        raise AssertionError("counted key by key")

    for name in ("duplicate_keys", "orphan_keys"):
        monkeypatch.setattr(integrity, name, never)
    assert violations(tables) == 0


@pytest.mark.parametrize(("keys", "dense"), [
    ([1, 2, 3], True), ([1, 2, 2], False), ([2, 3, 4], False), ([1, 2, 4], False), ([1, None, 2], False), ([0, 1, 2], False),
    ([1, 1, 3], False), ([], True), (list(range(1, 70_001)), True), ([*range(1, 70_000), 69_999], False), ([-5, 1, 2], False),
])
def test_what_proves_keys_dense(spark, star, keys, dense):
    products = spark.createDataFrame([(k,) for k in keys], "product_id bigint")
    extent = key_extent(products, "product_id").first()
    known = [k for k in keys if k is not None]
    assert tuple(extent) == (len(keys), len(known), len(set(known)), min(known, default=None), max(known, default=None))
    assert ("dim_product" in dense_members({"dim_product": products})) == dense


def test_an_unproven_key_is_counted_exactly(spark, star):
    tables = star.tables()
    gap = {**tables, "dim_product": tables["dim_product"].withColumn("product_id", F.expr("IF(product_id = 4, 9, product_id)"))}
    assert primary_key_violations(gap).agg(F.sum("bad_keys")).first()[0] == 0  # a gap is no fault of the table
    found = {r["foreign_key"]: (r["bad_keys"], r["bad_rows"]) for r in foreign_key_violations(gap).collect()}
    assert found.pop("product_id") == (1, 10) and set(found.values()) == {(0, 0)}
    high = {**tables, "fact_sales": tables["fact_sales"].withColumn("store_id", F.lit(7).cast("long"))}
    found = {r["foreign_key"]: (r["bad_keys"], r["bad_rows"]) for r in foreign_key_violations(high).collect()}
    assert found["store_id"] == (1, 40)


def test_workspace_counts_and_discards(spark, tmp_path):
    workspace = Workspace(spark, str(tmp_path / "run"))
    assert workspace.store("t", spark.range(7)).count() == 7
    assert workspace.store("empty", spark.range(0)).count() == 0
    assert workspace.rows == {"t": 7, "empty": 0}
    workspace.discard()
    assert not (tmp_path / "run").exists()


def test_jobs_end_to_end(spark, star, tmp_path, capsys):
    feed, stored, marts = (str(tmp_path / n) for n in ("feed", "star", "marts"))
    star.raw.write.option("header", True).csv(feed)
    assert load_job.main(["--feed", feed, "--star", stored, "--check"]) == 0
    told = capsys.readouterr().out
    assert "fact_sales: 40 rows" in told and "loaded: 40 rows, clean: 40 rows" in told
    assert publish_job.main(["--star", stored, "--marts", marts, "--marts-format", "json"]) == 0
    tables = load_star(spark, Target(stored))
    inputs = Marts(tables["fact_sales"], {n: tables[d.table] for n, d in DIMENSIONS.items()})
    for name in ("top_products", "monthly_trends"):
        expected = REPORTS[name].build(inputs)
        assert spark.read.schema(expected.schema).json(f"{marts}/{name}").exceptAll(expected).count() == 0


def test_job_tells_failures(spark, star, tmp_path):
    stored = str(tmp_path / "star")
    store_star(star.tables(), Target(stored))
    options = ["--star", stored, "--marts", "/proc/none", "--only", "top_stores", "top_products"]
    assert publish_job.main(options) == 2


def test_job_loses_no_good_row_and_tells_rejects(spark, star, tmp_path, capsys):
    feed, stored = (str(tmp_path / n) for n in ("feed", "star"))
    rows = star.raw.withColumns(
        {
            "customer_age": F.when(F.col("id") == 5, "old").otherwise("34.0"),
            "sale_total_price": F.when(F.col("id") == 6, "123456789.00").otherwise("10.005"),
        }
    )
    rows.write.option("header", True).csv(feed)
    options = ["--feed", feed, "--star", stored, "--check"]
    assert load_job.main(options) == 2
    told = capsys.readouterr().out
    assert "fact_sales: 39 rows" in told and "loaded: 40 rows, clean: 39 rows" in told and "40 values did not fit" in told
    rejects = spark.read.parquet(f"{stored}_rejects/rejects")
    assert [tuple(r) for r in rejects.groupBy("column_name", "reason", "value").count().orderBy("column_name").collect()] == [
        ("customer_age", "unreadable", "old", 1), ("sale_total_price", "rounded", "10.005", 39),
    ]
    total = load_star(spark, Target(stored))["fact_sales"].agg(F.sum("total_price")).first()[0]
    assert float(total) == 123456789.0 + 38 * 10.01
    assert load_job.main([*options, "--accept-rejects"]) == 0


def test_job_stores_sale_ids_and_additions(spark, star, tmp_path):
    feed, stored, marts = (str(tmp_path / n) for n in ("feed", "star", "marts"))
    star.raw.write.option("header", True).csv(feed)
    assert load_job.main(["--feed", feed, "--star", stored, "--sale-id"]) == 0
    numbered = Target(stored).current(spark).read(spark, "fact_sale_id")
    assert sorted(r["sale_id"] for r in numbered.collect()) == list(range(1, 41))
    assert publish_job.main(["--star", stored, "--marts", marts, "--only", "yearly_comparison_delta", "top_stores"]) == 0
    assert spark.read.parquet(f"{marts}/yearly_comparison_delta").count() == 1


def test_sales_without_email_stay_at_person_grain(spark):
    rows = [{}, {"customer_email": None}, {"customer_email": None, "customer_first_name": "other"}, {}]
    star = StarPlan(sales(spark, *rows), Workspace(spark), grain="person")
    assert star.fact.count() == 4
    assert star.dimension("customer").count() == 3
    assert violations(star.tables()) == 0
