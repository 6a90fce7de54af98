from decimal import Decimal

import pytest
from conftest import rows_of, rows_of_sql
from frames import sales
from pyspark.sql import functions as F

from tillmart.fixture.oracle import fanout_oracle
from tillmart.fixture.queries import _fingerprint, _published, star_plan
from tillmart.fixture.sales import ORDER, sales_raw
from tillmart.operators import lookup
from tillmart.operators.clean import clean_sales, first_per_key, stored_clean_sales
from tillmart.operators.enrich import ENRICHED, FACT_COLUMNS, enrich
from tillmart.operators.lookup import LEAD_COLUMN, fanout_totals
from tillmart.plans.reports import REPORTS, Marts
from tillmart.plans.star import StarPlan
from tillmart.schema import DIMENSIONS, TABLES
from tillmart.workspace import Workspace

LEADS = ["id", "product_name", "seller_email", "store_name", "supplier_name", "sale_date"]


@pytest.fixture(scope="module")
def star(spark, folder):
    return star_plan(spark, folder)


@pytest.fixture(scope="module")
def fanout(star):
    return star.variant(lookup=LEAD_COLUMN)


def star_of(spark, *rows, **options):
    return StarPlan(sales(spark, *rows), Workspace(spark), **options)


@pytest.mark.parametrize("lead", LEADS)
def test_null_lead_is_a_member_but_no_fact(spark, lead):
    star = star_of(spark, {}, {lead: None})
    name = next(n for n, d in star.dims.items() if d.lead == lead or (lead == "sale_date" and n == "time"))
    assert star.dimension(name).count() == 2
    first = star.members(name).where(f"{name}_id = 1").collect()[0]
    assert first[star.dims[name].lead] is None
    assert star.fact.count() == 1


def test_other_nulls_match(spark):
    star = star_of(spark, {"store_state": None}, {}, {"product_rating": None})
    assert star.fact.count() == 3
    assert star.dimension("store").count() == 2


def test_business_key_gives_one_fact_per_sale(star):
    complete = star.clean.where(F.col("sale_day").isNotNull())
    assert star.fact.count() == complete.count()


def test_keys_are_dense(star):
    for name, dim in DIMENSIONS.items():
        found = star.dimension(name).agg(F.count("*"), F.min(dim.key), F.max(dim.key), F.countDistinct(dim.key))
        n, low, high, distinct = found.collect()[0]
        assert (low, high, distinct) == (1, n, n)


def test_stored_types(star):
    for table, df in star.tables().items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TABLES[table]]


def test_revenue_is_kept(star):
    marts = Marts(star.fact, star.dimension_tables())
    total = star.fact.agg(F.sum("total_price").cast("double")).collect()[0][0]
    for report in ("revenue_by_category", "sales_by_supplier_country", "yearly_comparison"):
        df = REPORTS[report].build(marts)
        column = [c for c in df.columns if c.endswith("revenue")][0]
        assert df.agg(F.sum(column)).collect()[0][0] == pytest.approx(total, rel=1e-12)


def test_fanout_rows_equal_sql(spark, duck, fanout):
    assert rows_of(_published(fanout.fact)) == rows_of_sql(duck, fanout_oracle()["fact_sales"])


@pytest.mark.parametrize("name", list(REPORTS))
def test_reports_on_fanout_equal_sql(duck, fanout, name):
    marts = Marts(fanout.fact, fanout.dimension_tables())
    assert rows_of(_published(REPORTS[name].build(marts))) == rows_of_sql(duck, fanout_oracle()[name])


def test_fanout_totals_equal_the_fact(fanout):
    totals = fanout_totals(fanout.clean, fanout.dims, {n: fanout.members(n) for n in fanout.dims}).collect()[0]
    keys = [d.key for d in fanout.dims.values()]
    fact = fanout.fact.agg(
        F.count("*").alias("fact_rows"), F.sum("quantity").alias("quantity"), F.sum("total_price").alias("total_price"),
        *[F.sum(k).alias(f"{k}_sum") for k in keys],
    ).collect()[0]
    assert {k: totals[k] for k in totals.asDict()} == fact.asDict()


def test_fanout_counts_combinations(spark):
    two = [{"product_color": c, "store_city": s} for c in "ab" for s in "xyz"]
    star = star_of(spark, *two, lookup=LEAD_COLUMN)
    assert star.fact.count() == 6 * 2 * 3


def test_variant_shares_clean_rows_and_equal_members(star, fanout):
    assert fanout.clean is star.clean
    person = star.variant(grain="person")
    assert person.clean is star.clean
    assert person.dimension("customer").count() < star.dimension("customer").count()


ODD_SALES = [
    {}, {"store_state": None}, {"store_state": None, "store_city": "ST1"}, {"product_rating": None}, {"product_color": "odd"},
    {"store_name": None}, {"product_name": None}, {"sale_date": None}, {"seller_email": "other"}, {"id": None},
]


@pytest.mark.parametrize("digest", ["own", "shared"])
def test_keys_by_digest_are_those_of_the_columns(spark, monkeypatch, digest):
    """Also where members share a digest: then the columns are compared."""
    if digest == "shared":
        monkeypatch.setattr(lookup, "member_digest", lambda dim: F.when(F.col(dim.lead).isNotNull(), F.lit(1).cast("bigint")))
    star = star_of(spark, *ODD_SALES)
    others = {n: star.members(n) for n in star.dims if n != "customer"}
    keys = [d.key for n, d in star.dims.items() if n != "customer"]
    wanted = star.clean
    for name, members in others.items():
        wanted = lookup.find_key(wanted, star.dims[name], members, how="left")
    same = lambda df: sorted(map(repr, df.select("id", "sale_day", "sale_quantity", *keys).collect()))
    assert same(star.numbered) == same(wanted) and len(same(wanted)) == len(ODD_SALES)
    assert star.fact.count() == star.clean.where(" AND ".join(f"{d.lead} IS NOT NULL" for d in star.dims.values())).count()


def test_leads_do_not_travel_with_numbered_sales(spark):
    star = star_of(spark, {}, {})
    assert not {"product_name", "seller_email", "store_name", "supplier_name"} & set(star.numbered.columns)
    assert "looked_up_sales" not in star.workspace.rows


def raw_near(spark, *rows):
    """Raw rows with the column ``near`` beside the model's."""
    return sales(spark, *[{k: v for k, v in r.items() if k != "near"} for r in rows]).withColumn(
        "near", F.element_at(F.array(*[F.lit(r["near"]) for r in rows]), F.col("sale_quantity"))
    )


SOME_SALES = [
    {"id": 1, "near": 1}, {"id": 1, "near": 1}, {"id": 2, "near": 1, "customer_age": None}, {"id": 2, "near": 2}, {"id": 3, "near": 2},
    {"id": None, "near": 1}, {"id": None, "near": 2}, {"id": 4, "near": 3, "product_price": None}, {"id": 5, "near": 3}, {"id": 5, "near": 1},
]


@pytest.mark.parametrize("several", [True, False])
def test_rows_deduplicated_near_each_other(spark, several):
    """Ids in several places, the row that wins rejected or not, ids that are NULL: as by a shuffle of all rows."""
    rows = [{**r, "sale_quantity": n} for n, r in enumerate(SOME_SALES, 1)]
    rows = rows if several else [{**r, "near": 1} for r in rows]
    raw, workspace = raw_near(spark, *rows), Workspace(spark)
    found, wanted = stored_clean_sales(raw, ["sale_quantity"], workspace, "near"), clean_sales(raw, ["sale_quantity"])
    shown = lambda df: sorted(map(repr, df.collect()))
    assert found.columns == wanted.columns and shown(found) == shown(wanted)
    assert workspace.rows["clean_sales"] == wanted.count() and workspace.rows["several_ids"] == (3 if several else 0)


def test_whole_rows_are_not_shuffled_for_their_ids(spark, folder):
    from tillmart.fixture.sales import NEAR

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        plan = first_per_key(sales_raw(spark, folder), "id", ORDER, NEAR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not any("hashpartitioning(id" in line or ", id#" in line.split("hashpartitioning")[1] for line in dealt)


def test_large_dimensions_are_looked_up_after_numbering(spark, monkeypatch):
    wanted = star_of(spark, *ODD_SALES)
    wanted.prepare()
    monkeypatch.setattr(lookup, "EARLY", 0)
    late = star_of(spark, *ODD_SALES)
    shown = lambda df: sorted(map(repr, df.collect()))
    assert "product_id" not in late._placed[0].columns and "product_id" in wanted._placed[0].columns
    assert shown(late.numbered.select(*wanted.numbered.columns)) == shown(wanted.numbered)
    for name, table in wanted.tables().items():
        assert shown(late.tables()[name]) == shown(table), name


@pytest.mark.parametrize("digest", ["own", "shared"])
def test_person_keys_by_digest(spark, monkeypatch, digest):
    if digest == "shared":
        monkeypatch.setattr(lookup, "member_digest", lambda dim: F.when(F.col(dim.lead).isNotNull(), F.lit(1).cast("bigint")))
    star = star_of(spark, *ODD_SALES, {"customer_email": None}, {"customer_age": 40}, grain="person")
    members = {n: star.members(n) for n in star.dims}
    shown = lambda df: sorted(map(repr, df.collect()))
    assert shown(star.keyed) == shown(lookup.keyed_sales(star.clean, star.dims, members)) and star.keyed.count() > 5
    assert set(star.workspace.rows) >= {f"digests_{n}" for n in star.dims}


def test_loads_share_clean_rows(spark):
    """As stars of their own raw rows, but cleaned once."""
    rows = [{"id": i % 7 or None, "product_name": f"p{i}", "customer_age": i % 5 or None} for i in range(40)]
    star = star_of(spark, *rows)
    odd = F.col("id") % 2 == 1
    part, alone = star.load(odd), StarPlan(star.raw.where(odd), Workspace(spark))
    shown = lambda df: sorted(map(repr, df.collect()))
    for name, table in alone.tables().items():
        assert shown(part.tables()[name]) == shown(table), name
    assert "clean_sales" not in part.workspace.rows and "clean_sales" in star.workspace.rows


def test_person_grain_fact(spark):
    star = star_of(spark, {}, {}, {"customer_age": 40}, grain="person")
    assert star.dimension("customer").count() == 2
    assert star.fact.groupBy("customer_id").count().orderBy("count").collect()[1]["count"] == 2


def test_star_does_not_depend_on_partitions_or_row_order(spark, folder, star):
    expected = {t: _fingerprint(df, t).collect() for t, df in star.tables().items()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    again = StarPlan(sales_raw(spark, folder).repartition(5, F.rand(1)), Workspace(spark), ORDER)
    found = {t: _fingerprint(df, t).collect() for t, df in again.tables().items()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == expected


def test_sale_ids_are_dense_by_day(star):
    numbered = star.fact_with_sale_id
    assert numbered.agg(F.max("sale_id")).collect()[0][0] == numbered.count() == star.fact.count()
    by_id = [r["sale_date"] for r in numbered.orderBy("sale_id").select("sale_date").collect()]
    assert by_id == sorted(by_id)


def test_enriched_columns(star):
    wide = enrich(star.fact, star.dimension_tables())
    assert len(wide.columns) == 41
    assert wide.columns == [*FACT_COLUMNS, *[c for cols in ENRICHED.values() for c in cols.values()]]
    with pytest.raises(ValueError):
        enrich(star.fact, star.dimension_tables(), ["nonsense"])


def test_unmatched_fact_rows_form_a_null_group(star):
    stray = star.fact.limit(1).withColumn("product_id", F.lit(10**9)).withColumn("total_price", F.lit(Decimal("1.50")))
    marts = Marts(star.fact.unionByName(stray.select(star.fact.columns)), star.dimension_tables())
    found = REPORTS["revenue_by_category"].build(marts).where("category IS NULL").collect()
    assert [r["total_revenue"] for r in found] == [1.5]
    assert enrich(marts.fact, marts.dims).where("product_name IS NULL").count() == 1
    assert REPORTS["rating_sales_correlation"].build(marts).where("product_name IS NULL").count() == 0


def test_unmatched_top_customer_keeps_its_key(star):
    price = F.lit(Decimal("9999999.00"))
    stray = star.fact.limit(1).withColumn("customer_id", F.lit(10**9)).withColumn("total_price", price)
    marts = Marts(star.fact.unionByName(stray.select(star.fact.columns)), star.dimension_tables())
    first = REPORTS["top_customers"].build(marts).first()
    assert (first["customer_id"], first["customer_email"], first["total_spent"]) == (10**9, None, 9999999.0)
