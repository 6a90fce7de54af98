"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.fixture.sales import NEAR, ORDER, sales_raw
from tillmart.functions.calendar import calendar_parts, parse_sale_date
from tillmart.functions.measures import amount
from tillmart.operators.checks import duplicate_keys, orphan_keys, violation_counts
from tillmart.operators.clean import age_known, first_rows, price_positive
from tillmart.operators.enrich import enrich
from tillmart.operators.lookup import fanout_totals, find_key
from tillmart.operators.numbering import number_rows
from tillmart.plans.ingest import Ingest
from tillmart.plans.integrity import foreign_key_violations, primary_key_violations
from tillmart.plans.publish import load_keys, load_star, publish, store_star
from tillmart.plans.reports import ADDITIONS, REPORTS, Marts
from tillmart.plans.star import StarPlan
from tillmart.schema import DIMENSIONS, SALE_DAY, SALES_COLUMNS, TABLES
from tillmart.sources.csv_feed import REJECT, REJECTED, reject_rows, scan_csv_folder
from tillmart.sources.tables import Target
from tillmart.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

_PLANS: dict[tuple, StarPlan] = {}
_READ = ("lineitem", "orders", "customer", "supplier", "part", "nation")


def _state(spark: SparkSession, folder: str) -> tuple:
    """Size and time of the files that a star is made from."""
    jvm, found = spark._jvm, []
    for name in _READ:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        found += [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files.listStatus(path)]
    return tuple(found)


def star_plan(spark: SparkSession, folder: str) -> StarPlan:
    """The star of a folder; its tables are written once per Spark application and state of the files."""
    slot = (spark.sparkContext.applicationId, folder, _state(spark, folder))
    if slot not in _PLANS:
        _PLANS[slot] = StarPlan(sales_raw(spark, folder), Workspace(spark), ORDER, near=NEAR)
    return _PLANS[slot]


def _marts(spark: SparkSession, folder: str) -> Marts:
    star = star_plan(spark, folder)
    return Marts(star.fact, star.dimension_tables())


def _published(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as text, so that any reader shows the same values."""

    def one(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select([one(f) for f in df.schema])


def _fingerprint(df: DataFrame, table: str) -> DataFrame:
    """Row count and order-free checksum of a table's whole content: the sums of both halves of the
    rows' MD5. A value goes in with its length, so no two rows read alike; NULL has none."""

    def shown(column: str):
        text = F.col(column).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    digest = F.md5(F.concat_ws("|", *[shown(c) for c in df.columns]))
    halves = [F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    sums = [F.coalesce(F.sum(half), F.lit(0)).cast("decimal(38,0)").cast("string") for half in halves]
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.concat_ws("-", *sums).alias("checksum"),
    )


# --- sources ------------------------------------------------------------------------------


def _feed(rows: DataFrame, feed: str) -> None:
    """Add ``rows`` to the CSV files of a folder, packed: as plain text they take some 350 bytes each."""
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    rows.write.options(header=True, **packed).mode("append").csv(feed)


def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    feed = Workspace(spark).path("feed")
    _feed(sales_raw(spark, folder).select(*SALES_COLUMNS), feed)
    return scan_csv_folder(spark, feed)


def scan_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """Files in two layouts; types come from the values of all of them."""
    feed = Workspace(spark).path("feed")
    raw = sales_raw(spark, folder).select("id", "customer_age", "product_price", "seller_postal_code", "sale_quantity")
    odd = F.col("id") % 2 == 1
    _feed(raw.where(odd), feed)
    _feed(raw.where(~odd).select(*raw.columns[::-1]), feed)
    return scan_csv_folder(spark, feed, mixed=True, infer=True).select(*raw.columns)


def union_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files in three layouts in one folder; every row is in one of them."""
    feed = Workspace(spark).path("feed")
    raw = sales_raw(spark, folder)
    columns = list(SALES_COLUMNS)
    layouts = [columns, columns[::-1], [c for c in columns if c != "seller_postal_code"]]
    part = F.coalesce(F.col("id") % len(layouts), F.lit(0))
    for number, layout in enumerate(layouts):
        _feed(raw.where(part == number).select(*layout), feed)
    return scan_csv_folder(spark, feed, mixed=True)


def ingest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Values that don't fit, planted in a feed by remainders of the id: told one by one, and no row lost."""
    feed = Workspace(spark).path("feed")
    raw = sales_raw(spark, folder).select(*SALES_COLUMNS)
    text = {c: F.col(c).cast("string") for c in ("customer_age", "product_price", "sale_total_price", "sale_quantity")}
    every = lambda n: F.col("id") % n == 0
    planted = raw.withColumns(
        {
            "customer_age": F.when(every(7), "old").otherwise(F.concat(text["customer_age"], F.lit(".0"))),
            "product_price": F.when(every(11), "123456789.00").otherwise(text["product_price"]),
            "sale_total_price": F.when(every(13), "1.005").when(every(19), "1.00000000001").otherwise(text["sale_total_price"]),
            "sale_quantity": F.when(every(17), "2.5").otherwise(text["sale_quantity"]),
        }
    )
    _feed(planted, feed)
    scan = scan_csv_folder(spark, feed, source_file=True, rejects=True)
    told = reject_rows(scan).groupBy("column_name", "reason", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))
    kept = scan.agg(
        F.lit("row").alias("column_name"), F.lit("kept").alias("reason"), F.lit(None).cast("string").alias("value"),
        F.count("customer_age").alias("n"), F.sum(F.floor("product_price")).cast("bigint").alias("ids"),
    )
    return told.unionAll(kept)


def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows read, kept by cleaning, and stored as facts, all counted while they are written."""
    raw = sales_raw(spark, folder).withColumn(REJECTED, F.array().cast(REJECT))
    ingest = Ingest(raw)
    star = StarPlan(ingest.rows, Workspace(spark), ORDER, near=NEAR)
    star.keyed  # noqa: B018  (writes clean rows and fact)
    rows = star.workspace.rows
    counted = [("loaded", ingest.loaded), ("clean", rows["clean_sales"]), ("fact", rows["fact_sales"])]
    return spark.createDataFrame(counted, "stage string, n_rows bigint")


# --- sinks and checks ---------------------------------------------------------------------


def star_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write all star tables twice over each other, read them back, fingerprint them."""
    star = star_plan(spark, folder)
    target = Target(Workspace(spark).path("star"))
    for _ in range(2):
        store_star(star.tables(), target)
    prints = [_fingerprint(df, name) for name, df in load_star(spark, target).items()]
    return reduce(DataFrame.unionAll, prints)


def mart_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write the largest mart with an engine option, read it back."""
    target = Target(Workspace(spark).path("marts"), options={"compression": "zstd"})
    report = REPORTS["customer_avg_order"]
    target.write(report.build(_marts(spark, folder)), report.table)
    return target.read(spark, report.table)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    star = star_plan(spark, folder)
    workspace = Workspace(spark)
    marts = Marts(star.fact, star.dimension_tables(), workspace, ordered=False)
    written = publish(marts, Target(workspace.path("marts")))
    return written.select("showcase", "table_name", F.col("rows").alias("n_rows"), "status")


def pk_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return primary_key_violations(star_plan(spark, folder).tables())


def pk_duplicates_negative(spark: SparkSession, folder: str) -> DataFrame:
    """Products without a rating are there twice."""
    products = star_plan(spark, folder).dimension("product")
    broken = products.unionAll(products.where(F.col("rating").isNull()))
    found = violation_counts(duplicate_keys(broken, "product_id"))
    return found.select(F.lit("dim_product").alias("table_name"), "bad_keys", "bad_rows")


def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return foreign_key_violations(star_plan(spark, folder).tables())


def fk_orphans_negative(spark: SparkSession, folder: str) -> DataFrame:
    """Products without a rating are missing."""
    tables = star_plan(spark, folder).tables()
    rated = tables["dim_product"].where(F.col("rating").isNotNull())
    found = violation_counts(orphan_keys(tables["fact_sales"], "product_id", rated))
    return found.select(F.lit("product_id").alias("foreign_key"), "bad_keys", "bad_rows")


# --- cleaning -----------------------------------------------------------------------------


def _sales(df: DataFrame) -> DataFrame:
    return _published(df.select(*SALES_COLUMNS))


def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return orders.select("o_orderkey", *[part.alias(n) for n, part in calendar_parts("o_orderdate").items()])


def parsed_dates(spark: SparkSession, folder: str) -> DataFrame:
    return sales_raw(spark, folder).select("id", "sale_date", parse_sale_date("sale_date").alias(SALE_DAY))


# --- dimensions, lookups, fact ------------------------------------------------------------


def surrogate_key_dense(spark: SparkSession, folder: str) -> DataFrame:
    """Numbering with three lead values and NULLs in the second column."""
    supplier = F.nullif("l_suppkey", F.lit(1)).alias("l_suppkey")
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_returnflag", supplier, "l_partkey").distinct()
    order = ["l_returnflag", "l_suppkey", "l_partkey"]
    return number_rows(rows, order, "row_key", Workspace(spark), "numbered")


def _dimension(name: str) -> Query:
    return lambda spark, folder: _published(star_plan(spark, folder).dimension(name))


def _kept_dimension(name: str) -> Query:
    return lambda spark, folder: _published(kept_star(spark, folder).dimension(name))


def _lookup(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        star = star_plan(spark, folder)
        return find_key(star.clean, star.dims[name], star.members(name)).select("id", star.dims[name].key)

    return query


_KEPT: dict[tuple, StarPlan] = {}


def kept_star(spark: SparkSession, folder: str) -> StarPlan:
    """The second of two loads, whose members keep the keys of the first. The first one brings two thirds
    of the orders, the second four fifths: some members are new, some have gone."""
    slot = (spark.sparkContext.applicationId, folder, _state(spark, folder))
    if slot not in _KEPT:
        star, order = star_plan(spark, folder), F.floor(F.col("id") / 10)
        first = star.load(order % 3 != 0)
        target = Target(first.workspace.path("star"))
        store_star({**first.tables(write_fact=False), **first.key_maps()}, target)
        _KEPT[slot] = star.load(order % 5 != 0, known=load_keys(spark, target, DIMENSIONS))
    return _KEPT[slot]


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _published(star_plan(spark, folder).fact)


def fact_sales_fanout(spark: SparkSession, folder: str) -> DataFrame:
    star = star_plan(spark, folder)
    star.prepare()
    totals = fanout_totals(star.clean, star.dims, {name: star.members(name) for name in star.dims})
    return totals.withColumn("total_price", amount("total_price"))


def fact_sale_id(spark: SparkSession, folder: str) -> DataFrame:
    numbered = star_plan(spark, folder).fact_with_sale_id
    return _published(numbered.select("sale_id", *TABLES["fact_sales"].names))


def sales_enriched(spark: SparkSession, folder: str) -> DataFrame:
    star = star_plan(spark, folder)
    return _published(enrich(star.fact, star.dimension_tables()))


# --- reports ------------------------------------------------------------------------------


def _mart(name: str) -> Query:
    report = {**REPORTS, **ADDITIONS}[name]
    return lambda spark, folder: _published(report.build(_marts(spark, folder)))


def registry() -> dict[str, Query]:
    return {
        "scan_csv_folder": lambda s, d: _published(scan_csv(s, d)),
        "union_sales_files": lambda s, d: _published(union_files(s, d)),
        "scan_csv_inferred": lambda s, d: _published(scan_inferred(s, d)),
        "ingest_rejects": ingest_rejects,
        "load_counts": load_counts,
        "sink_star_roundtrip": star_roundtrip,
        "sink_mart_roundtrip": mart_roundtrip,
        "publish_manifest": manifest,
        "check_pk_duplicates": pk_duplicates,
        "check_pk_duplicates_negative": pk_duplicates_negative,
        "check_fk_orphans": fk_orphans,
        "check_fk_orphans_negative": fk_orphans_negative,
        "dedup_by_id": lambda s, d: _sales(first_rows(sales_raw(s, d), "id", ORDER, Workspace(s), NEAR)),
        "filter_age_not_null": lambda s, d: _sales(age_known(sales_raw(s, d))),
        "filter_price_positive": lambda s, d: _sales(price_positive(sales_raw(s, d))),
        "parse_sale_date": lambda s, d: _published(parsed_dates(s, d)),
        "date_parts": date_parts,
        "clean_sales": lambda s, d: _published(star_plan(s, d).clean),
        "surrogate_key_dense": surrogate_key_dense,
        **{f"dim_{name}": _dimension(name) for name in DIMENSIONS},
        **{f"lookup_{name}": _lookup(name) for name in DIMENSIONS},
        "fact_sales": fact_sales,
        **{f"dim_{name}_kept": _kept_dimension(name) for name in DIMENSIONS},
        "fact_sales_kept": lambda s, d: _published(kept_star(s, d).fact),
        "fact_sales_fanout": fact_sales_fanout,
        "sales_enriched": sales_enriched,
        **{name: _mart(name) for name in REPORTS},
        "fact_sale_id": fact_sale_id,
        **{name: _mart(name) for name in ADDITIONS},
        "fact_sales_person": lambda s, d: _published(star_plan(s, d).variant(grain="person").fact),
        "dim_customer_person": lambda s, d: _published(star_plan(s, d).variant(grain="person").dimension("customer")),
    }
