"""Wide sales rows derived from the TPC-H-like tables.

The expressions are plain SQL that Spark and DuckDB evaluate alike, so the same text
defines the rows for the engine and for the independent SQL that checks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.sources.tables import folder_bytes

COLUMNS: dict[str, str] = {
    "id": "l_orderkey*10 + l_linenumber",
    "customer_first_name": "c_name",
    "customer_last_name": "c_mktsegment",
    "customer_age": "CASE WHEN c_custkey%20=0 THEN NULL ELSE CAST(18+c_custkey%60 AS INT) END",
    "customer_email": "concat(lower(c_name),'@c.example')",
    "customer_country": "cn.n_name",
    "customer_postal_code": "lpad(CAST(c_custkey%100000 AS VARCHAR(10)),5,'0')",
    "product_name": "concat('Product ',CAST(floor(p_partkey/2) AS BIGINT))",
    "product_category": "p_type",
    "product_price": "CASE WHEN p_partkey%50=0 THEN CAST(0 AS DECIMAL(10,2))"
    " ELSE CAST(p_retailprice AS DECIMAL(10,2)) END",
    "product_brand": "p_brand",
    "product_rating": "CASE WHEN p_partkey%17=0 THEN NULL ELSE CAST((10+p_partkey%41)/10.0 AS DECIMAL(3,2)) END",
    "product_reviews": "CASE WHEN p_partkey%23=0 THEN NULL ELSE CAST((p_partkey*7)%1001 AS INT) END",
    "product_weight": "CAST(p_size AS DECIMAL(10,2))",
    "product_color": "split_part(p_name,' ',1)",
    "product_size": "concat('size ',p_size)",
    "product_material": "split_part(p_name,' ',2)",
    "seller_first_name": "concat('Seller',l_orderkey%97)",
    "seller_last_name": "concat('Last',l_orderkey%97)",
    "seller_email": "concat('seller',l_orderkey%97,'@s.example')",
    "seller_country": "concat('Country',(l_orderkey%97)%5)",
    "seller_postal_code": "CASE WHEN l_orderkey%194<97 THEN '00001' ELSE 'AB-2' END",
    "store_name": "concat('Store ',(l_orderkey%31)%25)",
    "store_city": "concat('City ',(l_orderkey%31)%7)",
    "store_state": "CASE WHEN l_orderkey%31<10 THEN NULL ELSE concat('ST',l_orderkey%31) END",
    "store_country": "concat('Land ',(l_orderkey%31)%3)",
    "store_phone": "concat('+1-',l_orderkey%31)",
    "store_email": "concat('store',l_orderkey%31,'@st.example')",
    "supplier_name": "s_name",
    "supplier_contact": "concat('Rep ',s_suppkey)",
    "supplier_email": "concat('sup',s_suppkey,'@su.example')",
    "supplier_phone": "concat('+2-',s_suppkey)",
    "supplier_address": "concat(s_suppkey,' Main St')",
    "supplier_city": "concat('SCity ',s_suppkey%13)",
    "supplier_country": "sn.n_name",
    "sale_date": "CASE WHEN l_orderkey%211=0 THEN NULL WHEN l_orderkey%307=0 THEN '13/40/2021'"
    " ELSE concat(month(o_orderdate),'/',day(o_orderdate),'/',year(o_orderdate)) END",
    "sale_quantity": "CAST(l_quantity AS INT)",
    "sale_total_price": "CAST(l_extendedprice AS DECIMAL(10,2))",
}

# Columns beside the model's that settle which of several rows with one id survives.
EXTRA = ["l_partkey", "l_suppkey", "l_shipdate", "l_discount", "l_tax"]

# The column that the last large join deals the rows out by; rows with one id usually share it.
NEAR = "l_orderkey"

ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "sale_quantity", "sale_total_price", "l_discount", "l_tax"]


# Bytes of line items and orders, as stored, per part that they are dealt out into. The wide rows take some forty
# times that in a task that sorts them: 8 MB leave a task well within a gigabyte.
PART_BYTES = 8 * 1024 * 1024


def dealt(rows: DataFrame, column: str, parts: int) -> DataFrame:
    """``rows`` dealt out by ``column`` into ``parts``. Few parts are left to Spark, which would also take as few for
    many rows: it goes by what is shuffled, and doesn't know that the rows get wide afterwards."""
    return rows.repartition(parts, column) if parts > rows.sparkSession.sparkContext.defaultParallelism else rows


def sales_raw(spark: SparkSession, folder: str) -> DataFrame:
    """One wide sales row per line item of the tables in ``folder``."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    # Tables are joined as they are stored: of a join's result Spark doesn't know the size, and would shuffle the
    # line items for the smallest table. The larger tables first, while the rows are narrow.
    nation, part = table("nation"), table("part")
    parts = -(-sum(folder_bytes(spark, f"{folder}/{name}.parquet") for name in ("lineitem", "orders")) // PART_BYTES)
    orders = table("orders").join(table("customer"), F.expr("o_custkey = c_custkey"))
    # Equal to l_partkey: one of them travels.
    items = table("lineitem").join(part, F.expr("l_partkey = p_partkey")).drop("p_partkey")
    return (
        dealt(items, "l_orderkey", parts)
        .join(dealt(orders, "o_orderkey", parts), F.expr("l_orderkey = o_orderkey"))
        .join(table("supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(nation.alias("cn"), F.expr("c_nationkey = cn.n_nationkey"))
        .join(nation.alias("sn"), F.expr("s_nationkey = sn.n_nationkey"))
        .withColumn("p_partkey", F.col("l_partkey").cast(part.schema["p_partkey"].dataType))
        .select(*[F.expr(sql).alias(name) for name, sql in COLUMNS.items()], *EXTRA, NEAR)
    )
