"""The same results in plain SQL, for DuckDB, written independently of the engine.

Each text is a chain of common table expressions over the given tables, followed by one
query. Published types: keys and counts BIGINT, money and averages DOUBLE, dates as text.
"""

from __future__ import annotations

from tillmart.fixture.sales import COLUMNS, EXTRA, ORDER

_RAW = (
    "sales_raw AS (SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in COLUMNS.items())
    + ", "
    + ", ".join(EXTRA)
    + """
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation cn ON c_nationkey = cn.n_nationkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation sn ON s_nationkey = sn.n_nationkey)"""
)

_DAY = "CAST(try_strptime(sale_date, '%-m/%-d/%Y') AS DATE)"

_DEDUP = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY
    {", ".join(c + " NULLS FIRST" for c in ORDER)}) AS nth FROM sales_raw),
  dedup AS (SELECT * EXCLUDE (nth) FROM ranked WHERE nth = 1)"""

_CLEAN = f"""clean AS (SELECT *, {_DAY} AS sale_day FROM dedup
    WHERE customer_age IS NOT NULL AND product_price > 0)"""

# dimension: order of its keys, then pairs of source and stored column
_DIMS = {
    "customer": (
        "id",
        "customer_first_name first_name, customer_last_name last_name, customer_age age, customer_email email, "
        "customer_country country, customer_postal_code postal_code",
    ),
    "product": (
        "product_name, category, price, brand, rating, reviews, weight, color, size, material",
        "product_name product_name, product_category category, product_price price, product_brand brand, "
        "product_rating rating, product_reviews reviews, product_weight weight, product_color color, "
        "product_size size, product_material material",
    ),
    "seller": (
        "email, first_name, last_name, country, postal_code",
        "seller_first_name first_name, seller_last_name last_name, seller_email email, seller_country country, "
        "seller_postal_code postal_code",
    ),
    "store": (
        "store_name, city, state, country, phone, email",
        "store_name store_name, store_city city, store_state state, store_country country, store_phone phone, "
        "store_email email",
    ),
    "supplier": (
        "supplier_name, contact, email, phone, address, city, country",
        "supplier_name supplier_name, supplier_contact contact, supplier_email email, supplier_phone phone, "
        "supplier_address address, supplier_city city, supplier_country country",
    ),
    "time": ("sale_date", "sale_day sale_date"),
}

_LEADS = {
    "customer": "id",
    "product": "product_name",
    "seller": "seller_email",
    "store": "store_name",
    "supplier": "supplier_name",
    "time": "sale_day",
}

_PARTS = """CAST(year(sale_date) AS INT) AS year, CAST(month(sale_date) AS INT) AS month,
    CAST(day(sale_date) AS INT) AS day, CAST(quarter(sale_date) AS INT) AS quarter,
    CAST(dayofweek(sale_date) + 1 AS INT) AS week_day"""


def _pairs(name: str) -> list[tuple[str, str]]:
    return [tuple(p.split()) for p in _DIMS[name][1].split(", ")]


def _dimension(name: str) -> str:
    order, columns = _DIMS[name]
    ranked = ", ".join(f"{c} NULLS FIRST" for c in order.split(", "))
    ident = "id, " if name == "customer" else ""
    parts = f", {_PARTS}" if name == "time" else ""
    return f"""dim_{name} AS (SELECT row_number() OVER (ORDER BY {ranked}) AS {name}_id, *{parts}
    FROM (SELECT DISTINCT {ident}{columns} FROM clean))"""


def _match(name: str, lookup: str) -> str:
    stored = {s: d for s, d in _pairs(name)}
    lead = _LEADS[name]
    if name == "customer":
        return "c.id = dim_customer.id"
    tests = [f"c.{lead} = dim_{name}.{stored[lead]}"]
    if lookup == "business_key":
        tests += [f"c.{s} IS NOT DISTINCT FROM dim_{name}.{d}" for s, d in stored.items() if s != lead]
    return " AND ".join(tests)


def _kept(name: str) -> str:
    """Members of two loads: those of the first keep their keys, the second's new ones are numbered after them."""
    order, columns = _DIMS[name]
    ranked = ", ".join(f"{c} NULLS FIRST" for c in order.split(", "))
    ident = "id, " if name == "customer" else ""
    parts = f", {_PARTS}" if name == "time" else ""
    number = f"row_number() OVER (ORDER BY {ranked})"
    return f"""first_{name} AS (SELECT {number} AS {name}_id, * FROM (SELECT DISTINCT {ident}{columns} FROM clean WHERE id // 10 % 3 <> 0)),
  new_{name} AS (SELECT DISTINCT {ident}{columns} FROM clean WHERE id // 10 % 5 <> 0 EXCEPT SELECT * EXCLUDE ({name}_id) FROM first_{name}),
  kept_{name} AS (SELECT *{parts} FROM (SELECT * FROM first_{name} UNION ALL
    SELECT (SELECT count(*) FROM first_{name}) + {number}, * FROM new_{name}))"""


def _fact(lookup: str) -> str:
    joins = "\n    ".join(f"JOIN dim_{n} ON {_match(n, lookup)}" for n in _DIMS)
    return f"""fact AS (SELECT c.id, customer_id, product_id, seller_id, store_id, supplier_id, time_id,
    sale_quantity AS quantity, sale_total_price AS total_price, sale_day AS sale_date
    FROM clean c
    {joins})"""


_ENRICHED = """enriched AS (SELECT f.customer_id, f.product_id, f.seller_id, f.store_id, f.supplier_id, f.time_id,
    f.quantity, f.total_price, f.sale_date,
    p.product_name, p.category, p.price, p.brand, p.rating, p.reviews, p.weight, p.color, p.size, p.material,
    c.first_name AS customer_first_name, c.last_name AS customer_last_name, c.email AS customer_email,
    c.country AS customer_country, c.age AS customer_age,
    t.year, t.month, t.day, t.quarter, t.week_day,
    st.store_name, st.city AS store_city, st.state AS store_state, st.country AS store_country,
    st.phone AS store_phone, st.email AS store_email,
    su.supplier_name, su.contact AS supplier_contact, su.email AS supplier_email, su.phone AS supplier_phone,
    su.city AS supplier_city, su.country AS supplier_country
    FROM fact f
    LEFT JOIN dim_product p ON f.product_id = p.product_id
    LEFT JOIN dim_customer c ON f.customer_id = c.customer_id
    LEFT JOIN dim_time t ON f.time_id = t.time_id
    LEFT JOIN dim_store st ON f.store_id = st.store_id
    LEFT JOIN dim_supplier su ON f.supplier_id = su.supplier_id)"""

_MONEY_COLUMNS = {"product_price", "product_rating", "product_weight", "sale_total_price", "price", "rating",
                  "weight", "total_price"}
_DATE_COLUMNS = {"sale_day", "sale_date"}


def _publish(columns: list[str], text_dates: bool = True) -> str:
    def one(c: str) -> str:
        if c in _MONEY_COLUMNS:
            return f"CAST({c} AS DOUBLE) AS {c}"
        if c in _DATE_COLUMNS and text_dates:
            return f"CAST({c} AS VARCHAR) AS {c}"
        return c

    return ", ".join(one(c) for c in columns)


def chain(lookup: str = "business_key") -> str:
    """All common table expressions, raw rows to enriched sales."""
    return ",\n  ".join([_RAW, _DEDUP, _CLEAN, *[_dimension(n) for n in _DIMS], _fact(lookup), _ENRICHED])


def _with(query: str, lookup: str = "business_key") -> str:
    return f"WITH {chain(lookup)}\n{query}"


_SALES = list(COLUMNS)
_FACT = ["customer_id", "product_id", "seller_id", "store_id", "supplier_id", "time_id", "quantity", "total_price",
         "sale_date"]
_KEYS = _FACT[:6]

REPORT_SQL = {
    "top_products": """SELECT product_name, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold FROM enriched
        GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 NULLS FIRST LIMIT 10""",
    "revenue_by_category": """SELECT category, CAST(sum(total_price) AS DOUBLE) AS total_revenue FROM enriched
        GROUP BY 1""",
    "product_ratings": """SELECT product_name, CAST(rating AS DOUBLE) AS rating, reviews, category
        FROM dim_product WHERE rating IS NOT NULL""",
    "top_customers": """SELECT customer_id, customer_first_name, customer_last_name, customer_email,
        CAST(sum(total_price) AS DOUBLE) AS total_spent FROM enriched GROUP BY 1, 2, 3, 4
        ORDER BY sum(total_price) DESC NULLS LAST, 1 LIMIT 10""",
    "customers_by_country": "SELECT country, count(*) AS customer_count FROM dim_customer GROUP BY 1",
    "customer_avg_order": """SELECT customer_id, customer_first_name, customer_last_name,
        CAST(sum(total_price) AS DOUBLE) / count(total_price) AS avg_order_value, count(*) AS order_count,
        CAST(sum(total_price) AS DOUBLE) AS total_spent FROM enriched GROUP BY 1, 2, 3""",
    "monthly_trends": """SELECT year, month, CAST(sum(total_price) AS DOUBLE) AS monthly_revenue,
        count(*) AS order_count, CAST(sum(quantity) AS BIGINT) AS total_quantity FROM enriched GROUP BY 1, 2""",
    "yearly_comparison": """SELECT year, CAST(sum(total_price) AS DOUBLE) AS yearly_revenue,
        count(*) AS order_count FROM enriched GROUP BY 1""",
    "monthly_avg_order_size": """SELECT year, month, CAST(sum(quantity) AS DOUBLE) / count(quantity) AS avg_order_size,
        CAST(sum(total_price) AS DOUBLE) / count(total_price) AS avg_order_value FROM enriched GROUP BY 1, 2""",
    "top_stores": """SELECT store_name, store_city, store_country, CAST(sum(total_price) AS DOUBLE) AS total_revenue,
        count(*) AS order_count FROM enriched GROUP BY 1, 2, 3
        ORDER BY sum(total_price) DESC NULLS LAST, 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 5""",
    "sales_by_location": """SELECT store_country, store_city, CAST(sum(total_price) AS DOUBLE) AS total_revenue,
        count(*) AS order_count FROM enriched GROUP BY 1, 2""",
    "store_avg_check": """SELECT store_name, store_city,
        CAST(sum(total_price) AS DOUBLE) / count(total_price) AS avg_check, count(*) AS order_count,
        CAST(sum(total_price) AS DOUBLE) AS total_revenue FROM enriched GROUP BY 1, 2""",
    "top_suppliers": """SELECT supplier_name, supplier_country, CAST(sum(total_price) AS DOUBLE) AS total_revenue,
        count(*) AS order_count FROM enriched GROUP BY 1, 2
        ORDER BY sum(total_price) DESC NULLS LAST, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 5""",
    "supplier_avg_price": """SELECT supplier_name, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
        count(product_name) AS product_count FROM enriched GROUP BY 1""",
    "sales_by_supplier_country": """SELECT supplier_country, CAST(sum(total_price) AS DOUBLE) AS total_revenue,
        count(*) AS order_count FROM enriched GROUP BY 1""",
    "products_highest_rating": """SELECT product_name, CAST(rating AS DOUBLE) AS rating, reviews, category, brand
        FROM (SELECT * FROM dim_product WHERE rating IS NOT NULL
        ORDER BY rating DESC, reviews DESC NULLS LAST, product_id LIMIT 10)""",
    "products_lowest_rating": """SELECT product_name, CAST(rating AS DOUBLE) AS rating, reviews, category, brand
        FROM (SELECT * FROM dim_product WHERE rating IS NOT NULL
        ORDER BY rating ASC, reviews DESC NULLS LAST, product_id LIMIT 10)""",
    "rating_sales_correlation": """SELECT product_name, CAST(rating AS DOUBLE) AS rating, category,
        CAST(sum(quantity) AS BIGINT) AS total_sales, CAST(sum(total_price) AS DOUBLE) AS total_revenue,
        count(*) AS order_count FROM enriched GROUP BY product_name, enriched.rating, category
        HAVING enriched.rating IS NOT NULL""",
    "products_most_reviews": """SELECT product_name, reviews, CAST(rating AS DOUBLE) AS rating, category, brand
        FROM (SELECT * FROM dim_product WHERE reviews IS NOT NULL
        ORDER BY reviews DESC, product_id LIMIT 10)""",
}

ADDITION_SQL = {
    "yearly_comparison_delta": """SELECT year, CAST(revenue AS DOUBLE) AS yearly_revenue,
        CAST(lag(revenue) OVER (ORDER BY year) AS DOUBLE) AS previous_revenue,
        CAST(revenue - lag(revenue) OVER (ORDER BY year) AS DOUBLE) AS revenue_change
        FROM (SELECT year, sum(total_price) AS revenue FROM enriched WHERE year IS NOT NULL GROUP BY 1)""",
    "rating_sales_corr": """SELECT round(corr(CAST(rating AS DOUBLE), CAST(units AS DOUBLE)), 6) AS correlation,
        count(*) AS products FROM (SELECT product_name, rating, category, sum(quantity) AS units FROM enriched
        WHERE rating IS NOT NULL GROUP BY ALL)""",
    "product_rating_avg": """SELECT product_name, CAST(sum(rating) AS DOUBLE) / count(rating) AS avg_rating,
        CAST(sum(reviews) AS BIGINT) AS total_reviews FROM dim_product WHERE rating IS NOT NULL GROUP BY 1""",
}


def _stored(name: str) -> str:
    columns = [f"{name}_id", *[d for _, d in _pairs(name)]]
    if name == "time":
        columns += ["year", "month", "day", "quarter", "week_day"]
    return f"SELECT {_publish(columns)} FROM dim_{name}"


def _fingerprint(table: str, relation: str, columns: list[str]) -> str:
    """Row count and order-free checksum of a table's whole content."""
    text = ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    digest = f"md5(concat_ws('|', {text}))"
    halves = [f"CAST(coalesce(sum(CAST(CAST('0x' || substr({digest}, {at}, 16) AS UBIGINT) AS HUGEINT)), 0) AS VARCHAR)" for at in (1, 17)]
    return f"""SELECT '{table}' AS table_name, count(*) AS n_rows, {" || '-' || ".join(halves)} AS checksum
        FROM {relation}"""


def _star_fingerprints() -> str:
    rows = []
    for name in _DIMS:
        columns = [f"{name}_id", *[d for _, d in _pairs(name)]]
        if name == "time":
            columns += ["year", "month", "day", "quarter", "week_day"]
        rows.append(_fingerprint(f"dim_{name}", f"dim_{name}", columns))
    rows.append(_fingerprint("fact_sales", "fact", _FACT))
    return "\nUNION ALL ".join(rows)


def _manifest(showcases: dict[str, str]) -> str:
    rows = [
        f"SELECT '{showcase}' AS showcase, '{table}' AS table_name, count(*) AS n_rows, 'written' AS status "
        f"FROM ({REPORT_SQL[table]})"
        for table, showcase in showcases.items()
    ]
    return "\nUNION ALL ".join(rows)


def _key_checks(relation_of: dict[str, str]) -> str:
    rows = [
        f"SELECT '{table}' AS table_name, count(*) AS bad_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS bad_rows FROM "
        f"(SELECT {key}, count(*) AS n FROM {relation} GROUP BY 1 HAVING count(*) > 1 OR {key} IS NULL)"
        for table, (key, relation) in relation_of.items()
    ]
    return "\nUNION ALL ".join(rows)


def _orphan_checks(fact: str, dim_filter: str = "") -> str:
    rows = [
        f"SELECT '{n}_id' AS foreign_key, count(DISTINCT f.{n}_id) AS bad_keys, count(*) AS bad_rows FROM {fact} f "
        f"WHERE f.{n}_id IS NOT NULL AND f.{n}_id NOT IN "
        f"(SELECT {n}_id FROM dim_{n} {dim_filter})"
        for n in _DIMS
    ]
    return "\nUNION ALL ".join(rows)


_SALE_ID = "row_number() OVER (ORDER BY sale_date, id, customer_id)"


def oracle(showcases: dict[str, str]) -> dict[str, str]:
    """SQL text per query name. ``showcases`` gives the showcase of each report."""
    sales = _publish(_SALES, text_dates=False)
    person = (
        "customer_email, customer_first_name, customer_last_name, customer_age, customer_country, customer_postal_code"
    )
    texts = {
        "scan_csv_folder": f"SELECT {sales} FROM sales_raw",
        "union_sales_files": "SELECT "
        + sales.replace("seller_postal_code", "CASE WHEN id % 3 = 2 THEN NULL ELSE seller_postal_code END AS seller_postal_code")
        + " FROM sales_raw",
        "scan_csv_inferred": """SELECT CAST(id AS INT) AS id, customer_age, CAST(product_price AS DOUBLE) AS product_price,
            seller_postal_code, sale_quantity FROM sales_raw""",
        "ingest_rejects": """SELECT 'customer_age' AS column_name, 'unreadable' AS reason, 'old' AS value, count(*) AS n,
            CAST(sum(id) AS BIGINT) AS ids FROM sales_raw WHERE id % 7 = 0 HAVING count(*) > 0
            UNION ALL SELECT 'sale_total_price', 'rounded', '1.005', count(*), CAST(sum(id) AS BIGINT) FROM sales_raw
            WHERE id % 13 = 0 HAVING count(*) > 0
            UNION ALL SELECT 'sale_total_price', 'rounded', '1.00000000001', count(*), CAST(sum(id) AS BIGINT) FROM sales_raw
            WHERE id % 19 = 0 AND id % 13 <> 0 HAVING count(*) > 0
            UNION ALL SELECT 'sale_quantity', 'unreadable', '2.5', count(*), CAST(sum(id) AS BIGINT) FROM sales_raw
            WHERE id % 17 = 0 HAVING count(*) > 0
            UNION ALL SELECT 'row', 'kept', NULL, count(CASE WHEN id % 7 <> 0 THEN customer_age END),
            CAST(sum(floor(CASE WHEN id % 11 = 0 THEN 123456789 ELSE product_price END)) AS BIGINT) FROM sales_raw""",
        "load_counts": """SELECT 'loaded' AS stage, count(*) AS n_rows FROM sales_raw
            UNION ALL SELECT 'clean', count(*) FROM clean UNION ALL SELECT 'fact', count(*) FROM fact""",
        "dedup_by_id": f"SELECT {sales} FROM dedup",
        "filter_age_not_null": f"SELECT {sales} FROM sales_raw WHERE customer_age IS NOT NULL",
        "filter_price_positive": f"SELECT {sales} FROM sales_raw WHERE product_price > 0",
        "parse_sale_date": f"SELECT id, sale_date, CAST({_DAY} AS VARCHAR) AS sale_day FROM sales_raw",
        "date_parts": f"""SELECT o_orderkey, {_PARTS} FROM
            (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS sale_date FROM orders)""",
        "clean_sales": f"SELECT {sales}, CAST(sale_day AS VARCHAR) AS sale_day FROM clean",
        "surrogate_key_dense": """SELECT l_returnflag, l_suppkey, l_partkey, row_number() OVER (ORDER BY
            l_returnflag NULLS FIRST, l_suppkey NULLS FIRST, l_partkey NULLS FIRST) AS row_key
            FROM (SELECT DISTINCT l_returnflag, nullif(l_suppkey, 1) AS l_suppkey, l_partkey FROM lineitem)""",
        **{f"dim_{n}": _stored(n) for n in _DIMS},
        **{f"lookup_{n}": f"SELECT c.id, {n}_id FROM clean c JOIN dim_{n} ON {_match(n, 'business_key')}"
           for n in _DIMS},
        "fact_sales": f"SELECT {_publish(_FACT)} FROM fact",
        "sales_enriched": "SELECT * REPLACE (" + ", ".join(
            [f"CAST({c} AS DOUBLE) AS {c}" for c in ("total_price", "price", "rating", "weight")]
            + ["CAST(sale_date AS VARCHAR) AS sale_date"]) + ") FROM enriched",
        "sink_star_roundtrip": _star_fingerprints(),
        "sink_mart_roundtrip": REPORT_SQL["customer_avg_order"],
        "publish_manifest": _manifest(showcases),
        "check_pk_duplicates": _key_checks({f"dim_{n}": (f"{n}_id", f"dim_{n}") for n in _DIMS}),
        "check_pk_duplicates_negative": _key_checks({"dim_product": (
            "product_id", "(SELECT * FROM dim_product UNION ALL SELECT * FROM dim_product WHERE rating IS NULL)")}),
        "check_fk_orphans": _orphan_checks("fact"),
        "check_fk_orphans_negative": """SELECT 'product_id' AS foreign_key, count(DISTINCT product_id) AS bad_keys,
            count(*) AS bad_rows FROM fact WHERE product_id NOT IN
            (SELECT product_id FROM dim_product WHERE rating IS NOT NULL)""",
        **REPORT_SQL,
        **ADDITION_SQL,
        "fact_sale_id": f"SELECT {_SALE_ID} AS sale_id, {_publish(_FACT)} FROM fact",
        "fact_sales_person": f"""SELECT {_publish(_FACT)} FROM
            (SELECT fact.* EXCLUDE (customer_id), p.customer_id FROM fact JOIN clean c ON c.id = fact.id
            JOIN (SELECT row_number() OVER (ORDER BY {", ".join(c + " NULLS FIRST" for c in person.split(", "))})
            AS customer_id, * FROM (SELECT DISTINCT {person} FROM clean)) p
            ON {" AND ".join(f"c.{c} IS NOT DISTINCT FROM p.{c}" for c in person.split(", "))})""",
        "dim_customer_person": f"""SELECT row_number() OVER (ORDER BY
            {", ".join(c + " NULLS FIRST" for c in person.split(", "))}) AS customer_id,
            customer_first_name AS first_name, customer_last_name AS last_name, customer_age AS age,
            customer_email AS email, customer_country AS country, customer_postal_code AS postal_code
            FROM (SELECT DISTINCT {person} FROM clean)""",
    }
    kept = f"""WITH {_RAW}, {_DEDUP}, {_CLEAN}, {", ".join(_kept(n) for n in _DIMS)}"""
    joins = " ".join(f"JOIN kept_{n} AS dim_{n} ON {_match(n, 'business_key')}" for n in _DIMS)
    result = {name: _with(text) for name, text in texts.items()}
    result |= {f"dim_{n}_kept": f"{kept} {_stored(n).replace(f'dim_{n}', f'kept_{n}')}" for n in _DIMS}
    result["fact_sales_kept"] = f"""{kept}, fact AS (SELECT c.id, customer_id, product_id, seller_id, store_id, supplier_id, time_id,
        sale_quantity AS quantity, sale_total_price AS total_price, sale_day AS sale_date FROM clean c {joins} WHERE c.id // 10 % 5 <> 0)
        SELECT {_publish(_FACT)} FROM fact"""
    result["fact_sales_fanout"] = _with(
        "SELECT count(*) AS fact_rows, CAST(sum(quantity) AS BIGINT) AS quantity, "
        "CAST(sum(total_price) AS DOUBLE) AS total_price, "
        + ", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}_sum" for k in _KEYS)
        + " FROM fact",
        "lead_column",
    )
    return result


def fanout_oracle() -> dict[str, str]:
    """Fact and reports under the lead-column lookup."""
    texts = {"fact_sales": f"SELECT {_publish(_FACT)} FROM fact", **REPORT_SQL}
    return {name: _with(text, "lead_column") for name, text in texts.items()}
