"""Data model: the wide sales row, the six dimensions, the fact, and their stored types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)  # sixteen digits before the point
RATING = T.DecimalType(5, 2)
TEXT = T.StringType()
INT = T.IntegerType()
KEY = T.LongType()  # one customer key per sale: more than 2^31 keys at full size

# Column names and types of the wide sales row.
SALES_COLUMNS: dict[str, T.DataType] = {
    "id": KEY,
    "customer_first_name": TEXT,
    "customer_last_name": TEXT,
    "customer_age": INT,
    "customer_email": TEXT,
    "customer_country": TEXT,
    "customer_postal_code": TEXT,
    "product_name": TEXT,
    "product_category": TEXT,
    "product_price": MONEY,
    "product_brand": TEXT,
    "product_rating": RATING,
    "product_reviews": INT,
    "product_weight": MONEY,
    "product_color": TEXT,
    "product_size": TEXT,
    "product_material": TEXT,
    "seller_first_name": TEXT,
    "seller_last_name": TEXT,
    "seller_email": TEXT,
    "seller_country": TEXT,
    "seller_postal_code": TEXT,
    "store_name": TEXT,
    "store_city": TEXT,
    "store_state": TEXT,
    "store_country": TEXT,
    "store_phone": TEXT,
    "store_email": TEXT,
    "supplier_name": TEXT,
    "supplier_contact": TEXT,
    "supplier_email": TEXT,
    "supplier_phone": TEXT,
    "supplier_address": TEXT,
    "supplier_city": TEXT,
    "supplier_country": TEXT,
    "sale_date": TEXT,
    "sale_quantity": INT,
    "sale_total_price": MONEY,
}

SALES = T.StructType([T.StructField(name, kind) for name, kind in SALES_COLUMNS.items()])

SALE_DAY = "sale_day"  # parsed form of the text column sale_date


@dataclass(frozen=True)
class Dimension:
    """How one dimension is cut out of the clean sales rows.

    ``attributes`` maps source column to stored column. Keys are numbered in the order of
    ``lead``, then of the remaining columns. ``identity`` lists source columns that tell
    members apart but are not stored.
    """

    name: str
    lead: str
    attributes: dict[str, str]
    identity: tuple[str, ...] = ()
    unique_lead: bool = False
    null_lead: bool = False  # a sale without lead value belongs to the member without it

    @property
    def key(self) -> str:
        return f"{self.name}_id"

    @property
    def table(self) -> str:
        return f"dim_{self.name}"

    @property
    def sources(self) -> list[str]:
        """Source columns, lead first: the order in which keys are numbered."""
        return [self.lead] + [c for c in (*self.identity, *self.attributes) if c != self.lead]

    @property
    def match(self) -> list[str]:
        """Source columns that identify one member."""
        return [self.lead] if self.unique_lead else self.sources


# Which source columns feed which dimension columns.
CUSTOMER_ATTRIBUTES = {
    "customer_first_name": "first_name",
    "customer_last_name": "last_name",
    "customer_age": "age",
    "customer_email": "email",
    "customer_country": "country",
    "customer_postal_code": "postal_code",
}

# One customer per sale row: the sale id is part of the identity.
CUSTOMER = Dimension("customer", "id", CUSTOMER_ATTRIBUTES, identity=("id",), unique_lead=True)

# One customer per person.
PERSON = Dimension("customer", "customer_email", CUSTOMER_ATTRIBUTES, null_lead=True)

PRODUCT = Dimension(
    "product",
    "product_name",
    {
        "product_name": "product_name",
        "product_category": "category",
        "product_price": "price",
        "product_brand": "brand",
        "product_rating": "rating",
        "product_reviews": "reviews",
        "product_weight": "weight",
        "product_color": "color",
        "product_size": "size",
        "product_material": "material",
    },
)

SELLER = Dimension(
    "seller",
    "seller_email",
    {
        "seller_first_name": "first_name",
        "seller_last_name": "last_name",
        "seller_email": "email",
        "seller_country": "country",
        "seller_postal_code": "postal_code",
    },
)

STORE = Dimension(
    "store",
    "store_name",
    {
        "store_name": "store_name",
        "store_city": "city",
        "store_state": "state",
        "store_country": "country",
        "store_phone": "phone",
        "store_email": "email",
    },
)

SUPPLIER = Dimension(
    "supplier",
    "supplier_name",
    {
        "supplier_name": "supplier_name",
        "supplier_contact": "contact",
        "supplier_email": "email",
        "supplier_phone": "phone",
        "supplier_address": "address",
        "supplier_city": "city",
        "supplier_country": "country",
    },
)

TIME = Dimension("time", SALE_DAY, {SALE_DAY: "sale_date"}, unique_lead=True)

DIMENSIONS = {d.name: d for d in (CUSTOMER, PRODUCT, SELLER, STORE, SUPPLIER, TIME)}
CUSTOMER_GRAINS = {"sale": CUSTOMER, "person": PERSON}


def dimensions(grain: str = "sale") -> dict[str, Dimension]:
    """The six dimensions with the customer at the asked grain."""
    return {**DIMENSIONS, "customer": CUSTOMER_GRAINS[grain]}


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Stored tables, their columns in order, and their types.
TABLES: dict[str, T.StructType] = {
    "dim_customer": _fields(
        customer_id=KEY, first_name=TEXT, last_name=TEXT, age=INT, email=TEXT, country=TEXT, postal_code=TEXT
    ),
    "dim_product": _fields(
        product_id=KEY, product_name=TEXT, category=TEXT, price=MONEY, brand=TEXT, rating=RATING, reviews=INT,
        weight=MONEY, color=TEXT, size=TEXT, material=TEXT,
    ),
    "dim_seller": _fields(
        seller_id=KEY, first_name=TEXT, last_name=TEXT, email=TEXT, country=TEXT, postal_code=TEXT
    ),
    "dim_store": _fields(
        store_id=KEY, store_name=TEXT, city=TEXT, state=TEXT, country=TEXT, phone=TEXT, email=TEXT
    ),
    "dim_supplier": _fields(
        supplier_id=KEY, supplier_name=TEXT, contact=TEXT, email=TEXT, phone=TEXT, address=TEXT, city=TEXT,
        country=TEXT,
    ),
    "dim_time": _fields(
        time_id=KEY, sale_date=T.DateType(), year=INT, month=INT, day=INT, quarter=INT, week_day=INT
    ),
    "fact_sales": _fields(
        customer_id=KEY, product_id=KEY, seller_id=KEY, store_id=KEY, supplier_id=KEY, time_id=KEY, quantity=INT,
        total_price=MONEY, sale_date=T.DateType(),
    ),
}

# Stored beside the star if asked for.
EXTRA_TABLES = {"fact_sale_id": T.StructType([T.StructField("sale_id", KEY), *TABLES["fact_sales"].fields])}

# Text widths of the stored tables; columns not named here are unbounded text.
TEXT_WIDTHS: dict[str, dict[str, int]] = {
    "dim_customer": {"first_name": 100, "last_name": 100, "email": 200, "country": 100, "postal_code": 20},
    "dim_product": {"product_name": 200, "category": 100, "brand": 100, "color": 50, "size": 50, "material": 100},
    "dim_seller": {"first_name": 100, "last_name": 100, "email": 200, "country": 100, "postal_code": 20},
    "dim_store": {"store_name": 200, "city": 100, "state": 100, "country": 100, "phone": 50, "email": 200},
    "dim_supplier": {
        "supplier_name": 200, "contact": 200, "email": 200, "phone": 50, "city": 100, "country": 100,
    },
}

PRIMARY_KEYS = {d.table: d.key for d in DIMENSIONS.values()}
FOREIGN_KEYS = [(d.key, d.table) for d in DIMENSIONS.values()]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Column order and types of a stored table; columns it does not have are dropped."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in {**TABLES, **EXTRA_TABLES}[table]])


def jdbc_column_types(table: str) -> str:
    """Value of the JDBC option ``createTableColumnTypes``: bounded text instead of CLOB."""
    return ", ".join(f"{column} VARCHAR({width})" for column, width in TEXT_WIDTHS.get(table, {}).items())
