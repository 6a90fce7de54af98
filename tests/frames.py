"""Small literal sales rows for edge cases."""

from decimal import Decimal

from tillmart.schema import SALES, SALES_COLUMNS

GOOD = {
    **{name: name for name, kind in SALES_COLUMNS.items() if kind.typeName() == "string"},
    "customer_age": 30,
    "product_price": Decimal("5.00"),
    "product_rating": Decimal("4.00"),
    "product_reviews": 10,
    "product_weight": Decimal("1.00"),
    "sale_date": "7/4/2021",
    "sale_quantity": 2,
    "sale_total_price": Decimal("10.00"),
}


def sales(spark, *rows):
    """One sales row per dict; columns not given are those of a good row, ids count up."""
    full = [{"id": i, **GOOD, **row} for i, row in enumerate(rows, 1)]
    return spark.createDataFrame([tuple(r[c] for c in SALES_COLUMNS) for r in full], SALES)
