"""Date parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SALE_DATE_FORMAT = "M/d/yyyy"  # fixed value: text form of the sale date


def parse_sale_date(text: Column | str) -> Column:
    """Date of a text such as ``7/4/2021``; NULL where the text is not a date."""
    return F.try_to_date(text, SALE_DATE_FORMAT)


def calendar_parts(day: Column | str) -> dict[str, Column]:
    """Year, month, day, quarter and day of the week (1 = Sunday … 7 = Saturday)."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "quarter": F.quarter(day),
        "week_day": F.dayofweek(day),
    }
