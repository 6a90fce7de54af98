"""Parallel reads of a database table in ranges of a key that hold about equally many rows.

Equal ranges between the smallest and the largest key are uneven where keys have gaps or crowds. The database
is asked for a histogram of the key instead, a few thousand rows whatever the table's size; intervals that hold
more than a reading task's share are asked for again, finer, down to single keys. From the counts come as
many predicates as there are tasks to be; together they cover every row once, rows without a key included.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import pairwise

#: Intervals that one query asks for at least (four per task otherwise), and how often crowded ones are asked for again.
INTERVALS, REFINEMENTS = 1024, 8

#: Asks the database: first key, last key and rows of every interval of a histogram query.
Ask = Callable[[str], list[tuple[int, int]]]


def ends_query(table: str, key: str) -> str:
    return f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}"


def histogram_query(table: str, key: str, low: int, high: int, intervals: int = INTERVALS) -> str:
    """Rows per interval of the keys from ``low`` to ``high``: place of the interval and its rows."""
    width = interval_width(low, high, intervals)
    place = f"FLOOR(({key} - {low}) / {width})" if width > 1 else f"{key} - {low}"
    return f"SELECT {place} AS place, COUNT(*) AS n FROM {table} WHERE {key} >= {low} AND {key} <= {high} GROUP BY {place}"


def interval_width(low: int, high: int, intervals: int = INTERVALS) -> int:
    return max(1, -(-(high - low + 1) // intervals))


def histogram(ask: Ask, table: str, key: str, low: int, high: int, partitions: int) -> list[tuple[int, int]]:
    """(first key, rows) of intervals in order, none of which, single keys apart, holds more than half a task's
    share of the rows; intervals without rows are left out."""

    intervals = max(INTERVALS, 4 * partitions)

    def counted(first: int, last: int) -> list[tuple[int, int, int]]:
        width = interval_width(first, last, intervals)
        found = sorted((int(place), int(n)) for place, n in ask(histogram_query(table, key, first, last, intervals)))
        return [(first + place * width, min(last, first + (place + 1) * width - 1), n) for place, n in found]

    parts = counted(low, high)
    share = sum(n for _, _, n in parts) / max(1, partitions)
    for _ in range(REFINEMENTS):
        crowded = [p for p in parts if p[2] > share / 2 and p[1] > p[0]]
        if not crowded:
            break
        parts = [q for p in parts for q in (counted(p[0], p[1]) if p in crowded else [p])]
    return [(first, n) for first, _, n in parts]


def bounds(parts: list[tuple[int, int]], partitions: int) -> list[int]:
    """Keys at which a new range begins, so that ranges hold about equally many rows."""
    total, begun, out = sum(n for _, n in parts), 0, []
    for first, n in parts:
        # A range ends before the interval that would take it further over its share than it is below.
        if begun and len(out) < partitions - 1 and begun + n / 2 >= total * (len(out) + 1) / partitions:
            out.append(first)
        begun += n
    return out


def range_predicates(key: str, cuts: list[int]) -> list[str]:
    """Conditions of the ranges between ``cuts``; the first one also takes rows without a key."""
    if not cuts:
        return [f"{key} IS NULL OR {key} IS NOT NULL"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in pairwise(cuts)]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]
