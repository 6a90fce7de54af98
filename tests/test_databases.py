"""What is sent to databases, as text: ranges of keys, and the statements that swap tables."""

import random

import duckdb
import pytest

from tillmart.jobs import load_star as load_job
from tillmart.jobs.options import target as target_of
from tillmart.sources import ranges, swap
from tillmart.sources.swap import MiscountedTable, StagedTables, kind_of, swap_statements
from tillmart.sources.tables import Target

KEYS = {
    "dense": list(range(1, 5001)),
    "gaps": [*range(1, 1000), *range(10**12, 10**12 + 1000)],
    "one crowd": [*range(1, 3000), *[777] * 6000],
    "crowded end": [2**62] * 50 + list(range(-2000, 0)),
    "few": [5, 5, 9],
    "one": [42],
    "with nulls": [None] * 500 + list(range(0, 9000, 3)),
    "skewed": [int(1.02**k) for k in range(2000)],
}


def store(keys):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (k BIGINT)")
    if keys:
        connection.execute("INSERT INTO t SELECT unnest(?)", [keys])
    return connection


@pytest.mark.parametrize("name", list(KEYS))
@pytest.mark.parametrize("tasks", [1, 4, 16])
def test_ranges_cover_every_key_once_and_evenly(name, tasks):
    keys = [min(k, 2**63 - 1) if k is not None else None for k in KEYS[name]]
    connection = store(keys)
    asked = []

    def ask(query):
        asked.append(query)
        return connection.execute(query).fetchall()

    low, high = ask(ranges.ends_query("t", "k"))[0]
    cuts = ranges.bounds(ranges.histogram(ask, "t", "k", low, high, tasks), tasks)
    predicates = ranges.range_predicates("k", cuts)
    assert 1 <= len(predicates) <= tasks and cuts == sorted(set(cuts))
    total = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates)
    assert connection.execute(f"SELECT min({total}), max({total}) FROM t").fetchone() == (1, 1)
    known = [k for k in keys if k is not None]
    most = max(known.count(k) for k in {known[len(known) // 2], 777, 2**62, 5} if k in known)
    sizes = [connection.execute(f"SELECT count(k) FROM t WHERE {p}").fetchone()[0] for p in predicates]
    assert max(sizes) <= 2 * len(known) / tasks + most + 1
    assert len(asked) < 120


def test_a_table_without_keys_is_one_range():
    assert store([]).execute(ranges.ends_query("t", "k")).fetchone() == (None, None)
    assert ranges.bounds([], 8) == []
    (only,) = ranges.range_predicates("k", [])
    assert store([None, 3]).execute(f"SELECT count(*) FROM t WHERE {only}").fetchone() == (2,)


def test_histograms_are_asked_for_by_interval():
    assert ranges.histogram_query("s.t", "k", 1, 10, 5) == (
        "SELECT FLOOR((k - 1) / 2) AS place, COUNT(*) AS n FROM s.t WHERE k >= 1 AND k <= 10 GROUP BY FLOOR((k - 1) / 2)"
    )
    assert ranges.histogram_query("t", "k", 1, 4, 5).startswith("SELECT k - 1 AS place")


class Fake:
    """A database that counts as it is told and notes what it is sent."""

    def __init__(self, counts=(), missing=(), failing=""):
        self.counts, self.missing, self.failing, self.sent = list(counts), missing, failing, []

    def execute(self, statement):
        self.sent.append(statement)
        if self.failing and self.failing in statement:
            raise RuntimeError("no")

    def number(self, query):
        if any(query.startswith(f"SELECT COUNT(*) FROM {t} ") for t in self.missing):
            raise RuntimeError("no such table")
        return self.counts.pop(0) if "1 = 0" not in query else 0


PAIRS = [("s.a__1", "s.a"), ("s.b__1", "s.b")]


def test_swaps_by_kind_of_database():
    assert swap_statements("jdbc:postgresql://h/d", PAIRS, ["s.a"]) == [
        "BEGIN", "DROP TABLE s.a", "ALTER TABLE s.a__1 RENAME TO a", "ALTER TABLE s.b__1 RENAME TO b", "COMMIT",
    ]
    assert swap_statements("jdbc:mysql://h/d", PAIRS, ["s.a"]) == [
        "RENAME TABLE s.a TO s.a__1_old, s.a__1 TO s.a, s.b__1 TO s.b", "DROP TABLE s.a__1_old",
    ]
    assert swap_statements("jdbc:ch:clickhouse://h/d", PAIRS, ["s.a"]) == [
        "EXCHANGE TABLES s.a__1 AND s.a", "RENAME TABLE s.b__1 TO s.b", "DROP TABLE s.a__1",
    ]
    assert swap_statements("jdbc:mariadb://h/d", [], []) == []
    assert kind_of("jdbc:clickhouse://h") == "clickhouse"
    for unknown in ("jdbc:other://h", "file:///x"):
        with pytest.raises(ValueError, match="don't know"):
            swap_statements(unknown, PAIRS, [])


def tables(fake, **more):
    return StagedTables(Target("jdbc:postgresql://h/d", "jdbc", prefix="s.", swap=True, **more), fake, "x")


def test_doubled_rows_are_written_anew(spark):
    fake, names = Fake(counts=[9, 7]), []
    fresh = tables(fake)
    assert fresh.write(spark.range(7), "a", lambda df, table, name: names.append((table, name)) or 7) == 7
    assert names == [("a", "s.a__x_1"), ("a", "s.a__x_2")] and fake.sent == ["DROP TABLE s.a__x_1"]
    fresh.publish()
    assert fake.sent[1:] == ["BEGIN", "DROP TABLE s.a", "ALTER TABLE s.a__x_2 RENAME TO a", "COMMIT"]
    assert fresh.written == {}


def test_a_table_that_is_never_right_fails(spark):
    fake = Fake(counts=[9, 9, 9])
    with pytest.raises(MiscountedTable, match="7 rows were written to a, 9 were found"):
        tables(fake).write(spark.range(7), "a", lambda *_: 7)
    assert len(fake.sent) == 3


def test_a_failed_swap_is_rolled_back_and_cleaned(spark):
    fake = Fake(counts=[7, 7], missing=["s.b"], failing="RENAME TO b")
    target = Target("jdbc:postgresql://h/d", "jdbc", prefix="s.", swap=True)
    with pytest.raises(RuntimeError), swap.staged(target, spark, fake) as fresh:
        for name in "ab":
            fresh.write(spark.range(7), name, lambda *_: 7)
        fresh.publish()
    mark = fresh.mark
    assert fake.sent == [
        "BEGIN", "DROP TABLE s.a", f"ALTER TABLE s.a__{mark}_1 RENAME TO a", f"ALTER TABLE s.b__{mark}_1 RENAME TO b", "ROLLBACK",
        f"DROP TABLE s.a__{mark}_1", f"DROP TABLE s.b__{mark}_1",
    ]


def test_swap_is_an_option():
    options = load_job.parser().parse_args(["--feed", "f", "--star", "jdbc:postgresql://h/d", "--star-format", "jdbc", "--star-swap"])
    assert target_of(options, "star") == Target("jdbc:postgresql://h/d", "jdbc", {}, "", True)
    assert not Target("jdbc:x", "jdbc").swap
