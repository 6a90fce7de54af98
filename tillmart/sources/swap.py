"""Replacing database tables at once: write beside, count, then swap.

Spark's JDBC writer commits partition by partition, so a task that runs again after its commit leaves rows
twice, and a load that stops half way leaves a mixed table. Here every table is written under a fresh name.
Rows are counted while they are written, where a task that ran twice counts once, and counted again in the
database; a fresh table with another number is dropped and written anew. Only when all tables are right does
one closing step give them their names: by one transaction, or by the database's own exchange of names.

Nothing here is sent to a database by the tests: statements are built as text, and run over a connection
that the caller may supply.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from dataclasses import dataclass, field
from threading import Lock
from typing import TYPE_CHECKING, Protocol

from pyspark.sql import DataFrame, SparkSession

if TYPE_CHECKING:
    from tillmart.sources.tables import Target

#: Times that a table is written before its wrong count is an error.
ATTEMPTS = 3


class MiscountedTable(RuntimeError):
    """A table that holds another number of rows than were written, each time it was written."""


class Connection(Protocol):
    def execute(self, statement: str) -> None: ...

    def number(self, query: str) -> int | None:
        """The only value of the query's only row; None for no row or NULL."""


def _bare(table: str) -> str:
    return table.rsplit(".", 1)[-1]


def _old(fresh: str) -> str:
    return f"{fresh}_old"


def _renamed_in_transaction(pairs: list[tuple[str, str]], existing: set[str]) -> list[str]:
    """Drop and rename within one transaction: readers see all old tables or all new ones."""
    out = ["BEGIN"]
    for fresh, table in pairs:
        out += [f"DROP TABLE {table}"] if table in existing else []
        out.append(f"ALTER TABLE {fresh} RENAME TO {_bare(table)}")
    return [*out, "COMMIT"]


def _renamed_together(pairs: list[tuple[str, str]], existing: set[str]) -> list[str]:
    """One RENAME TABLE that moves all names at once, then the old tables are dropped."""
    moves = []
    for fresh, table in pairs:
        moves += [f"{table} TO {_old(fresh)}"] if table in existing else []
        moves.append(f"{fresh} TO {table}")
    old = [f"DROP TABLE {_old(fresh)}" for fresh, table in pairs if table in existing]
    return [f"RENAME TABLE {', '.join(moves)}", *old]


def _exchanged(pairs: list[tuple[str, str]], existing: set[str]) -> list[str]:
    """An atomic exchange of names per table, one RENAME for tables that are new; then the old ones, now
    under the fresh names, are dropped."""
    swapped = [f"EXCHANGE TABLES {fresh} AND {table}" for fresh, table in pairs if table in existing]
    new = [f"{fresh} TO {table}" for fresh, table in pairs if table not in existing]
    old = [f"DROP TABLE {fresh}" for fresh, table in pairs if table in existing]
    return [*swapped, *([f"RENAME TABLE {', '.join(new)}"] if new else []), *old]


#: Per kind of database, as its JDBC URL names it, the statements that give fresh tables their names.
SWAPS: dict[str, Callable[[list[tuple[str, str]], set[str]], list[str]]] = {
    "postgresql": _renamed_in_transaction,
    "mysql": _renamed_together,
    "mariadb": _renamed_together,
    "clickhouse": _exchanged,
}


def kind_of(url: str) -> str:
    """The database's kind: the word after ``jdbc:``, without a pool's or bridge's prefix."""
    words = url.split(":")
    known = [w for w in words[1:3] if w in SWAPS]
    if words[0] != "jdbc" or not known:
        raise ValueError(f"don't know how tables are swapped in {':'.join(words[:2])}; known are {', '.join(SWAPS)}")
    return known[0]


def swap_statements(url: str, pairs: list[tuple[str, str]], existing: Iterable[str]) -> list[str]:
    """Statements that make each fresh table of ``pairs`` (fresh, table) the table."""
    return SWAPS[kind_of(url)](pairs, set(existing)) if pairs else []


class DriverConnection:
    """A connection by the driver that Spark's JDBC options name, in the Spark driver's process."""

    def __init__(self, spark: SparkSession, url: str, options: dict[str, str]):
        jvm = spark._jvm
        if "driver" in options:
            jvm.java.lang.Class.forName(options["driver"], True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
        properties = jvm.java.util.Properties()
        for name, value in options.items():
            properties.setProperty(name, value)
        self._connection = jvm.java.sql.DriverManager.getConnection(url, properties)
        self._turn = Lock()  # tables are written by several threads

    def execute(self, statement: str) -> None:
        with self._turn:
            self._connection.createStatement().execute(statement)

    def number(self, query: str) -> int | None:
        with self._turn:
            rows = self._connection.createStatement().executeQuery(query)
            return rows.getLong(1) if rows.next() and rows.getObject(1) is not None else None

    def close(self) -> None:
        self._connection.close()


@dataclass
class StagedTables:
    """Tables written beside those of ``target`` until :meth:`publish` swaps them all."""

    target: Target
    connection: Connection
    mark: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    written: dict[str, str] = field(default_factory=dict)  # table: fresh name

    def fresh(self, table: str, attempt: int) -> str:
        return f"{self.target.prefix}{table}__{self.mark}_{attempt}"

    def write(self, df: DataFrame, table: str, write: Callable[[DataFrame, str, str], int]) -> int:
        """Write ``df`` under a fresh name and return its rows; ``write(df, table, name)`` writes and counts."""
        for attempt in range(1, ATTEMPTS + 1):
            name = self.fresh(table, attempt)
            rows = write(df, table, name)
            found = self.connection.number(f"SELECT COUNT(*) FROM {name}")
            if found == rows:
                self.written[table] = name
                return rows
            self.connection.execute(f"DROP TABLE {name}")
        raise MiscountedTable(f"{rows} rows were written to {table}, {found} were found, {ATTEMPTS} times")

    def _exists(self, table: str) -> bool:
        try:
            self.connection.number(f"SELECT COUNT(*) FROM {table} WHERE 1 = 0")
        except Exception:  # noqa: BLE001  (databases tell a missing table each in its own way)
            return False
        return True

    def publish(self) -> None:
        """Swap all written tables."""
        pairs = [(fresh, f"{self.target.prefix}{table}") for table, fresh in self.written.items()]
        existing = [table for _, table in pairs if self._exists(table)]
        done: list[str] = []
        try:
            for statement in swap_statements(self.target.location, pairs, existing):
                self.connection.execute(statement)
                done.append(statement)
        except Exception:
            if done[:1] == ["BEGIN"]:
                self.connection.execute("ROLLBACK")
            raise
        self.written.clear()

    def discard(self) -> None:
        """Drop what was written and not published."""
        for fresh in self.written.values():
            self.connection.execute(f"DROP TABLE {fresh}")
        self.written.clear()


@contextmanager
def staged(target: Target, spark: SparkSession, connection: Connection | None = None):
    """Staged tables of ``target`` that are dropped if the body fails; a connection is opened if none is given."""
    own = DriverConnection(spark, target.location, target.options) if connection is None else None
    tables = StagedTables(target, connection or own)
    try:
        yield tables
    except BaseException:
        tables.discard()
        raise
    finally:
        if own:
            own.close()
