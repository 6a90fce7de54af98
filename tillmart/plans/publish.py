"""Writing the star tables and the marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tillmart.plans.integrity import violations
from tillmart.plans.reports import REPORTS, Marts, Report
from tillmart.plans.star import key_map
from tillmart.schema import EXTRA_TABLES, TABLES, conform
from tillmart.sources.swap import staged
from tillmart.sources.tables import Target
from tillmart.sources.versions import Superseded

MANIFEST = "showcase string, table_name string, rows bigint, status string, error string"
WRITTEN = "written"
FAILED = "failed"


def publish(marts: Marts, target: Target, reports: Iterable[Report] | None = None, at_once: int = 8) -> DataFrame:
    """Write every report and return the manifest: one row per report.

    A report that fails is recorded and does not stop the others; see :func:`failures`.
    """
    spark = marts.fact.sparkSession

    def write(report: Report) -> tuple:
        try:
            rows = target.write(report.build(marts), report.table)
            return report.showcase, report.table, rows, WRITTEN, None
        except Exception as error:  # noqa: BLE001  (reported in the manifest)
            return report.showcase, report.table, None, FAILED, str(error)

    with ThreadPoolExecutor(at_once) as pool:
        outcome = list(pool.map(inheritable_thread_target(spark)(write), reports or REPORTS.values()))
    return spark.createDataFrame(outcome, MANIFEST)


def failures(manifest: DataFrame) -> list[str]:
    """Names of the reports that were not written."""
    return [r["table_name"] for r in manifest.where(manifest["status"] == FAILED).collect()]


class BrokenStar(ValueError):
    """A staged star whose keys are repeated or refer to nothing."""


FAIL, REPLACE = "fail", "replace"


def store_star(
    tables: dict[str, DataFrame], target: Target, at_once: int = 4, check: bool = False, superseded: str = REPLACE, started: int | None = None
) -> dict[str, int]:
    """Replace the star tables; returns the rows written to each. May be repeated.

    All tables go to a new version under a lease, with ``check`` their keys are tested there, and then one
    commit makes the version the current one: a load that fails leaves the star as it was. If another
    load published a version since this one began (since version ``started``, if given), ``superseded`` decides:
    ``replace`` publishes on top of it, as a full reload depends on no earlier version, ``fail`` raises
    :class:`Superseded` and leaves the other's star. Tables in a database have no versions: with
    ``target.swap`` all of them are written beside the old ones and swapped at the end, otherwise they
    are replaced one by one, and a failed load can leave a mixed star; load again.
    """
    spark = tables["fact_sales"].sparkSession
    versions = target.versions(spark)
    if versions is None:
        return _swapped(tables, target, at_once, check) if target.swap else _stored(tables, target, at_once, check)
    started = versions.number() if started is None else started
    name = versions.stage()
    try:
        with versions.leased(name):
            written = _stored(tables, target.version(name), at_once, check)
            while True:
                try:
                    versions.commit(name, started)
                    break
                except Superseded:
                    if superseded == FAIL:
                        raise
                    started = versions.number()
    except BaseException:
        versions.discard(name)
        raise
    versions.clean()
    return written


def _stored(tables: dict[str, DataFrame], target: Target, at_once: int, check: bool) -> dict[str, int]:
    written = _each(tables, at_once, lambda name: target.write(_stored_form(tables[name], name), name))
    if check:
        _check({name: target.read(tables[name].sparkSession, name) for name in TABLES})
    return written


def _swapped(tables: dict[str, DataFrame], target: Target, at_once: int, check: bool) -> dict[str, int]:
    spark = tables["fact_sales"].sparkSession
    with staged(target, spark) as fresh:
        written = _each(tables, at_once, lambda name: fresh.write(_stored_form(tables[name], name), name, target.write_as))
        if check:
            _check({name: target.read(spark, name, stored_as=fresh.written[name]) for name in TABLES})
        fresh.publish()
    return written


def _stored_form(df: DataFrame, name: str) -> DataFrame:
    """Tables of the model get its columns and types, key maps stay as they are."""
    return conform(df, name) if name in TABLES or name in EXTRA_TABLES else df


def _each(tables: dict[str, DataFrame], at_once: int, write: Callable[[str], int]) -> dict[str, int]:
    spark = tables["fact_sales"].sparkSession
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(tables, pool.map(inheritable_thread_target(spark)(write), tables)))


def _check(tables: dict[str, DataFrame]) -> None:
    bad = violations(tables)
    if bad:
        raise BrokenStar(f"{bad} keys are repeated or refer to nothing")


def load_star(
    spark: SparkSession, target: Target, partitions: int | None = None, names: Iterable[str] = tuple(TABLES)
) -> dict[str, DataFrame]:
    """Star tables of a target, all of one version."""
    current = target.current(spark)
    return {name: current.read(spark, name, partitions) for name in names}


def load_keys(spark: SparkSession, target: Target, names: Iterable[str]) -> dict[str, DataFrame]:
    """Members of the target's current version by dimension, if it was stored with key maps; else none."""
    name = target.versions(spark).current() if not target.is_jdbc else None
    if name is None:
        return {}
    stored = target.version(name)
    found = [n for n in names if target.versions(spark).holds(name, f"{target.prefix}{key_map(n)}")]
    return {n: stored.read(spark, key_map(n)) for n in found}
