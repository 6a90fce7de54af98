"""Report job: the star tables become the nineteen marts.

    spark-submit tillmart/jobs/publish_marts.py --star /data/star --marts /data/marts
    spark-submit … --marts jdbc:clickhouse://host:8123/default --marts-format jdbc \\
        --marts-option "createTableOptions=ENGINE = MergeTree() ORDER BY tuple()"
"""

from __future__ import annotations

import argparse
import sys
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target

from tillmart.jobs.options import add_target, session, size_partitions, target
from tillmart.plans.publish import failures, load_star, publish
from tillmart.plans.reports import ADDITIONS, REPORTS, Marts, tables_needed
from tillmart.schema import DIMENSIONS
from tillmart.workspace import Workspace


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--only", nargs="*", choices=[*REPORTS, *ADDITIONS], help="publish these marts only; additions are published only if named here")
    p.add_argument("--ordered", action="store_true", help="sort uncut marts before they are written")
    p.add_argument("--read-partitions", type=int, help="parallel JDBC reads per star table")
    p.add_argument("--input-bytes", type=int, help="size of the star; sizes the shuffle partitions")
    add_target(p, "star", "where the star tables are")
    add_target(p, "marts", "where the marts go")
    return p


def main(arguments: list[str] | None = None) -> int:
    """Returns the number of marts that failed."""
    options = parser().parse_args(arguments)
    spark = session("publish marts")
    source = target(options, "star")
    size_partitions(spark, None if source.is_jdbc else source.current(spark).location, options.input_bytes)
    workspace = Workspace(spark)
    known = {**REPORTS, **ADDITIONS}
    chosen = [known[name] for name in options.only or REPORTS]
    try:
        star = load_star(spark, source, options.read_partitions, tables_needed(chosen))
        if source.is_jdbc:  # copied once: all marts then read columnar files, not the database
            copy = inheritable_thread_target(spark)(lambda item: (item[0], workspace.store(*item)))
            with ThreadPoolExecutor(len(star)) as pool:
                star = dict(pool.map(copy, star.items()))
        dims = {name: star[d.table] for name, d in DIMENSIONS.items() if d.table in star}
        marts = Marts(star["fact_sales"], dims, workspace, options.ordered)
        manifest = publish(marts, target(options, "marts"), chosen)
        manifest.show(len(chosen), truncate=False)
        return len(failures(manifest))
    finally:
        workspace.discard()


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
