"""Load job: a folder of wide CSV files becomes the seven star tables.

    spark-submit tillmart/jobs/load_star.py --feed /data/feed --star /data/star
    spark-submit … --star jdbc:postgresql://host/db --star-format jdbc --star-prefix star_schema. \\
        --star-option driver=org.postgresql.Driver --star-option user=…
"""

from __future__ import annotations

import argparse
import sys

from tillmart.jobs.options import add_target, session, size_partitions, target
from tillmart.operators.lookup import BUSINESS_KEY, LOOKUPS
from tillmart.plans.ingest import Ingest
from tillmart.plans.publish import FAIL, REPLACE, BrokenStar, load_keys, store_star
from tillmart.plans.star import StarPlan
from tillmart.schema import CUSTOMER_GRAINS, DIMENSIONS
from tillmart.sources.csv_feed import SOURCE_FILE, scan_csv_folder
from tillmart.sources.versions import Superseded
from tillmart.workspace import Workspace


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--feed", required=True, help="folder of CSV files with a header line")
    p.add_argument("--mixed", action="store_true", help="files may differ in column order or lack columns")
    p.add_argument("--infer", action="store_true", help="let Spark guess the column types")
    p.add_argument("--lookup", choices=LOOKUPS, default=BUSINESS_KEY)
    p.add_argument("--grain", choices=list(CUSTOMER_GRAINS), default="sale", help="what one customer is")
    p.add_argument("--sale-id", action="store_true", help="also store the fact with a dense sale_id, as fact_sale_id")
    p.add_argument("--input-bytes", type=int, help="size of the feed, if not that of its files; sizes the shuffles")
    p.add_argument("--check", action="store_true", help="publish the tables only if their keys are right")
    p.add_argument("--rejects", metavar="FOLDER", help="where values that don't fit are told (default: STAR_rejects)")
    p.add_argument("--accept-rejects", action="store_true", help="end with 0 although values didn't fit")
    p.add_argument("--keep-keys", action="store_true", help="members of the star's current version keep their keys; implies --superseded fail")
    p.add_argument("--superseded", choices=[REPLACE, FAIL], default=REPLACE, help="if another load published meanwhile")
    add_target(p, "star", "where the star tables go")
    return p


def main(arguments: list[str] | None = None) -> int:
    """0 if all went well; 1 if the keys are wrong (then the old star stays); 2 if values were rejected
    and that was not accepted (the star is loaded); 3 if another load published first and this one was
    to fail then. Rejects are stored whatever becomes of the star."""
    options = parser().parse_args(arguments)
    spark = session("load star schema")
    size_partitions(spark, options.feed, options.input_bytes)
    scan = scan_csv_folder(
        spark, options.feed, mixed=options.mixed, infer=options.infer, source_file=True, rejects=True
    )
    workspace = Workspace(spark)
    goal = target(options, "star")
    if options.keep_keys and goal.is_jdbc:
        raise SystemExit("--keep-keys needs a star in files: its versions hold the key maps")
    versions = goal.versions(spark)
    started = versions.number() if versions else None
    place = options.rejects or f"{workspace.location if goal.is_jdbc else goal.location}_rejects"
    try:
        ingest = Ingest(scan)
        known = load_keys(spark, goal, DIMENSIONS) if options.keep_keys else {}
        star = StarPlan(ingest.rows, workspace, [SOURCE_FILE], options.lookup, options.grain, known)
        tables = star.tables(write_fact=options.sale_id)
        if options.keep_keys:
            tables |= star.key_maps()
        if options.sale_id:
            tables["fact_sale_id"] = star.fact_with_sale_id.drop("id")
        if ingest.rejected:  # stored before the star: they may be why its keys are wrong
            print(f"{ingest.store_rejects(place)} values did not fit, see {place}")
        written = store_star(tables, goal, check=options.check, superseded=FAIL if options.keep_keys else options.superseded, started=started)
        print(f"loaded: {ingest.loaded} rows, clean: {workspace.rows['clean_sales']} rows")
        for table, rows in written.items():
            print(f"{table}: {rows} rows")
        return 2 if ingest.rejected and not options.accept_rejects else 0
    except BrokenStar as broken:
        print(broken)
        return 1
    except Superseded as other:
        print(other)
        return 3
    finally:
        workspace.discard()


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
