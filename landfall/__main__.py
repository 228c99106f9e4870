"""Command line for the scheduled tasks and the control/log listing.

    spark-submit --py-files landfall.zip landfall_job.py init
    spark-submit --py-files landfall.zip landfall_job.py land --run-date 2024-06-02 --url … --user U --password-env VAR
    spark-submit --py-files landfall.zip landfall_job.py stage --run-date 2024-06-02
    python -m landfall list-log --page 0 --page-length 20
    python -m landfall deactivate Sales Store

The session is the one the job is submitted with (its checkpoint and
warehouse folders are used as they are). Listing prints one JSON object per
row of the page, then the page information.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from .domains import sales
from .functions import split_list
from .plans import (activate, control_table_name, deactivate, init, land, list_control, list_log,
                    log_table_name, stage)
from .session import ensure_checkpoint_dir
from .sources import JdbcConnection, Zones


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="landfall")
    p.add_argument("--ctr", default="ctr", help="control zone prefix")
    p.add_argument("--raw", default="raw", help="raw zone prefix")
    p.add_argument("--stg", default="stg", help="staging zone prefix")
    p.add_argument("--root", default=None, help="root folder for table snapshots")
    p.add_argument("--retain", type=int, default=None,
                   help="snapshot folders to keep per table after a merge (default: all)")
    sub = p.add_subparsers(dest="task", required=True)
    sub.add_parser("init")
    la = sub.add_parser("land")
    la.add_argument("--run-date", required=True)
    la.add_argument("--url", required=True)
    la.add_argument("--user")
    la.add_argument("--password-env", help="name of the variable holding the password")
    la.add_argument("--driver")
    la.add_argument("--parallel", type=int)
    la.add_argument("--split-by-key", action="store_true",
                    help="read integer-keyed tables in ranges of the key instead of the partition column")
    la.add_argument("--even-ranges", action="store_true",
                    help="read ranges of equal numbers of rows instead of equal width")
    la.add_argument("--no-key-check", action="store_true",
                    help="skip the batch key-uniqueness check (the source enforces the key)")
    st = sub.add_parser("stage")
    st.add_argument("--run-date", required=True)
    st.add_argument("--parallel", type=int)
    st.add_argument("--no-key-check", action="store_true",
                    help="skip the batch key-uniqueness check")
    for task in (la, st):
        task.add_argument("--partition-by", action="append", default=[], metavar="TABLE=COL[,COL]",
                          help="partition columns of a table when it is first loaded (repeatable)")
        task.add_argument("--range-rows", type=int, metavar="N",
                          help="lay tables without partition columns out in key ranges of about N rows when they are first loaded")
        task.add_argument("--stable-partitions", action="store_true",
                          help="a key's partition value never changes: skip the probe for moved rows")
    for name in ("list-control", "list-log"):
        ls = sub.add_parser(name)
        ls.add_argument("--page", type=int, default=0)
        ls.add_argument("--page-length", type=int, default=20)
        ls.add_argument("--select", help="comma list of columns to show")
    for name in ("activate", "deactivate"):
        a = sub.add_parser(name)
        a.add_argument("schema_name")
        a.add_argument("table_name")
    return p


def _layouts(items: list[str]) -> dict[str, list[str]]:
    """``["orders=year,month"]`` -> ``{"orders": ["year", "month"]}``."""
    out = {}
    for item in items:
        table, _, columns = item.partition("=")
        if not table or not columns:
            raise SystemExit(f"--partition-by wants TABLE=COL[,COL], not {item!r}")
        out[table.strip()] = split_list(columns)
    return out


def main(argv: list[str] | None = None) -> int:
    """Run one task with the session the job was submitted with."""
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"landfall-{args.task}").getOrCreate()
    ensure_checkpoint_dir(spark)
    zones = Zones(ctr=args.ctr, raw=args.raw, stg=args.stg)
    root = args.root
    if args.task == "init":
        made = init(spark, sales.seed_dicts(), zones=zones, root=root)
        print(json.dumps({"databases": made}))
    elif args.task == "land":
        password = os.environ.get(args.password_env) if args.password_env else None
        conn = JdbcConnection(args.url, args.user, password, args.driver)
        land(spark, spark.table(control_table_name(zones)), conn, args.run_date, zones=zones,
             root=root, log_table=log_table_name(zones), parallelism=args.parallel,
             retain_snapshots=args.retain, split_by_key=args.split_by_key, even_ranges=args.even_ranges,
             partition_by=_layouts(args.partition_by), stable_partitions=args.stable_partitions, range_rows=args.range_rows,
             check_unique=not args.no_key_check)
    elif args.task == "stage":
        stage(spark, spark.table(control_table_name(zones)), sales.ROUTES, args.run_date,
              zones=zones, root=root, log_table=log_table_name(zones),
              parallelism=args.parallel, retain_snapshots=args.retain,
              partition_by=_layouts(args.partition_by), stable_partitions=args.stable_partitions, range_rows=args.range_rows,
              check_unique=not args.no_key_check)
    elif args.task in ("list-control", "list-log"):
        lister = list_control if args.task == "list-control" else list_log
        select = args.select.replace(" ", "").split(",") if args.select else None
        rows, info = lister(spark, args.page, args.page_length, zones=zones, select=select)
        for r in rows.toLocalIterator():  # one page, streamed
            print(json.dumps(r.asDict(), default=str))
        print(json.dumps(info.first().asDict()))
    elif args.task in ("activate", "deactivate"):
        fn = activate if args.task == "activate" else deactivate
        fn(spark, args.schema_name, args.table_name, zones=zones, root=root)
        print("OK")
    return 0


if __name__ == "__main__":
    sys.exit(main())
