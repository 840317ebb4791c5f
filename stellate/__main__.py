"""Command line: build and publish the mart as one Spark job.

    python -m stellate build --out /shared/mart \\
        --raw customers=/data/customers.parquet --raw orders=/data/orders.parquet ...
    python -m stellate build --out /shared/mart --driver-root /root/testdata/sf0.1

Under spark-submit the master and resources come from the launcher; ``--master``
is for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys

from stellate.plans.build import CalendarWindow, build_mart
from stellate.session import get_session, size_shuffle_partitions
from stellate.sources.marketplace import RAW_TABLES, Marketplace


def _parse_raw(items: list[str]) -> dict[str, str]:
    paths = {}
    for item in items:
        name, sep, path = item.partition("=")
        if not sep or name not in RAW_TABLES:
            raise SystemExit(f"--raw expects <table>=<path> with table in {', '.join(RAW_TABLES)}: {item!r}")
        paths[name] = path
    return paths


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stellate")
    sub = parser.add_subparsers(dest="command", required=True)
    build = sub.add_parser("build", help="build dims, calendar and fact; write them and create views")
    build.add_argument("--out", required=True, help="root folder of the published tables (shared storage)")
    src = build.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", action="append", default=[], help="<table>=<parquet path>, repeatable")
    src.add_argument("--driver-root", help="folder with the TPC-H style test tables")
    build.add_argument("--format", default="parquet", help="output data source (parquet, delta, ...)")
    build.add_argument("--months-ahead", type=int, default=60)
    build.add_argument("--version", default=None, help="run id: write to <table>/_v=<id> (default: a new id), committed at the end")
    build.add_argument("--view", action="append", default=[],
                       help="<table>=<view name> to rename a published view, repeatable")
    build.add_argument("--database", default=None,
                       help="create persistent views in this database (created if missing)")
    build.add_argument("--partition", action="append", default=[],
                       help="<table>=<col>[,<col>...] to write a table partitioned, repeatable")
    build.add_argument("--calendar", default=None, metavar="FIRST:LAST",
                       help="publish the calendar days between two keys (yyyyMMdd), e.g. 20160101:20191231")
    build.add_argument("--calendar-start", default="2016-01-01", help="first day of that calendar")
    build.add_argument("--as-of", default=None, help="date its rolling flags refer to (default: today)")
    build.add_argument("--load-ts", default=None, help="its load date (default: now)")
    build.add_argument("--key-root", default=None, help="folder where surrogate keys are kept over runs (default: numbered anew)")
    build.add_argument("--master", default=None)
    build.add_argument("--shuffle-partitions", type=int, default=None,
                       help="fixed shuffle partition count; by default sized from the input bytes")
    args = parser.parse_args(argv)

    spark = get_session(args.master, app_name="stellate-build", shuffle_partitions=args.shuffle_partitions)
    if args.driver_root:
        mp = Marketplace.from_driver(spark, args.driver_root)
    else:
        mp = Marketplace.from_raw(spark, _parse_raw(args.raw))
    if args.shuffle_partitions is None:
        # size the shuffles from the fact's inputs, unless the launcher did
        size_shuffle_partitions(spark, [mp.order_payments, mp.orders, mp.customers])
    views = dict(v.split("=", 1) for v in args.view)
    parts = {t: c.split(",") for t, c in (p.split("=", 1) for p in args.partition)}
    if args.database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
        spark.catalog.setCurrentDatabase(args.database)
    calendar = None
    if args.calendar:
        first, last = map(int, args.calendar.split(":"))
        calendar = CalendarWindow(args.calendar_start, first, last, args.as_of, args.load_ts)
    published = build_mart(spark, mp, args.out, fmt=args.format, months_ahead=args.months_ahead,
                           version=args.version, view_names=views, temp_views=not args.database,
                           partition_by=parts, calendar=calendar, key_root=args.key_root)
    print(json.dumps({"paths": published.paths, "views": published.views}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
