"""Jobs for spark-submit: `window`, `days`, `export` and `audit`."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from forgepulse.config import (
    LOOKBACK_DAYS, MIN_FILE_BYTES, DayRange, Tables, parse_day, rolling_window, target_day,
)
from forgepulse.plans.incremental import run_days
from forgepulse.plans.window import audit_window, run_window
from forgepulse.session import prepare
from forgepulse.sinks.loads import export_days
from forgepulse.sources.lake import scan_source_day
from forgepulse.sources.ndjson import SCANS


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="forgepulse")
    jobs = parser.add_subparsers(dest="job", required=True)

    window = jobs.add_parser("window", help="rebuild all tables from a window of hourly files")
    window.add_argument("--database", required=True)
    window.add_argument("--scan", choices=sorted(SCANS), default="variant")

    audit = jobs.add_parser("audit", help="list missing and undersized hourly files")
    for job in (window, audit):
        job.add_argument("--landing", required=True)
        job.add_argument("--end-date")
        job.add_argument("--lookback-days", type=int, default=LOOKBACK_DAYS)
        job.add_argument("--min-bytes", type=int, default=MIN_FILE_BYTES)

    days = jobs.add_parser("days", help="load days from the lake into growing tables")
    days.add_argument("--lake", required=True)
    days.add_argument("--database", required=True)
    days.add_argument("--execution-date", help="load the day before; default: today (UTC)")
    days.add_argument("--start-date", help="first day of a backfill")
    days.add_argument("--end-date", help="last day of a backfill")
    days.add_argument("--allow-empty", action="store_true")
    days.add_argument("--replace-marts", action="store_true", help="drop stale groups of a day")

    export = jobs.add_parser("export", help="write one day of a per-day source to the lake")
    export.add_argument("--source", required=True, help="table name without its date")
    export.add_argument("--lake", required=True)
    export.add_argument("--execution-date")

    args = parser.parse_args(argv)
    if args.job == "days" and bool(args.start_date) != bool(args.end_date):
        parser.error("a backfill needs --start-date and --end-date")
    return args


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    logging.basicConfig(level=logging.INFO)
    spark = prepare(SparkSession.builder.appName(f"forgepulse-{args.job}").getOrCreate())

    if args.job == "window":
        window = rolling_window(args.end_date, args.lookback_days)
        run_window(
            spark, args.landing, Tables(args.database), window,
            min_bytes=args.min_bytes, scan=args.scan,
        )
    elif args.job == "audit":
        window = rolling_window(args.end_date, args.lookback_days)
        for line in audit_window(spark, args.landing, window, args.min_bytes):
            print(line)
    elif args.job == "days":
        if args.start_date:
            wanted = DayRange(parse_day(args.start_date), parse_day(args.end_date)).days
        else:
            wanted = [target_day(args.execution_date)]
        run_days(
            spark, args.lake, Tables(args.database), wanted,
            allow_empty=args.allow_empty, marts_keep_stale=not args.replace_marts,
        )
    else:
        day = target_day(args.execution_date)
        export_days(scan_source_day(spark, args.source, day), args.lake, [day])


if __name__ == "__main__":
    main()
