"""Window runs: rebuild every table from the hourly files of a rolling window."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.config import HOURS_PER_DAY, MIN_FILE_BYTES, SELECTED_REPOS, DayRange, Tables
from forgepulse.functions.columns import base_name, file_day
from forgepulse.operators import checks, marts
from forgepulse.operators.staging import select_repos, stage_events
from forgepulse.session import prepare, sized_shuffles
from forgepulse.sinks import loads
from forgepulse.sources import landing
from forgepulse.sources.ndjson import SCANS, columns_of

log = logging.getLogger(__name__)

FILE_DAY = "file_date"

MARTS: dict[str, tuple[Callable[[DataFrame], DataFrame], str | None, Sequence[str]]] = {
    "mart_repo_daily_activity": (marts.daily_activity, loads.DAY, ["repo_name"]),
    "mart_repo_daily_event_type_activity": (
        marts.daily_event_type_activity, loads.DAY, ["repo_name", "event_type"],
    ),
    "mart_repo_actor_activity": (marts.actor_activity, None, ()),
    "mart_repo_summary": (marts.repo_summary, None, ()),
}


def landed_in(spark: SparkSession, landing_dir: str, window: DayRange) -> DataFrame:
    """The landed files of the window's hours."""
    expected = landing.expected_files(spark, window.start, window.end)
    landed = landing.landed_files(spark, landing_dir, window.days)
    return landed.join(expected.select("filename"), "filename", "left_semi")


def audit_landing(landed: DataFrame, window: DayRange, min_bytes: int = MIN_FILE_BYTES) -> int:
    """Stop on unsound files, warn about missing hours, return the bytes of the window."""
    expected = landing.expected_files(landed.sparkSession, window.start, window.end)
    for line in landing.require_sound(landing.audit(expected, landed, min_bytes)):
        log.warning(line)
    return landed.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def audit_window(
    spark: SparkSession, landing_dir: str, window: DayRange, min_bytes: int = MIN_FILE_BYTES
) -> list[str]:
    """Judge the window's files, and only these: present, large enough, readable to the end.

    Raises on a small or damaged file or if nothing has landed; returns lines about
    hours that are missing, days that are not whole, and the number of events.
    """
    landed = landed_in(spark, landing_dir, window)
    expected = landing.expected_files(spark, window.start, window.end)
    lines = landing.require_sound(landing.audit(expected, landed, min_bytes))
    partial = landing.incomplete_days(expected, landed).orderBy("file_date").collect()  # a row per day
    lines += [f"{row.file_date}: {row.files} of {HOURS_PER_DAY} files" for row in partial]
    return [*lines, f"lines: {landing.require_readable(spark, landing_dir, window.days)}"]


def _checked(spark: SparkSession, tables: Tables, name: str) -> DataFrame:
    table = spark.table(tables[name])
    checks.require(checks.run_checks(table, checks.WINDOW_CHECKS[name]), name)
    return table


def changed_days(landed: DataFrame, raw: DataFrame) -> list[date]:
    """Days whose landed files are not the ones the raw table was loaded from.

    A file is the same if its name, size and time of change are. Reads the columns about
    files of the raw table only, and fetches the days.
    """
    name = base_name(F.col("filename")).alias("filename")
    loaded = raw.select(name, F.col("file_bytes").alias("length"), F.col("file_time").alias("time")).distinct()
    landed = landed.select("filename", "length", "time")
    new = landed.join(loaded, landed.columns, "left_anti")
    gone = loaded.join(landed, landed.columns, "left_anti")
    days = new.unionByName(gone).select(file_day(F.col("filename")).alias("day")).distinct()
    return sorted(row.day for row in days.collect() if row.day is not None)


def refresh_raw(
    spark: SparkSession, landing_dir: str, landed: DataFrame, table: str, window: DayRange,
    scan: str = "variant",
) -> None:
    """Bring the raw table to the landed files of the window.

    Days outside of it are dropped, and only days with new, changed or removed files are
    parsed again, so a daily run decompresses one day rather than the whole window. With
    an inferred schema, which the files of any day may change, all are, and so they are
    when the table was loaded by another scan.
    """
    scan_files = SCANS[scan]
    known = set(spark.table(table).columns) if spark.catalog.tableExists(table) else set()
    if known != columns_of(scan):
        raw = scan_files(spark, landing_dir, window.days)
        loads.full_rebuild(raw, table, FILE_DAY, cluster_by=None)
        return
    loads.retain_days(spark, table, window.start, window.end, FILE_DAY)
    for days in loads.month_parts(changed_days(landed, spark.table(table))):
        raw = scan_files(spark, landing_dir, days)
        loads.replace_days(raw, table, days, None, allow_empty=True, partition_by=FILE_DAY)


def load_landed(
    spark: SparkSession, landing_dir: str, table: str, window: DayRange,
    min_bytes: int = MIN_FILE_BYTES, scan: str = "variant",
) -> None:
    """Audit the window's files and bring the raw table to them."""
    landed = landed_in(spark, landing_dir, window)
    with sized_shuffles(spark, audit_landing(landed, window, min_bytes)):
        refresh_raw(spark, landing_dir, landed, table, window, scan)


def run_window(
    spark: SparkSession,
    landing_dir: str,
    tables: Tables,
    window: DayRange,
    repos: Sequence[str] | DataFrame = SELECTED_REPOS,
    min_bytes: int = MIN_FILE_BYTES,
    scan: str = "variant",
) -> None:
    """Land, stage, select and aggregate a window; stops at the first failed check.

    Each table is read back from where it was written, so a lost executor costs no
    more than the tables' own tasks, and the files are parsed once for all of them.
    `scan` names how the files are read: "variant" keeps every field, "inferred" finds
    the schema, and "fixed" keeps the few fields of a narrow one. A file that cannot be
    read to its end stops the run, and the raw rows of its day stay as they were.
    """
    prepare(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {tables.database}")
    landed = landed_in(spark, landing_dir, window)
    with sized_shuffles(spark, audit_landing(landed, window, min_bytes)):
        refresh_raw(spark, landing_dir, landed, tables["raw_events"], window, scan)
        raw = _checked(spark, tables, "raw_events")
        build_from_raw(spark, raw, tables, repos)


def build_from_raw(
    spark: SparkSession,
    raw: DataFrame,
    tables: Tables,
    repos: Sequence[str] | DataFrame = SELECTED_REPOS,
) -> None:
    """Everything after the raw table of a window run."""
    staged = stage_events(raw).withColumn(loads.DAY, F.to_date("created_at"))
    loads.full_rebuild(staged, tables["stg_events"], loads.DAY, ["repo_name"])
    staged = _checked(spark, tables, "stg_events")

    loads.full_rebuild(
        select_repos(staged, repos), tables["stg_selected_events"], loads.DAY, ["repo_name"]
    )
    selected = _checked(spark, tables, "stg_selected_events")

    for name, (build, partition_by, cluster_by) in MARTS.items():
        loads.full_rebuild(build(selected), tables[name], partition_by, cluster_by)
        _checked(spark, tables, name)
