"""Incremental runs: load one UTC day, or a list of days, into tables that grow."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse import schemas
from forgepulse.config import SELECTED_REPOS, Tables
from forgepulse.operators import checks, marts
from forgepulse.operators.staging import select_repos, stage_events_by_day, staging_columns
from forgepulse.session import prepare, sized_shuffles
from forgepulse.sinks import loads
from forgepulse.sources.lake import lake_day_dir, scan_days

DAILY_MARTS = {
    "mart_repo_daily_activity": (
        marts.daily_activity, schemas.DAILY_ACTIVITY, marts.DAILY_KEYS, ["repo_name"],
    ),
    "mart_repo_daily_event_type_activity": (
        marts.daily_event_type_activity, schemas.DAILY_EVENT_TYPE_ACTIVITY,
        marts.DAILY_TYPE_KEYS, ["repo_name", "event_type"],
    ),
}

REBUILT_MARTS = {
    "mart_repo_actor_activity": marts.actor_activity_of,
    "mart_repo_summary": marts.repo_summary_of,
}


def create_tables(spark: SparkSession, tables: Tables) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {tables.database}")
    for name in ("stg_events", "stg_selected_events"):
        loads.create_if_absent(spark, tables[name], schemas.STAGING)
    loads.create_if_absent(spark, tables["activity_state"], schemas.ACTIVITY_STATE)
    for name, (_, columns, _, _) in DAILY_MARTS.items():
        loads.create_if_absent(spark, tables[name], columns)


def _check_days(spark: SparkSession, tables: Tables, name: str, days: Sequence[date]) -> None:
    if not days:
        return
    results = checks.run_checks_by_day(
        spark.table(tables[name]), checks.DAY_CHECKS[name], days
    )
    checks.require(results, name)


def lake_bytes(spark: SparkSession, lake_root: str, days: Sequence[date]) -> int:
    """Size of some days in the lake, from a listing of their files."""
    glob = ",".join(lake_day_dir(d) for d in days)
    files = spark.read.format("binaryFile").load(f"{lake_root.rstrip('/')}/{{{glob}}}")
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def lake_events(spark: SparkSession, lake_root: str, days: Sequence[date]) -> DataFrame:
    """The events of the given days' directories, with the day as a column.

    Of each directory only the events of its own day are taken, so that it does not
    matter which days are loaded together.
    """
    return (
        scan_days(spark, lake_root, days)
        .withColumn(loads.DAY, F.make_date("year", "month", "day"))
        .where(F.to_date("created_at") == F.col(loads.DAY))
        .drop("year", "month", "day")
    )


def load_raw_days(
    spark: SparkSession, lake_root: str, tables: Tables, days: Sequence[date],
    allow_empty: bool = False,
) -> list[date]:
    """Copy days from the lake to the raw table; returns the days that had events."""
    events = lake_events(spark, lake_root, days)
    loads.create_like(events, tables["raw_events"])
    return loads.replace_days(events, tables["raw_events"], days, None, allow_empty, grow=True)


def run_days(
    spark: SparkSession,
    lake_root: str,
    tables: Tables,
    days: Sequence[date],
    repos: Sequence[str] | DataFrame = SELECTED_REPOS,
    allow_empty: bool = False,
    marts_keep_stale: bool = True,
) -> None:
    """Load days from the lake into every table; running it again changes nothing.

    A backfill of many days is one set of jobs, not one per day: days are replaced
    together and every step keeps them apart. `marts_keep_stale=False` replaces the
    days of the daily marts instead of merging into them, so groups that are gone
    from a reloaded day go too. Days without events, unless allowed, are left as they
    were and reported by an error after the others have gone through every table.
    """
    prepare(spark)
    days = sorted(set(days))
    create_tables(spark, tables)
    with sized_shuffles(spark, lake_bytes(spark, lake_root, days)):
        empty = None
        try:
            filled = load_raw_days(spark, lake_root, tables, days, allow_empty)
        except loads.EmptyDay as error:
            empty, filled = error, error.loaded
            days = filled
        if days:
            load_from_raw(spark, tables, days, filled, repos, allow_empty, marts_keep_stale)
        if empty is not None:
            raise empty


def load_state(spark: SparkSession, tables: Tables, days: Sequence[date]) -> None:
    """Bring the state of some days up to date, and of any earlier ones it has not got.

    The marts over all days come from the state, so a load reads the selected events of
    its own days only, and of the history a row per day, repository, actor and type.
    """
    known = set(loads.partition_days(spark, tables["activity_state"]))
    stored = loads.partition_days(spark, tables["stg_selected_events"])
    due = sorted({*days, *(d for d in stored if d is not None and d not in known)})
    selected = spark.table(tables["stg_selected_events"]).where(F.col(loads.DAY).isin(due))
    loads.replace_days(
        marts.activity_state(selected), tables["activity_state"], due, ["repo_name"], allow_empty=True
    )


def load_from_raw(
    spark: SparkSession,
    tables: Tables,
    days: Sequence[date],
    filled: Sequence[date],
    repos: Sequence[str] | DataFrame,
    allow_empty: bool,
    marts_keep_stale: bool,
) -> None:
    """Every table after the raw one, for days of which `filled` have events."""
    loaded = F.col(loads.DAY).isin(list(days))

    staged = staging_columns(stage_events_by_day(spark.table(tables["raw_events"]).where(loaded)))
    loads.replace_days(staged, tables["stg_events"], days, ["repo_name"], allow_empty)
    _check_days(spark, tables, "stg_events", filled)

    # A day may hold no listed repository; its check, not its load, decides on that.
    selected = select_repos(spark.table(tables["stg_events"]).where(loaded), repos)
    loads.replace_days(
        selected, tables["stg_selected_events"], days, ["repo_name"], allow_empty=True
    )
    _check_days(spark, tables, "stg_selected_events", filled)

    selected = spark.table(tables["stg_selected_events"])
    for name, (build, _, keys, cluster_by) in DAILY_MARTS.items():
        new = build(selected.where(loaded))
        if marts_keep_stale:
            loads.upsert_days(new, tables[name], keys, days, cluster_by)
        else:
            loads.replace_days(new, tables[name], days, cluster_by, allow_empty=True)
        _check_days(spark, tables, name, filled)

    load_state(spark, tables, days)
    state = spark.table(tables["activity_state"])
    for name, build in REBUILT_MARTS.items():
        loads.full_rebuild(build(state), tables[name])
        rebuilt = spark.table(tables[name])
        checks.require(checks.run_checks(rebuilt, checks.REBUILD_CHECKS[name]), name)
