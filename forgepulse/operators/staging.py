"""From raw events to typed, unique, selected events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgepulse import schemas
from forgepulse.functions.columns import event_day

ALL_REPOS = "All repos"


def flatten_event(raw: DataFrame) -> DataFrame:
    """The typed leaves of a raw event; `filename` and day columns are kept if present."""
    kept = [c for c in ("filename", "event_date") if c in raw.columns]
    return raw.selectExpr(
        "id AS event_id",
        "type AS event_type",
        "actor.id AS actor_id",
        "actor.login AS actor_login",
        "repo.id AS repo_id",
        "repo.name AS repo_name",
        "created_at",
        "org.id AS org_id",
        "org.login AS org_login",
        *kept,
    )


def dedup_latest(
    events: DataFrame, key: str = "event_id", within: Sequence[str] = ()
) -> DataFrame:
    """Keep the latest copy of each key; `within` limits it to copies that share those columns.

    The newest time wins, then the last file name in text order. Copies still equal
    are told apart by their other columns, so reruns keep the same one.

    A rank limit of 1 lets Spark drop all but one copy per key in every map task
    before it shuffles, so a key with very many copies costs one row per task.
    """
    leading = [c for c in ("created_at", "filename") if c in events.columns]
    rest = [c for c in events.columns if c not in (key, *within, *leading)]
    copies = ", ".join([*within, key])
    newest = ", ".join(f"{c} DESC NULLS LAST" for c in leading + rest)
    rank = f"row_number() OVER (PARTITION BY {copies} ORDER BY {newest}) AS _rank"
    return events.selectExpr("*", rank).where("_rank = 1").drop("_rank")


def stage_events(
    raw: DataFrame, since: date | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Staging over the whole input.

    Flattening first keeps payloads out of the shuffle, and `columns` limits it to what
    is asked for besides the key and the columns that order copies. With `since`, only
    events of that day or later are returned, and older copies are left out before the
    shuffle: a key whose latest copy is older has no result, and any other key keeps
    its latest.
    """
    events = flatten_event(raw)
    if columns is not None:
        needed = {"event_id", "created_at", "filename", "event_date", *columns}
        events = events.select(*(c for c in events.columns if c in needed))
    if since is not None:
        events = events.where(event_day(events) >= F.lit(since))
    return dedup_latest(events)


def stage_events_by_day(raw: DataFrame) -> DataFrame:
    """Staging day by day: an id that occurs on two days is kept once on each."""
    events = flatten_event(raw)
    if "event_date" not in events.columns:
        events = events.withColumn("event_date", F.to_date("created_at"))
    return dedup_latest(events, within=["event_date"])


def staging_columns(events: DataFrame) -> DataFrame:
    """The columns of the incremental staging tables, which do not keep a file name."""
    return events.select(*T.StructType.fromDDL(schemas.STAGING).names, "event_date")


def select_repos(events: DataFrame, repos: Sequence[str] | DataFrame) -> DataFrame:
    """Events of the listed repositories, compared exactly.

    A list becomes an IN filter that reaches the scan. A one-column DataFrame is
    semi-joined, and Spark broadcasts it only if its size allows.
    """
    if isinstance(repos, DataFrame):
        (name,) = repos.columns
        return events.join(
            repos.select(F.col(name).alias("repo_name")), "repo_name", "left_semi"
        ).select(*events.columns)
    return events.where(F.col("repo_name").isin(list(repos)))


def on_day(events: DataFrame, day: date) -> DataFrame:
    return events.where(event_day(events) == F.lit(day))


def in_days(events: DataFrame, start: date, end: date) -> DataFrame:
    """Rows of a closed range of days; prunes partitions where the day is one."""
    return events.where(event_day(events).between(F.lit(start), F.lit(end)))


def for_repo(df: DataFrame, repo: str | None) -> DataFrame:
    """Rows of one repository, or all of them when none is chosen."""
    if not repo or repo == ALL_REPOS:
        return df
    return df.where(F.col("repo_name") == F.lit(repo))
