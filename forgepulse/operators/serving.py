"""Dashboard reads over the staging and mart tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.config import LOOKBACK_DAYS
from forgepulse.functions.columns import calendar, day_label, event_day, short_name
from forgepulse.operators.staging import for_repo, in_days

TOP_N = 5


def repo_options(summary: DataFrame) -> DataFrame:
    return summary.select("repo_name").orderBy(F.asc_nulls_last("repo_name"))


def last_loaded_date(events: DataFrame) -> DataFrame:
    """One row; null when nothing is loaded."""
    return events.agg(F.max(event_day(events)).alias("max_date"))


def dashboard_window(events: DataFrame, days: int = LOOKBACK_DAYS) -> DataFrame:
    """The last loaded day and the `days` - 1 before it."""
    return last_loaded_date(events).select(
        F.date_sub("max_date", days - 1).alias("start_date"),
        F.col("max_date").alias("end_date"),
    )


def active_repo_count(selected: DataFrame, start: date, end: date) -> DataFrame:
    return in_days(selected, start, end).agg(
        F.count_distinct("repo_name").alias("active_repos")
    )


def kpis(selected: DataFrame, start: date, end: date, repo: str | None = None) -> DataFrame:
    """Totals and the average per day that had events; zeros when there are none."""
    events = for_repo(in_days(selected, start, end), repo)
    active_days = F.count_distinct(event_day(events))
    average = F.count("*").cast("double") / F.nullif(active_days.cast("double"), F.lit(0.0))
    return events.agg(
        F.count("*").alias("total_events"),
        F.count_distinct("actor_login").alias("total_contributors"),
        F.coalesce(average, F.lit(0.0)).alias("avg_events_per_day"),
    )


def _daily(selected: DataFrame, start: date, end: date, repo: str | None) -> DataFrame:
    events = for_repo(in_days(selected, start, end), repo)
    return events.groupBy(event_day(events).alias("event_date")).agg(
        F.count("*").alias("total_events"),
        F.count_distinct("actor_login").alias("unique_actors"),
    )


def activity_over_time(
    selected: DataFrame, start: date, end: date, repo: str | None = None
) -> DataFrame:
    return _daily(selected, start, end, repo).orderBy("event_date")


def activity_zero_filled(
    selected: DataFrame, start: date, end: date, metric: str = "total_events",
    repo: str | None = None,
) -> DataFrame:
    """One metric for every day of the range, zero on days without events.

    The daily side is grouped by day inside the range, so it has at most one row per
    day asked for; that bound is what makes the broadcast safe.
    """
    if metric not in ("total_events", "unique_actors"):
        raise ValueError(f"unknown metric {metric!r}")
    daily = _daily(selected, start, end, repo).select("event_date", metric)
    every_day = calendar(selected.sparkSession, start, end, "event_date")
    return (
        every_day.join(F.broadcast(daily), "event_date", "left")
        .select(
            "event_date",
            F.coalesce(metric, F.lit(0)).cast("bigint").alias(metric),
            day_label(F.col("event_date")).alias("event_date_label"),
        )
        .orderBy("event_date")
    )


def event_type_distribution(
    by_type: DataFrame, start: date, end: date, repo: str | None = None
) -> DataFrame:
    """Reads the daily event-type mart."""
    return (
        for_repo(in_days(by_type, start, end), repo)
        .groupBy("event_type")
        .agg(F.sum("total_events").alias("total_events"))
        .orderBy(F.desc("total_events"), F.asc_nulls_last("event_type"))
    )


def _top(df: DataFrame, name: str, n: int) -> DataFrame:
    return df.orderBy(F.desc("total_events"), F.asc_nulls_last(name)).limit(n)


def top_repos(summary: DataFrame, n: int = TOP_N) -> DataFrame:
    return _top(summary.select("repo_name", "total_events"), "repo_name", n)


def top_contributors(by_actor: DataFrame, repo: str, n: int = TOP_N) -> DataFrame:
    """Most active actors of one repository over all loaded days."""
    rows = by_actor.where(F.col("repo_name") == F.lit(repo)).select(
        "actor_login", "total_events", "first_activity", "last_activity"
    )
    return _top(rows, "actor_login", n)


def top_entities(
    summary: DataFrame, selected: DataFrame, start: date, end: date,
    repo: str | None = None, n: int = TOP_N,
) -> DataFrame:
    """Top repositories over all loaded days, or one repository's top actors in the range."""
    if not repo:
        ranked = summary.select(F.col("repo_name").alias("entity_name"), "total_events")
    else:
        ranked = (
            in_days(selected, start, end)
            .where(F.col("repo_name") == F.lit(repo))
            .groupBy(F.col("actor_login").alias("entity_name"))
            .agg(F.count("*").alias("total_events"))
        )
    return _top(ranked, "entity_name", n)


def with_labels(entities: DataFrame, are_repos: bool) -> DataFrame:
    """Chart labels: repositories lose their owner, actors keep their name."""
    name = F.col("entity_name")
    return entities.withColumn("entity_label", short_name(name) if are_repos else name)
