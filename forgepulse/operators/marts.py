"""The aggregate tables.

All of them count map-side first. An exact distinct count shuffles by group and
counted value together, so a repository with a third of all events is spread over
many tasks and its group only merges one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.functions.columns import event_day

DAILY_KEYS = ("repo_name", "event_date")
DAILY_TYPE_KEYS = ("repo_name", "event_date", "event_type")


def daily_activity(events: DataFrame) -> DataFrame:
    """Per repository and day."""
    return events.groupBy("repo_name", event_day(events).alias("event_date")).agg(
        F.count("*").alias("total_events"),
        F.count_distinct("actor_login").alias("unique_actors"),
    )


def daily_event_type_activity(events: DataFrame) -> DataFrame:
    """Per repository, day and event type."""
    return events.groupBy(
        "repo_name", event_day(events).alias("event_date"), "event_type"
    ).agg(
        F.count("*").alias("total_events"),
        F.count_distinct("actor_login").alias("unique_actors"),
    )


def actor_activity(events: DataFrame) -> DataFrame:
    """Per repository and actor; events without an actor form one group."""
    return events.groupBy("repo_name", "actor_login").agg(
        F.count("*").alias("total_events"),
        F.count_distinct("event_type").alias("event_types_count"),
        F.min("created_at").alias("first_activity"),
        F.max("created_at").alias("last_activity"),
    )


def repo_summary(events: DataFrame) -> DataFrame:
    """Per repository, as window runs build it."""
    return events.groupBy("repo_name").agg(
        F.count("*").alias("total_events"),
        F.count_distinct("actor_login").alias("unique_actors"),
        F.count_distinct(event_day(events)).alias("active_days"),
        F.min("created_at").alias("first_activity"),
        F.max("created_at").alias("last_activity"),
    )


def repo_summary_by_type(events: DataFrame) -> DataFrame:
    """Per repository, as incremental runs build it."""
    return events.groupBy("repo_name").agg(
        F.count("*").alias("total_events"),
        F.count_distinct("actor_login").alias("total_actors"),
        F.count_distinct("event_type").alias("total_event_types"),
        F.min("created_at").alias("first_activity"),
        F.max("created_at").alias("last_activity"),
    )


STATE_KEYS = ("repo_name", "actor_login", "event_type")


def activity_state(events: DataFrame) -> DataFrame:
    """What each day adds to the marts over all days: a row per repository, actor and type.

    Rows of different days merge: counts add up, and the least and greatest time stay. A day
    that is loaded again replaces its own rows and no others.
    """
    return events.groupBy(*STATE_KEYS, event_day(events).alias("event_date")).agg(
        F.count("*").alias("total_events"),
        F.min("created_at").alias("first_activity"),
        F.max("created_at").alias("last_activity"),
    )


def _merged_times(state: DataFrame, *keys: str, **counts: str) -> DataFrame:
    return state.groupBy(*keys).agg(
        F.sum("total_events").alias("total_events"),
        *(F.count_distinct(column).alias(name) for name, column in counts.items()),
        F.min("first_activity").alias("first_activity"),
        F.max("last_activity").alias("last_activity"),
    )


def actor_activity_of(state: DataFrame) -> DataFrame:
    """`actor_activity` of all days, from their state."""
    return _merged_times(state, "repo_name", "actor_login", event_types_count="event_type")


def repo_summary_of(state: DataFrame) -> DataFrame:
    """`repo_summary_by_type` of all days, from their state."""
    return _merged_times(
        state, "repo_name", total_actors="actor_login", total_event_types="event_type"
    )
