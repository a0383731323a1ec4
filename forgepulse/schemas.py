"""Schemas of the raw, staging and mart tables, as DDL."""

from __future__ import annotations

# `payload` differs per event type and is never read here: it stays JSON text, so
# its keys may clash or change from file to file.
RAW = (
    "id STRING, type STRING, "
    "actor STRUCT<id: BIGINT, login: STRING>, "
    "repo STRUCT<id: BIGINT, name: STRING>, "
    "payload STRING, public BOOLEAN, created_at TIMESTAMP, "
    "org STRUCT<id: BIGINT, login: STRING>"
)

STAGING = (
    "event_id STRING, event_type STRING, actor_id BIGINT, actor_login STRING, "
    "repo_id BIGINT, repo_name STRING, created_at TIMESTAMP, org_id BIGINT, org_login STRING"
)

# What a day adds to the marts that span all days: counts that add up, times that compare.
ACTIVITY_STATE = (
    "repo_name STRING, actor_login STRING, event_type STRING, "
    "total_events BIGINT, first_activity TIMESTAMP, last_activity TIMESTAMP, event_date DATE"
)

DAILY_ACTIVITY = (
    "repo_name STRING, event_date DATE, total_events BIGINT, unique_actors BIGINT"
)

DAILY_EVENT_TYPE_ACTIVITY = (
    "repo_name STRING, event_date DATE, event_type STRING, "
    "total_events BIGINT, unique_actors BIGINT"
)
