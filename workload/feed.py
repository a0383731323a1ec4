"""The given `events` table read as raw activity events.

Users are actors, the key inside `props` is the repository, and every tenth event is
delivered a second time, in file 'b', so that there are duplicates to remove.
"""

from __future__ import annotations

import gzip
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.config import days_in
from forgepulse.sinks.hourly import file_system

EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, props STRING"

REPOS = tuple(f"repo-{k}" for k in range(0, 99, 7))
ALL_REPOS = tuple(f"repo-{k}" for k in range(100))
REPO = "repo-42"
# The dashboard's seven days.
START, END = date(2024, 1, 24), date(2024, 1, 30)


def raw_events(spark: SparkSession, sf_dir: str, late_copies: bool = False) -> DataFrame:
    """With `late_copies`, some events also arrive again dated one day later, in file 'c'."""
    late = "WHEN event_id % 10 = 5 THEN array(struct('a', 0), struct('c', 1))" if late_copies else ""
    deliveries = f"""
        CASE WHEN event_id % 10 = 0 THEN array(struct('a', 0), struct('b', 0)) {late}
             ELSE array(struct('a', 0)) END"""
    created_at = "ts + make_dt_interval(days_late)" if late_copies else "ts"
    return (
        spark.read.schema(EVENTS)
        .parquet(f"{sf_dir}/events.parquet")
        .selectExpr("*", f"inline({deliveries}) AS (filename, days_late)")
        .selectExpr("*", "cast(get_json_object(props, '$.k') AS BIGINT) AS k")
        .selectExpr(
            "cast(event_id AS STRING) AS id",
            "event_type AS type",
            """struct(user_id AS id,
                      CASE WHEN user_id % 50 <> 0 THEN 'user-' || user_id END AS login) AS actor""",
            "struct(k AS id, 'repo-' || k AS name) AS repo",
            """CASE WHEN user_id % 3 <> 0
                    THEN struct(user_id AS id, 'org-' || user_id AS login) END AS org""",
            f"{created_at} AS created_at",
            "props AS payload",
            "filename",
        )
    )


def days_of(raw: DataFrame) -> list[date]:
    """Every day from the first to the last that events are dated."""
    day = F.to_date("created_at")
    first, last = raw.agg(F.min(day), F.max(day)).first()
    return [] if first is None else days_in(first, last)


# Runs reject events of nobody, so those without a login get one.
NOBODY = "(no login)"


def attributed(raw: DataFrame) -> DataFrame:
    return raw.withColumn(
        "actor", F.col("actor").withField("login", F.coalesce("actor.login", F.lit(NOBODY)))
    )


# Hours of the landed feed that never arrived, and that arrived empty or cut off.
LOST_HOURS = "hour(created_at) = 11 AND dayofmonth(created_at) % 3 = 0"
EMPTY_HOUR, CUT_HOUR = 7, 13


def damage(spark: SparkSession, landing_dir: str, names: list[str]) -> None:
    """Make files of two hours of each day unreadable: names are a row per hour."""
    cut_off = gzip.compress(b'{"id": "1"}\n' * 50)[:-6]
    for name in names:
        hour = int(name.rpartition("-")[2].split(".")[0])
        if hour in (EMPTY_HOUR, CUT_HOUR):
            system, to_path = file_system(spark, landing_dir)
            with_content = system.create(to_path(f"{landing_dir}/{name}"), True)
            if hour == CUT_HOUR:
                with_content.write(bytearray(cut_off))
            with_content.close()


_REPO_LIST = ", ".join(f"'{name}'" for name in REPOS)

# The same feed and its staging tables for DuckDB.
CTES = f"""
WITH keyed AS (
  SELECT *, cast(json_extract(props, '$.k') AS bigint) AS k FROM events
),
delivered AS (
  SELECT *, 'a' AS filename, ts AS created_at FROM keyed
  UNION ALL
  SELECT *, 'b' AS filename, ts AS created_at FROM keyed WHERE event_id % 10 = 0
  UNION ALL
  SELECT *, 'c' AS filename, ts + INTERVAL 1 DAY AS created_at FROM keyed
  WHERE event_id % 10 = 5
),
late_raw AS (
  SELECT
    cast(event_id AS varchar) AS event_id, event_type, user_id AS actor_id,
    CASE WHEN user_id % 50 <> 0 THEN 'user-' || user_id END AS actor_login,
    k AS repo_id, 'repo-' || k AS repo_name, created_at,
    CASE WHEN user_id % 3 <> 0 THEN user_id END AS org_id,
    CASE WHEN user_id % 3 <> 0 THEN 'org-' || user_id END AS org_login,
    filename, props AS payload
  FROM delivered
),
raw AS (SELECT * FROM late_raw WHERE filename <> 'c'),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY event_id ORDER BY created_at DESC, filename DESC) AS rn
  FROM raw
),
stg AS (
  SELECT *, cast(created_at AS date) AS event_date
  FROM (SELECT * EXCLUDE (rn, payload) FROM ranked WHERE rn = 1)
),
late_named AS (
  SELECT * REPLACE (coalesce(actor_login, '{NOBODY}') AS actor_login),
         cast(created_at AS date) AS event_date
  FROM late_raw
),
selected AS (SELECT * FROM stg WHERE repo_name IN ({_REPO_LIST})),
recent AS (
  SELECT * FROM selected WHERE event_date BETWEEN DATE '{START}' AND DATE '{END}'
),
daily AS (
  SELECT repo_name, event_date, count(*) AS total_events,
         count(DISTINCT actor_login) AS unique_actors
  FROM selected GROUP BY repo_name, event_date
),
by_type AS (
  SELECT repo_name, event_date, event_type, count(*) AS total_events,
         count(DISTINCT actor_login) AS unique_actors
  FROM selected GROUP BY repo_name, event_date, event_type
),
by_actor AS (
  SELECT repo_name, actor_login, count(*) AS total_events,
         count(DISTINCT event_type) AS event_types_count,
         min(created_at) AS first_activity, max(created_at) AS last_activity
  FROM selected GROUP BY repo_name, actor_login
),
summary AS (
  SELECT repo_name, count(*) AS total_events,
         count(DISTINCT actor_login) AS unique_actors,
         count(DISTINCT event_date) AS active_days,
         min(created_at) AS first_activity, max(created_at) AS last_activity
  FROM selected GROUP BY repo_name
),
hours AS (
  SELECT cast(d AS date) AS file_date, h AS hour,
         strftime(d, '%Y-%m-%d') || '-' || h || '.json.gz' AS filename
  FROM generate_series(
         (SELECT cast(min(event_date) AS timestamp) FROM stg),
         (SELECT cast(max(event_date) AS timestamp) FROM stg), INTERVAL 1 DAY) AS days(d)
  CROSS JOIN range(24) AS hrs(h)
),
files AS (
  SELECT strftime(created_at, '%Y-%m-%d') || '-' || hour(created_at) || '.json.gz' AS filename,
         hour(created_at) AS hour, count(*) AS lines
  FROM raw WHERE NOT (hour(created_at) = 11 AND day(created_at) % 3 = 0) GROUP BY ALL
)
"""
