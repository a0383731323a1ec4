"""Every registered query, next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse import config
from forgepulse.config import DayRange, Tables
from forgepulse.functions.columns import base_name, each_day
from forgepulse.operators import checks, marts, serving, staging
from forgepulse.plans import incremental, window
from forgepulse.plans.dashboard import Dashboard
from forgepulse.session import prepare, scratch_database, scratch_path
from forgepulse.sinks import loads
from forgepulse.sinks.hourly import land_hours
from forgepulse.sources import lake, landing, ndjson
from workload.feed import (
    ALL_REPOS, CTES, CUT_HOUR, EMPTY_HOUR, END, LOST_HOURS, NOBODY, REPO, REPOS, START, attributed,
    damage, days_of, raw_events,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

STAGING = (
    "event_id, event_type, actor_id, actor_login, repo_id, repo_name, created_at, "
    "org_id, org_login"
)
IN_RANGE = f"event_date BETWEEN DATE '{START}' AND DATE '{END}'"


def query(sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        QUERIES[build.__name__] = run
        ORACLES[build.__name__] = CTES + sql
        return run

    return register


def selected_events(spark, sf_dir, since=None, columns=None) -> DataFrame:
    """Selected events with all columns, or those the query reads."""
    if columns is not None:
        columns = [*columns, "repo_name"]
    staged = staging.stage_events(raw_events(spark, sf_dir), since, columns)
    return staging.select_repos(staged, REPOS)


ACTOR = ["actor_login"]
ACTOR_TYPE = ["actor_login", "event_type"]


# -- staging ---------------------------------------------------------------------------


@query(f"SELECT {STAGING}, filename FROM raw")
def flatten_event(spark, sf_dir):
    return staging.flatten_event(raw_events(spark, sf_dir))


@query(f"SELECT {STAGING}, filename FROM stg")
def dedup_latest(spark, sf_dir):
    return staging.stage_events(raw_events(spark, sf_dir))


@query(f"""
SELECT {STAGING}, filename, event_date FROM (
  SELECT *, cast(created_at AS date) AS event_date, row_number() OVER (
    PARTITION BY cast(created_at AS date), event_id
    ORDER BY created_at DESC, filename DESC) AS n
  FROM late_raw)
WHERE n = 1""")
def dedup_latest_day(spark, sf_dir):
    return staging.stage_events_by_day(raw_events(spark, sf_dir, late_copies=True))


@query(f"SELECT {STAGING}, filename FROM selected")
def repo_allow_list(spark, sf_dir):
    return selected_events(spark, sf_dir)


@query(f"""
SELECT {STAGING}, filename FROM stg
WHERE repo_name IN (SELECT repo_name FROM raw WHERE actor_login = 'user-7')""")
def repo_allow_list_table(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    listed = raw.where(F.col("actor.login") == "user-7").select("repo.name").distinct()
    return staging.select_repos(staging.stage_events(raw), listed)


@query(f"SELECT {STAGING}, filename FROM stg WHERE event_date = DATE '{END}'")
def target_day(spark, sf_dir):
    return staging.on_day(staging.stage_events(raw_events(spark, sf_dir), since=END), END)


# -- marts -----------------------------------------------------------------------------


@query("SELECT * FROM daily")
def mart_repo_daily_activity(spark, sf_dir):
    return marts.daily_activity(selected_events(spark, sf_dir, columns=ACTOR))


@query("SELECT * FROM by_type")
def mart_repo_daily_event_type_activity(spark, sf_dir):
    return marts.daily_event_type_activity(selected_events(spark, sf_dir, columns=ACTOR_TYPE))


@query("SELECT * FROM by_actor")
def mart_repo_actor_activity(spark, sf_dir):
    return marts.actor_activity(selected_events(spark, sf_dir, columns=ACTOR_TYPE))


@query("SELECT * FROM summary")
def mart_repo_summary(spark, sf_dir):
    return marts.repo_summary(selected_events(spark, sf_dir, columns=ACTOR))


@query("""
SELECT repo_name, count(*) AS total_events, count(DISTINCT actor_login) AS total_actors,
       count(DISTINCT event_type) AS total_event_types,
       min(created_at) AS first_activity, max(created_at) AS last_activity
FROM selected GROUP BY repo_name""")
def mart_repo_summary_cloud(spark, sf_dir):
    return marts.repo_summary_by_type(selected_events(spark, sf_dir, columns=ACTOR_TYPE))


# -- dashboard -------------------------------------------------------------------------


KPIS = """
SELECT count(*) AS total_events, count(DISTINCT actor_login) AS total_contributors,
       coalesce(cast(count(*) AS double) / nullif(count(DISTINCT event_date), 0), 0.0)
         AS avg_events_per_day
FROM recent"""


@query(KPIS)
def kpis(spark, sf_dir):
    return serving.kpis(selected_events(spark, sf_dir, START, ACTOR), START, END)


@query(f"{KPIS} WHERE repo_name = '{REPO}'")
def kpis_for_repo(spark, sf_dir):
    return serving.kpis(selected_events(spark, sf_dir, START, ACTOR), START, END, REPO)


@query(f"{KPIS} WHERE repo_name = 'no/such'")
def kpis_without_events(spark, sf_dir):
    return serving.kpis(selected_events(spark, sf_dir, START, ACTOR), START, END, "no/such")


OVER_TIME = """
SELECT event_date, count(*) AS total_events, count(DISTINCT actor_login) AS unique_actors
FROM recent"""


@query(f"{OVER_TIME} GROUP BY event_date ORDER BY event_date")
def activity_over_time(spark, sf_dir):
    return serving.activity_over_time(selected_events(spark, sf_dir, START, ACTOR), START, END)


@query(f"{OVER_TIME} WHERE repo_name = '{REPO}' GROUP BY event_date ORDER BY event_date")
def activity_over_time_for_repo(spark, sf_dir):
    return serving.activity_over_time(selected_events(spark, sf_dir, START, ACTOR), START, END, REPO)


def _zero_filled(start: str, end: str, measure: str, name: str, where: str = "true") -> str:
    return f"""
SELECT cast(d AS date) AS event_date, coalesce(any_value(n), 0) AS {name},
       strftime(d, '%b %d') AS event_date_label
FROM generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL 1 DAY) AS days(d)
LEFT JOIN (SELECT event_date, {measure} AS n FROM selected WHERE {where} GROUP BY event_date)
  ON event_date = cast(d AS date)
GROUP BY d ORDER BY d"""


@query(_zero_filled("2023-12-30", "2024-01-05", "count(*)", "total_events"))
def activity_zero_filled(spark, sf_dir):
    days = DayRange.ending("2024-01-05", 7)
    events = selected_events(spark, sf_dir, days.start, ACTOR)
    return serving.activity_zero_filled(events, days.start, days.end)


@query(_zero_filled(
    str(START), str(END), "count(DISTINCT actor_login)", "unique_actors", f"repo_name = '{REPO}'"
))
def activity_zero_filled_for_repo(spark, sf_dir):
    events = selected_events(spark, sf_dir, START, ACTOR)
    return serving.activity_zero_filled(events, START, END, "unique_actors", REPO)


BY_TYPE = f"""
SELECT event_type, cast(sum(total_events) AS bigint) AS total_events
FROM by_type WHERE {IN_RANGE}"""
TYPE_ORDER = "GROUP BY event_type ORDER BY total_events DESC, event_type NULLS LAST"


@query(f"{BY_TYPE} {TYPE_ORDER}")
def event_type_distribution(spark, sf_dir):
    by_type = marts.daily_event_type_activity(
        selected_events(spark, sf_dir, START, ACTOR_TYPE)
    )
    return serving.event_type_distribution(by_type, START, END)


@query(f"{BY_TYPE} AND repo_name = '{REPO}' {TYPE_ORDER}")
def event_type_distribution_for_repo(spark, sf_dir):
    by_type = marts.daily_event_type_activity(
        selected_events(spark, sf_dir, START, ACTOR_TYPE)
    )
    return serving.event_type_distribution(by_type, START, END, REPO)


@query("SELECT count(DISTINCT repo_name) AS active_repos FROM recent")
def active_repo_count(spark, sf_dir):
    return serving.active_repo_count(selected_events(spark, sf_dir, START, ACTOR), START, END)


# The latest day of all copies is the latest day of the copies kept: deduplication
# never drops the newest copy of an event. So these two read the raw events.


@query("SELECT max(event_date) AS max_date FROM stg")
def last_loaded_date(spark, sf_dir):
    return serving.last_loaded_date(staging.flatten_event(raw_events(spark, sf_dir)))


@query("SELECT max(event_date) - 6 AS start_date, max(event_date) AS end_date FROM stg")
def dashboard_window(spark, sf_dir):
    return serving.dashboard_window(staging.flatten_event(raw_events(spark, sf_dir)))


@query("SELECT repo_name FROM summary ORDER BY repo_name NULLS LAST")
def repo_options(spark, sf_dir):
    return serving.repo_options(marts.repo_summary(selected_events(spark, sf_dir, columns=ACTOR)))


@query("""
SELECT repo_name, total_events FROM summary
ORDER BY total_events DESC, repo_name NULLS LAST LIMIT 5""")
def top_repos(spark, sf_dir):
    return serving.top_repos(marts.repo_summary(selected_events(spark, sf_dir, columns=ACTOR)))


@query("""
SELECT 'forge/' || repo_name AS entity_name, total_events, repo_name AS entity_label
FROM summary ORDER BY total_events DESC, repo_name NULLS LAST LIMIT 5""")
def top_repo_labels(spark, sf_dir):
    events = selected_events(spark, sf_dir, columns=ACTOR)
    owned = events.withColumn("repo_name", F.concat(F.lit("forge/"), "repo_name"))
    top = serving.top_entities(marts.repo_summary(owned), owned, START, END)
    return serving.with_labels(top, are_repos=True)


@query(f"""
SELECT actor_login AS entity_name, count(*) AS total_events, actor_login AS entity_label
FROM recent WHERE repo_name = '{REPO}' GROUP BY actor_login
ORDER BY total_events DESC, actor_login NULLS LAST LIMIT 5""")
def top_contributors_in_range(spark, sf_dir):
    events = selected_events(spark, sf_dir, START, ACTOR)
    top = serving.top_entities(marts.repo_summary(events), events, START, END, REPO)
    return serving.with_labels(top, are_repos=False)


@query(f"""
SELECT actor_login, total_events, first_activity, last_activity
FROM by_actor WHERE repo_name = '{REPO}'
ORDER BY total_events DESC, actor_login NULLS LAST LIMIT 5""")
def top_contributors(spark, sf_dir):
    return serving.top_contributors(marts.actor_activity(selected_events(spark, sf_dir, columns=ACTOR_TYPE)), REPO)


# -- loads -----------------------------------------------------------------------------


@query(f"SELECT {STAGING}, filename, event_date FROM stg")
def full_rebuild(spark, sf_dir):
    """A second rebuild leaves no row of the first."""
    table = f"{scratch_database(spark, 'rebuild')}.stg_events"
    staged = staging.stage_events(raw_events(spark, sf_dir)).withColumn(
        loads.DAY, F.to_date("created_at")
    )
    loads.full_rebuild(
        staged.where("event_type = 'click'"), table, loads.DAY, ["repo_name"]
    )
    loads.full_rebuild(staged, table, loads.DAY, ["repo_name"])
    return spark.table(table)


@query(f"""
SELECT {STAGING}, event_date FROM stg
WHERE event_date = DATE '{END}' OR event_type <> 'click'""")
def replace_day(spark, sf_dir):
    """All days loaded without clicks, then the last day loaded again in full."""
    tables = Tables(scratch_database(spark, "replace_day"))
    incremental.create_tables(spark, tables)
    table = tables["stg_events"]
    raw = raw_events(spark, sf_dir).withColumn(loads.DAY, F.to_date("created_at"))
    staged = lambda events: staging.staging_columns(staging.stage_events_by_day(events))
    others = staged(raw.where("type <> 'click'"))
    loads.replace_days(others, table, days_of(raw), ["repo_name"], allow_empty=True)
    loads.replace_days(staged(staging.on_day(raw, END)), table, [END], ["repo_name"])
    return spark.table(table)


def _upserted(spark, sf_dir, name):
    """All days without clicks, then the clicks of the last days upserted."""
    tables = Tables(scratch_database(spark, "upsert"))
    incremental.create_tables(spark, tables)
    build, _, keys, cluster_by = incremental.DAILY_MARTS[name]
    events = selected_events(spark, sf_dir, columns=ACTOR_TYPE)
    other, clicks = events.where("event_type <> 'click'"), events.where("event_type = 'click'")
    days = days_of(raw_events(spark, sf_dir))
    loads.replace_days(build(other), tables[name], days, cluster_by, allow_empty=True)
    recent = DayRange(START, END).days
    loads.upsert_days(
        build(staging.in_days(clicks, START, END)), tables[name], keys, recent, cluster_by
    )
    return spark.table(tables[name])


def _merge_sql(keys: str) -> str:
    measures = "count(*) AS total_events, count(DISTINCT actor_login) AS unique_actors"
    return f""",
old AS (SELECT {keys}, {measures} FROM selected WHERE event_type <> 'click' GROUP BY ALL),
new AS (SELECT {keys}, {measures} FROM recent WHERE event_type = 'click' GROUP BY ALL)
SELECT * FROM new UNION ALL BY NAME SELECT * FROM old ANTI JOIN new USING ({keys})"""


@query(_merge_sql("repo_name, event_date"))
def upsert_daily(spark, sf_dir):
    return _upserted(spark, sf_dir, "mart_repo_daily_activity")


@query(_merge_sql("repo_name, event_date, event_type"))
def upsert_daily_by_type(spark, sf_dir):
    return _upserted(spark, sf_dir, "mart_repo_daily_event_type_activity")


@query(f"SELECT * FROM daily WHERE {IN_RANGE}")
def retention(spark, sf_dir):
    tables = Tables(scratch_database(spark, "retention"))
    incremental.create_tables(spark, tables)
    name = "mart_repo_daily_activity"
    daily = marts.daily_activity(selected_events(spark, sf_dir, columns=ACTOR))
    days = days_of(raw_events(spark, sf_dir))
    loads.replace_days(daily, tables[name], days, ["repo_name"], allow_empty=True)
    loads.retain_days(spark, tables[name], START, END)
    return spark.table(tables[name])


@query(f"SELECT {STAGING}, filename FROM raw WHERE {IN_RANGE.replace('event_date', 'cast(created_at AS date)')}")
def export_day_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "lake")
    raw = raw_events(spark, sf_dir)
    loads.export_days(raw, root, days_of(raw), F.to_date("created_at"))
    return staging.flatten_event(lake.scan_lake_days(spark, root, START, END))


def _landed_ndjson(spark, sf_dir) -> str:
    """The feed as gzipped NDJSON files."""
    path = scratch_path(spark, "ndjson")
    raw_events(spark, sf_dir).drop("filename").write.json(
        path, compression="gzip", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    )
    return path


@query(f"SELECT {STAGING} FROM raw")
def scan_ndjson_roundtrip(spark, sf_dir):
    raw = ndjson.scan_ndjson(spark, _landed_ndjson(spark, sf_dir))
    return staging.flatten_event(raw).drop("filename")


@query(f"SELECT {STAGING} FROM raw")
def scan_ndjson_variant_roundtrip(spark, sf_dir):
    raw = ndjson.scan_ndjson_variant(spark, _landed_ndjson(spark, sf_dir))
    return staging.flatten_event(raw).drop("filename")


@query(f"SELECT {STAGING} FROM raw")
def scan_ndjson_inferred_roundtrip(spark, sf_dir):
    raw = ndjson.scan_ndjson_inferred(spark, _landed_ndjson(spark, sf_dir))
    return staging.flatten_event(raw).drop("filename")


@query(f"SELECT {STAGING} FROM raw WHERE cast(created_at AS date) = DATE '{END}'")
def export_source_day(spark, sf_dir):
    """A source with a table per day, one of which is exported to the lake."""
    prefix, root = f"{scratch_database(spark, 'source')}.day_", scratch_path(spark, "lake")
    raw = raw_events(spark, sf_dir).drop("filename")
    raw.where(F.to_date("created_at") == F.lit(END)).write.saveAsTable(f"{prefix}{END:%Y%m%d}")
    loads.export_days(lake.scan_source_day(spark, prefix, END), root, [END])
    return staging.flatten_event(lake.scan_lake_days(spark, root, END, END))


@query(f"""
SELECT * REPLACE (coalesce(actor_login, '{NOBODY}') AS actor_login) FROM by_actor""")
def window_run(spark, sf_dir):
    """All tables rebuilt and checked; returns the last mart but one."""
    tables = Tables(scratch_database(spark, "window"))
    raw = attributed(raw_events(spark, sf_dir))
    window.build_from_raw(spark, raw, tables, REPOS)
    return spark.table(tables["mart_repo_actor_activity"])


@query("""
SELECT repo_name, event_date, event_type,
       count(DISTINCT event_id) AS total_events, count(DISTINCT actor_login) AS unique_actors
FROM late_named GROUP BY ALL""")
def incremental_run(spark, sf_dir):
    """A lake of all days, copies on later days included, loaded twice."""
    root = scratch_path(spark, "lake")
    tables = Tables(scratch_database(spark, "incremental"))
    raw = attributed(raw_events(spark, sf_dir, late_copies=True)).drop("filename")
    days = days_of(raw)
    loads.export_days(raw, root, days, F.to_date("created_at"))
    incremental.run_days(spark, root, tables, days, ALL_REPOS)
    incremental.run_days(spark, root, tables, [END], ALL_REPOS)
    return spark.table(tables["mart_repo_daily_event_type_activity"])


def _reloaded_without_clicks(spark, sf_dir) -> Tables:
    """All days loaded from the lake, then the last day again, delivered without clicks.

    The second run starts from its execution date given as text, the day after.
    """
    root = scratch_path(spark, "lake")
    tables = Tables(scratch_database(spark, "incremental"))
    raw = attributed(raw_events(spark, sf_dir, late_copies=True)).drop("filename")
    days, day = days_of(raw), F.to_date("created_at")
    loads.export_days(raw, root, days, day)
    incremental.run_days(spark, root, tables, days, REPOS)
    again = config.target_day(f"{END + timedelta(days=1)}T02:00:00Z")
    loads.export_days(raw.where((day == F.lit(again)) & (F.col("type") != "click")), root, [again])
    incremental.run_days(spark, root, tables, [again], REPOS, marts_keep_stale=False)
    return tables


_RELOADED = f"""
, loaded AS (
  SELECT DISTINCT event_id, event_date, repo_name, actor_login, event_type, created_at
  FROM late_named
  WHERE repo_name IN (SELECT repo_name FROM selected)
    AND (event_date <> DATE '{END}' OR event_type <> 'click')
)"""


@query(f"""{_RELOADED}
SELECT repo_name, actor_login, count(*) AS total_events,
       count(DISTINCT event_type) AS event_types_count,
       min(created_at) AS first_activity, max(created_at) AS last_activity
FROM loaded GROUP BY ALL""")
def incremental_actor_activity(spark, sf_dir):
    tables = _reloaded_without_clicks(spark, sf_dir)
    return spark.table(tables["mart_repo_actor_activity"])


@query(f"""{_RELOADED}
SELECT repo_name, count(*) AS total_events, count(DISTINCT actor_login) AS total_actors,
       count(DISTINCT event_type) AS total_event_types,
       min(created_at) AS first_activity, max(created_at) AS last_activity
FROM loaded GROUP BY ALL""")
def incremental_summary(spark, sf_dir):
    return spark.table(_reloaded_without_clicks(spark, sf_dir)["mart_repo_summary"])


def _served(spark, sf_dir) -> Dashboard:
    """The dashboard over the tables a window run has written."""
    tables = Tables(scratch_database(spark, "served"))
    window.build_from_raw(spark, attributed(raw_events(spark, sf_dir)), tables, REPOS)
    return Dashboard(spark, tables)


@query(f"""
SELECT count(*) AS total_events, count(DISTINCT coalesce(actor_login, '{NOBODY}')) AS total_contributors,
       coalesce(cast(count(*) AS double) / nullif(count(DISTINCT event_date), 0), 0.0)
         AS avg_events_per_day
FROM selected
WHERE event_date > (SELECT max(event_date) - 7 FROM stg)
""")
def served_kpis(spark, sf_dir):
    """The last seven loaded days, read from their partitions."""
    board = _served(spark, sf_dir)
    return board.kpis(board.window())


@query("""
SELECT event_type, cast(sum(total_events) AS bigint) AS total_events FROM by_type
WHERE event_date > (SELECT max(event_date) - 7 FROM stg)
GROUP BY event_type ORDER BY total_events DESC, event_type NULLS LAST""")
def served_event_types(spark, sf_dir):
    board = _served(spark, sf_dir)
    return board.event_type_distribution(board.window())


@query(f"""
SELECT coalesce(actor_login, '{NOBODY}') AS actor_login, total_events, first_activity, last_activity
FROM by_actor WHERE repo_name = '{REPO}'
ORDER BY total_events DESC, actor_login NULLS LAST LIMIT 5""")
def served_top_contributors(spark, sf_dir):
    return _served(spark, sf_dir).top_contributors(REPO)


# -- landing ---------------------------------------------------------------------------


def _landing_dir(spark, sf_dir) -> str:
    """The feed as hourly files of all repositories, but for those of the first repository's
    hours that did not arrive; files of two hours of the day are damaged: the one is empty, the
    other breaks off."""
    path = scratch_path(spark, "landing")
    raw = raw_events(spark, sf_dir).drop("filename")
    names = land_hours(raw.where(f"NOT ({LOST_HOURS})"), path)
    damage(spark, path, names)
    return path


def _landing(spark, sf_dir):
    first, last = _days_of_feed(spark, sf_dir)
    return (
        landing.expected_files(spark, first, last),
        landing.landed_files(spark, _landing_dir(spark, sf_dir)),
    )


def _days_of_feed(spark, sf_dir):
    days = days_of(raw_events(spark, sf_dir))
    return days[0], days[-1]


@query(f"""
SELECT 'warn' AS severity, 'missing' AS issue, filename FROM hours ANTI JOIN files USING (filename)
UNION ALL
SELECT 'error', 'too small', filename FROM files WHERE hour = {EMPTY_HOUR}""")
def landing_manifest(spark, sf_dir):
    return landing.audit(*_landing(spark, sf_dir), min_bytes=20)


@query("""
, missing AS (SELECT filename FROM hours ANTI JOIN files USING (filename))
SELECT filename, 1 AS files
FROM (SELECT filename FROM missing ORDER BY filename LIMIT 10)
UNION ALL
SELECT NULL, count(*) - 10 FROM missing HAVING count(*) > 10""")
def landing_missing_report(spark, sf_dir):
    return landing.missing_report(*_landing(spark, sf_dir))


@query(f"SELECT filename, cast(0 AS bigint) AS length FROM files WHERE hour = {EMPTY_HOUR}")
def landing_size_check(spark, sf_dir):
    landed = landing.landed_files(spark, _landing_dir(spark, sf_dir))
    return landing.undersized_files(landed, min_bytes=20).select("filename", "length")


@query(f"""
SELECT filename, CASE WHEN hour NOT IN ({EMPTY_HOUR}, {CUT_HOUR}) THEN lines END AS lines,
       hour NOT IN ({EMPTY_HOUR}, {CUT_HOUR}) AS sound
FROM files""")
def landing_readable(spark, sf_dir):
    """Every landed file, read to its trailer."""
    return landing.file_verdicts(spark, _landing_dir(spark, sf_dir)).select("filename", "lines", "sound")


def _second_delivery(spark, sf_dir) -> str:
    """Hourly files, of which the last day's have been delivered again without clicks, loaded
    after either delivery by a window that has moved on by a day."""
    path, tables = scratch_path(spark, "landing"), Tables(scratch_database(spark, "redelivered"))
    raw = raw_events(spark, sf_dir).drop("filename")
    days = days_of(raw)
    land_hours(raw, path)
    load = lambda first, last: window.load_landed(
        spark, path, tables["raw_events"], DayRange(first, last), min_bytes=1
    )
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {tables.database}")
    load(days[0], days[-1])
    last = F.to_date("created_at") == F.lit(days[-1])
    land_hours(raw.where(last & (F.col("type") != "click")), path)
    load(days[0] + timedelta(days=1), days[-1])
    return tables["raw_events"]


@query("""
, twice AS (
  SELECT *, cast(created_at AS date) AS d,
         strftime(created_at, '%Y-%m-%d') || '-' || hour(created_at) || '.json.gz' AS file
  FROM raw
),
again AS (
  SELECT DISTINCT file FROM twice
  WHERE d = (SELECT max(d) FROM twice) AND event_type <> 'click'
)
SELECT event_id AS id, event_type AS type, repo_name, created_at, file AS filename
FROM twice
WHERE d > (SELECT min(d) FROM twice) AND (event_type <> 'click' OR file NOT IN (SELECT file FROM again))""")
def raw_refresh_redelivered(spark, sf_dir):
    raw = spark.table(_second_delivery(spark, sf_dir))
    return raw.select(
        "id", "type", "repo.name", "created_at", base_name(F.col("filename")).alias("filename")
    ).withColumnRenamed("name", "repo_name")


@query(f"""
SELECT event_id AS id, created_at, CASE WHEN cast(created_at AS date) >= DATE '{END}' THEN filename END AS origin
FROM late_raw""")
def lake_schema_growth(spark, sf_dir):
    """Days loaded one delivery after the other, of which the later ones bring a new column."""
    root, tables = scratch_path(spark, "lake"), Tables(scratch_database(spark, "growth"))
    raw = raw_events(spark, sf_dir, late_copies=True)
    day = F.to_date("created_at")
    days = days_of(raw)
    old, new = [d for d in days if d < END], [d for d in days if d >= END]
    loads.export_days(raw.drop("filename"), root, old, day)
    loads.export_days(raw.withColumnRenamed("filename", "origin"), root, new, day)
    incremental.create_tables(spark, tables)
    for part in (old, new, old):
        incremental.load_raw_days(spark, root, tables, part)
    return spark.table(tables["raw_events"]).select("id", "created_at", "origin")


@query("""
SELECT 'unique_grain(event_id,filename)' AS "check",
       count(*) = count(DISTINCT event_id || filename) AS passed FROM raw
UNION ALL SELECT 'unique_grain(repo_name)', count(*) = count(DISTINCT repo_name) FROM raw
UNION ALL SELECT 'row_count_positive', count(*) > 0 FROM raw
UNION ALL SELECT 'min_positive(org_id)', coalesce(min(org_id) > 0, false) FROM raw WHERE org_id IS NULL
UNION ALL SELECT 'not_null(actor_login)', count(*) FILTER (actor_login IS NULL) = 0 FROM raw
UNION ALL SELECT 'ordered_range(org_id,actor_id)', count(*) = count(CASE WHEN org_id <= actor_id THEN 1 END) FROM raw""")
def quality_checks_failing(spark, sf_dir):
    """Checks on events before deduplication, with and without the joined text."""
    events = staging.flatten_event(raw_events(spark, sf_dir))
    whole = checks.run_checks(events, [
        checks.unique_grain("event_id", "filename", mode="concat"),
        checks.unique_grain("repo_name", mode="concat"),
        checks.row_count_positive(), checks.not_null("actor_login"),
        checks.ordered_range("org_id", "actor_id"),
    ])
    without_org = events.where("org_id IS NULL")
    return whole.unionByName(checks.run_checks(without_org, [checks.min_positive("org_id")]))


@query("""
SELECT file_date, count(files.filename) AS files
FROM hours LEFT JOIN files USING (filename) GROUP BY file_date HAVING count(files.filename) <> 24""")
def landing_count_check(spark, sf_dir):
    return landing.incomplete_days(*_landing(spark, sf_dir))


@query(f"""
SELECT filename FROM files
ANTI JOIN (SELECT filename FROM hours WHERE file_date >= DATE '{START}') USING (filename)""")
def landing_files_outside(spark, sf_dir):
    kept = landing.expected_files(spark, START, END)
    landed = landing.landed_files(spark, _landing_dir(spark, sf_dir))
    return landing.files_outside(kept, landed).select("filename")


@query("""
SELECT string_agg('''lake/raw/' || strftime(d, 'year=%Y/month=%m/day=%d') || '/part-*''', ', '
                  ORDER BY d) AS uri_list
FROM (SELECT unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS d
      FROM stg)""")
def lake_day_list(spark, sf_dir):
    raw = staging.flatten_event(raw_events(spark, sf_dir))
    bounds = raw.agg(
        F.min(F.to_date("created_at")).alias("first"), F.max(F.to_date("created_at")).alias("last")
    )
    days = bounds.select(each_day(F.col("first"), F.col("last")).alias("day"))
    return lake.joined_paths(lake.lake_day_paths(days, "lake/raw"))


# -- checks ----------------------------------------------------------------------------


def _check_sql(table: str, *rules: tuple[str, str]) -> str:
    columns = ", ".join(f"({rule}) AS r{i}" for i, (_, rule) in enumerate(rules))
    rows = "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"check\", r{i} AS passed FROM verdicts"
        for i, (name, _) in enumerate(rules)
    )
    return f", verdicts AS (SELECT {columns} FROM {table})\n{rows}"


def _sql_not_null(*columns):
    return [(f"not_null({c})", f"count(*) FILTER ({c} IS NULL) = 0") for c in columns]


def _sql_positive(*columns):
    return [("row_count_positive", "count(*) > 0")] + [
        (f"min_positive({c})", f"coalesce(min({c}) > 0, false)") for c in columns
    ]


def _sql_grain(*columns):
    joined = " || ".join(columns)
    return [(f"unique_grain({','.join(columns)})", f"count(*) = count(DISTINCT {joined})")]


SQL_ORDERED = [(
    "ordered_range(first_activity,last_activity)",
    "count(*) = count(CASE WHEN first_activity <= last_activity THEN 1 END)",
)]


@query(_check_sql("raw", ("row_count_positive", "count(*) > 0"),
                  ("complete(created_at)", "count(*) = count(created_at)")))
def quality_checks_raw(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    return checks.run_checks(raw, checks.WINDOW_CHECKS["raw_events"])


@query(_check_sql("stg", *_sql_not_null("event_id", "event_type", "created_at"),
                  ("unique_key(event_id)", "count(*) = count(DISTINCT event_id)")))
def quality_checks_staging(spark, sf_dir):
    staged = staging.stage_events(raw_events(spark, sf_dir))
    return checks.run_checks(staged, checks.WINDOW_CHECKS["stg_events"])


@query(_check_sql("selected", *_sql_not_null("event_id", "repo_name", "created_at"),
                  ("row_count_positive", "count(*) > 0")))
def quality_checks_selected(spark, sf_dir):
    events = selected_events(spark, sf_dir)
    return checks.run_checks(events, checks.WINDOW_CHECKS["stg_selected_events"])


@query(_check_sql("daily", *_sql_not_null("repo_name", "event_date"),
                  *_sql_positive("total_events", "unique_actors"),
                  *_sql_grain("repo_name", "event_date")))
def quality_checks_daily(spark, sf_dir):
    daily = marts.daily_activity(selected_events(spark, sf_dir, columns=ACTOR))
    return checks.run_checks(daily, checks.WINDOW_CHECKS["mart_repo_daily_activity"])


@query(_check_sql("by_type", *_sql_not_null("repo_name", "event_date", "event_type"),
                  *_sql_positive("total_events", "unique_actors"),
                  *_sql_grain("repo_name", "event_date", "event_type")))
def quality_checks_event_type(spark, sf_dir):
    by_type = marts.daily_event_type_activity(selected_events(spark, sf_dir, columns=ACTOR_TYPE))
    return checks.run_checks(
        by_type, checks.WINDOW_CHECKS["mart_repo_daily_event_type_activity"]
    )


@query(_check_sql("by_actor", *_sql_not_null("repo_name", "actor_login"),
                  *_sql_positive("total_events"), *SQL_ORDERED,
                  *_sql_grain("repo_name", "actor_login")))
def quality_checks_actor(spark, sf_dir):
    by_actor = marts.actor_activity(selected_events(spark, sf_dir, columns=ACTOR_TYPE))
    return checks.run_checks(by_actor, checks.WINDOW_CHECKS["mart_repo_actor_activity"])


@query(_check_sql("summary", *_sql_not_null("repo_name"),
                  *_sql_positive("total_events", "unique_actors", "active_days"),
                  *SQL_ORDERED, *_sql_grain("repo_name")))
def quality_checks_summary(spark, sf_dir):
    summary = marts.repo_summary(selected_events(spark, sf_dir, columns=ACTOR))
    return checks.run_checks(summary, checks.WINDOW_CHECKS["mart_repo_summary"])


def _day_check_sql(*rules: tuple[str, str]) -> str:
    columns = ", ".join(f"({rule}) AS r{i}" for i, (_, rule) in enumerate(rules))
    rows = "\nUNION ALL ".join(
        f"SELECT event_date, '{name}' AS \"check\", r{i} AS passed FROM verdicts"
        for i, (name, _) in enumerate(rules)
    )
    return (
        f", verdicts AS (SELECT event_date, {columns} FROM daily"
        f" WHERE {IN_RANGE} GROUP BY event_date)\n{rows}"
    )


@query(_day_check_sql(*_sql_positive("total_events", "unique_actors"),
                      *_sql_grain("repo_name", "event_date")))
def quality_checks_by_day(spark, sf_dir):
    daily = marts.daily_activity(selected_events(spark, sf_dir, START, ACTOR))
    return checks.run_checks_by_day(
        daily, checks.DAY_CHECKS["mart_repo_daily_activity"], DayRange(START, END).days
    )
