"""Run parameters: days, windows, the repository list and table names."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

LOOKBACK_DAYS = 7
HOURS_PER_DAY = 24
MIN_FILE_BYTES = 1_000_000

# The repositories that the selected tables and marts cover.
SELECTED_REPOS = (
    "apache/airflow",
    "ClickHouse/ClickHouse",
    "metabase/metabase",
    "apache/superset",
    "airbytehq/airbyte",
    "apache/spark",
    "trinodb/trino",
    "duckdb/duckdb",
    "dbt-labs/dbt-core",
    "dagster-io/dagster",
    "PrefectHQ/prefect",
    "apache/flink",
    "DataTalksClub/data-engineering-zoomcamp",
    "kestra-io/kestra",
    "bruin-data/bruin",
)

TABLES = (
    "raw_events",
    "stg_events",
    "stg_selected_events",
    "activity_state",
    "mart_repo_daily_activity",
    "mart_repo_daily_event_type_activity",
    "mart_repo_actor_activity",
    "mart_repo_summary",
)


def parse_day(value: str | date) -> date:
    """A day, or the day part of an ISO timestamp."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value.partition("T")[0])


def utc_yesterday(today: date | None = None) -> date:
    return (today or datetime.now(timezone.utc).date()) - timedelta(days=1)


def target_day(execution_date: str | date | None = None) -> date:
    """The day an incremental run loads: the one before its execution date."""
    if execution_date:
        return parse_day(execution_date) - timedelta(days=1)
    return utc_yesterday()


def days_in(start: date, end: date) -> list[date]:
    """Every day of the closed range; empty when it is reversed."""
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


@dataclass(frozen=True)
class DayRange:
    """A closed range of UTC days."""

    start: date
    end: date

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"range starts {self.start}, after its end {self.end}")

    @property
    def days(self) -> list[date]:
        return days_in(self.start, self.end)

    @classmethod
    def ending(cls, end: str | date, length: int | str = LOOKBACK_DAYS) -> DayRange:
        """The range of so many days whose last is `end`; a length below 1 is no range."""
        last = parse_day(end)
        return cls(last + timedelta(days=1 - int(str(length))), last)


def rolling_window(end: str | date | None = None, lookback_days: int | str = LOOKBACK_DAYS) -> DayRange:
    """The days a window run covers; it ends yesterday (UTC) unless told otherwise."""
    return DayRange.ending(end or utc_yesterday(), lookback_days)


@dataclass(frozen=True)
class Tables:
    """Where the logical tables of one back end live in the Spark catalog."""

    database: str

    def __getitem__(self, name: str) -> str:
        if name not in TABLES:
            raise KeyError(f"unknown table {name!r}; known: {', '.join(TABLES)}")
        return f"{self.database}.{name}"
