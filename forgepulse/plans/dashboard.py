"""The dashboard's reads, bound to the tables of one back end."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from forgepulse.config import LOOKBACK_DAYS, DayRange, Tables
from forgepulse.operators import serving
from forgepulse.operators.staging import ALL_REPOS
from forgepulse.sinks.loads import partition_days


@dataclass(frozen=True)
class Dashboard:
    """Each method is one tile; results are small and meant for `toPandas()`.

    The staging tables are partitioned by day, so a date range reads only its days.
    """

    spark: SparkSession
    tables: Tables

    def _table(self, name: str) -> DataFrame:
        return self.spark.table(self.tables[name])

    def repo_options(self) -> DataFrame:
        """The choices of the repository filter; `ALL_REPOS` comes before them."""
        return serving.repo_options(self._table("mart_repo_summary"))

    def last_loaded_date(self) -> date | None:
        """The last day of the staging table, from its partitions: no file is opened."""
        days = partition_days(self.spark, self.tables["stg_events"])
        return max((d for d in days if d is not None), default=None)

    def window(self, days: int = LOOKBACK_DAYS) -> DayRange | None:
        """The last loaded day and those before it, or None before the first load."""
        last = self.last_loaded_date()
        return None if last is None else DayRange.ending(last, days)

    def active_repo_count(self, window: DayRange) -> DataFrame:
        selected = self._table("stg_selected_events")
        return serving.active_repo_count(selected, window.start, window.end)

    def kpis(self, window: DayRange, repo: str | None = None) -> DataFrame:
        selected = self._table("stg_selected_events")
        return serving.kpis(selected, window.start, window.end, repo)

    def activity_over_time(self, window: DayRange, repo: str | None = None) -> DataFrame:
        selected = self._table("stg_selected_events")
        return serving.activity_over_time(selected, window.start, window.end, repo)

    def activity_chart(
        self, window: DayRange, metric: str = "total_events", repo: str | None = None
    ) -> DataFrame:
        selected = self._table("stg_selected_events")
        return serving.activity_zero_filled(selected, window.start, window.end, metric, repo)

    def event_type_distribution(self, window: DayRange, repo: str | None = None) -> DataFrame:
        by_type = self._table("mart_repo_daily_event_type_activity")
        return serving.event_type_distribution(by_type, window.start, window.end, repo)

    def top_entities(self, window: DayRange, repo: str | None = None) -> DataFrame:
        chosen = None if repo == ALL_REPOS else repo
        top = serving.top_entities(
            self._table("mart_repo_summary"), self._table("stg_selected_events"),
            window.start, window.end, chosen,
        )
        return serving.with_labels(top, are_repos=not chosen)

    def top_repos(self) -> DataFrame:
        return serving.top_repos(self._table("mart_repo_summary"))

    def top_contributors(self, repo: str) -> DataFrame:
        return serving.top_contributors(self._table("mart_repo_actor_activity"), repo)
