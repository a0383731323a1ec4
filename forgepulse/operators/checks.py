"""Data-quality checks: all checks of a table in one aggregation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.functions.columns import event_day


class CheckFailed(RuntimeError):
    """A loaded table broke at least one of its checks."""


@dataclass(frozen=True)
class Check:
    name: str
    rule: Callable[[], Column]
    on_empty: bool  # the verdict on a table, or a day, without rows


def row_count_positive() -> Check:
    return Check("row_count_positive", lambda: F.count("*") > 0, False)


def complete(column: str) -> Check:
    return Check(f"complete({column})", lambda: F.count("*") == F.count(column), True)


def not_null(column: str) -> Check:
    return Check(f"not_null({column})", lambda: F.count_if(F.col(column).isNull()) == 0, True)


def min_positive(column: str) -> Check:
    """Also fails when the column has no value at all."""
    return Check(f"min_positive({column})", lambda: F.min(column) > 0, False)


def ordered_range(low: str, high: str) -> Check:
    def rule() -> Column:
        return F.count("*") == F.count(F.when(F.col(low) <= F.col(high), 1))

    return Check(f"ordered_range({low},{high})", rule, True)


def unique_key(column: str) -> Check:
    return Check(
        f"unique_key({column})", lambda: F.count("*") == F.count_distinct(column), True
    )


def unique_grain(*columns: str, mode: str = "struct") -> Check:
    """One row per combination of the columns, none of them null.

    `mode="concat"` compares the joined text instead, which takes ('ab', 'c') and
    ('a', 'bc') for the same key.
    """
    def joined() -> Column:
        text = F.concat(*(F.col(c).cast("string") for c in columns))
        return F.count("*") == F.count_distinct(text)

    def exact() -> Column:
        any_null = reduce(Column.__or__, (F.col(c).isNull() for c in columns))
        distinct = F.count("*") == F.count_distinct(F.struct(*columns))
        return distinct & (F.count_if(any_null) == 0)

    rules = {"struct": exact, "concat": joined}
    return Check(f"unique_grain({','.join(columns)})", rules[mode], True)


def _measures(*columns: str) -> list[Check]:
    return [row_count_positive(), *map(min_positive, columns)]


WINDOW_CHECKS = {
    "raw_events": [row_count_positive(), complete("created_at")],
    "stg_events": [*map(not_null, ("event_id", "event_type", "created_at")), unique_key("event_id")],
    "stg_selected_events": [
        *map(not_null, ("event_id", "repo_name", "created_at")), row_count_positive(),
    ],
    "mart_repo_daily_activity": [
        *map(not_null, ("repo_name", "event_date")),
        *_measures("total_events", "unique_actors"),
        unique_grain("repo_name", "event_date"),
    ],
    "mart_repo_daily_event_type_activity": [
        *map(not_null, ("repo_name", "event_date", "event_type")),
        *_measures("total_events", "unique_actors"),
        unique_grain("repo_name", "event_date", "event_type"),
    ],
    "mart_repo_actor_activity": [
        *map(not_null, ("repo_name", "actor_login")),
        *_measures("total_events"),
        ordered_range("first_activity", "last_activity"),
        unique_grain("repo_name", "actor_login"),
    ],
    "mart_repo_summary": [
        not_null("repo_name"),
        *_measures("total_events", "unique_actors", "active_days"),
        ordered_range("first_activity", "last_activity"),
        unique_grain("repo_name"),
    ],
}

# Incremental runs check the loaded days of the tables they load by day, and the
# whole of the two marts they rebuild.
DAY_CHECKS = {
    "stg_events": [unique_key("event_id")],
    "stg_selected_events": [row_count_positive()],
    "mart_repo_daily_activity": [
        *_measures("total_events", "unique_actors"), unique_grain("repo_name", "event_date"),
    ],
    "mart_repo_daily_event_type_activity": [
        *_measures("total_events", "unique_actors"),
        unique_grain("repo_name", "event_date", "event_type"),
    ],
}

REBUILD_CHECKS = {
    "mart_repo_actor_activity": [
        *_measures("total_events"),
        ordered_range("first_activity", "last_activity"),
        unique_grain("repo_name", "actor_login"),
    ],
    "mart_repo_summary": [row_count_positive(), unique_grain("repo_name")],
}


def _verdicts(checks: Sequence[Check]) -> list[Column]:
    return [
        F.coalesce(c.rule(), F.lit(c.on_empty)).alias(f"_{i}") for i, c in enumerate(checks)
    ]


def _as_rows(wide: DataFrame, checks: Sequence[Check], keep: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(
        *(
            F.struct(
                F.lit(c.name).alias("check"),
                F.coalesce(F.col(f"_{i}"), F.lit(c.on_empty)).alias("passed"),
            )
            for i, c in enumerate(checks)
        )
    )
    return wide.select(*keep, F.inline(pairs))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row (check, passed) per check over the whole input."""
    return _as_rows(df.agg(*_verdicts(checks)), checks)


def run_checks_by_day(df: DataFrame, checks: Sequence[Check], days: Sequence[date]) -> DataFrame:
    """One row (event_date, check, passed) per check and day; a day may have no rows.

    The checked side has one row per listed day at most, which bounds the broadcast.
    """
    day = event_day(df)
    per_day = (
        df.where(day.isin(list(days))).groupBy(day.alias("event_date")).agg(*_verdicts(checks))
    )
    listed = df.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.array(*map(F.lit, days))).alias("event_date")
    )
    wide = listed.join(F.broadcast(per_day), "event_date", "left")
    return _as_rows(wide, checks, ["event_date"])


def require(results: DataFrame, table: str) -> None:
    """Raise if any check failed. There is one row per check (and day) to fetch."""
    failed = results.where(~F.col("passed")).collect()
    if failed:
        listed = ", ".join(" ".join(str(v) for v in row[:-1]) for row in failed)
        raise CheckFailed(f"{table}: {listed}")
