from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from forgepulse import schemas
from forgepulse.operators.marts import DAILY_KEYS, DAILY_TYPE_KEYS
from forgepulse.sinks import loads
from tests.builders import values

DAY1, DAY2, DAY3 = date(2026, 3, 1), date(2026, 3, 2), date(2026, 3, 3)


@pytest.fixture
def daily(spark, database):
    table = f"{database}.daily"
    loads.create_if_absent(spark, table, schemas.DAILY_ACTIVITY)
    return table


@pytest.fixture
def by_type(spark, database):
    table = f"{database}.by_type"
    loads.create_if_absent(spark, table, schemas.DAILY_EVENT_TYPE_ACTIVITY)
    return table


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.DAILY_ACTIVITY)


def type_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.DAILY_EVENT_TYPE_ACTIVITY)


def location(spark, table):
    return Path(
        spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'")
        .first().data_type.removeprefix("file:")
    )


def test_create_if_absent_keeps_what_is_there(spark, daily):
    loads.replace_days(frame(spark, [("a", DAY1, 1, 1)]), daily, [DAY1])
    loads.create_if_absent(spark, daily, schemas.DAILY_ACTIVITY)
    assert spark.table(daily).count() == 1


def test_create_like_copies_the_schema_only(spark, database):
    source = frame(spark, [("a", DAY1, 1, 1)]).withColumn("more", F.struct(F.lit(1).alias("x")))
    table = f"{database}.copy"
    loads.create_like(source, table)
    assert spark.table(table).count() == 0
    assert set(spark.table(table).columns) == set(source.columns)
    loads.replace_days(source, table, [DAY1])
    loads.create_like(source, table)
    assert values(spark.table(table), "more.x") == [(1,)]


def test_replace_days_touches_only_its_days(spark, daily):
    loads.replace_days(frame(spark, [("a", DAY1, 1, 1), ("b", DAY2, 2, 2)]), daily, [DAY1, DAY2])
    new = frame(spark, [("c", DAY2, 3, 3), ("d", DAY3, 4, 4)])
    for _ in range(2):
        assert loads.replace_days(new, daily, [DAY2]) == [DAY2]
        assert values(spark.table(daily), *new.columns) == [
            ("a", DAY1, 1, 1), ("c", DAY2, 3, 3),
        ]


def test_an_empty_day_is_an_error_or_drops_the_partition(spark, daily):
    loads.replace_days(frame(spark, [("a", DAY1, 1, 1), ("b", DAY2, 2, 2)]), daily, [DAY1, DAY2])
    nothing = frame(spark, [])
    with pytest.raises(loads.EmptyDay, match="2026-03-02"):
        loads.replace_days(nothing, daily, [DAY2])
    assert spark.table(daily).count() == 2
    assert loads.replace_days(nothing, daily, [DAY2], allow_empty=True) == []
    assert loads.partition_days(spark, daily) == [DAY1]


def test_many_days_are_replaced_in_parts(spark, daily):
    days = [date(2026, 1, 1) + (DAY2 - DAY1) * i for i in range(70)]
    new = frame(spark, [("a", d, i, i) for i, d in enumerate(days)])
    assert loads.replace_days(new, daily, days) == days
    assert spark.table(daily).count() == 70


def test_columns_are_matched_by_name(spark, daily):
    swapped = frame(spark, [("a", DAY1, 7, 1)]).select(
        "unique_actors", "event_date", "total_events", "repo_name"
    )
    loads.replace_days(swapped, daily, [DAY1])
    assert values(spark.table(daily), "repo_name", "total_events") == [("a", 7)]


def test_upsert_updates_inserts_and_keeps(spark, daily):
    loads.replace_days(
        frame(spark, [("same", DAY1, 1, 1), ("gone", DAY1, 2, 2), ("other", DAY2, 3, 3)]),
        daily, [DAY1, DAY2],
    )
    new = frame(spark, [("same", DAY1, 10, 5), ("new", DAY1, 4, 4)])
    for _ in range(2):
        loads.upsert_days(new, daily, DAILY_KEYS, [DAY1])
        assert values(spark.table(daily), *new.columns) == [
            ("gone", DAY1, 2, 2), ("new", DAY1, 4, 4), ("other", DAY2, 3, 3),
            ("same", DAY1, 10, 5),
        ]
    loads.replace_days(new, daily, [DAY1])
    assert "gone" not in [row[0] for row in values(spark.table(daily), "repo_name")]


def test_upsert_with_nothing_new_changes_nothing(spark, daily):
    loads.upsert_days(frame(spark, []), daily, DAILY_KEYS, [DAY1])
    loads.replace_days(frame(spark, [("a", DAY1, 1, 1)]), daily, [DAY1])
    loads.upsert_days(frame(spark, []), daily, DAILY_KEYS, [DAY1])
    assert spark.table(daily).count() == 1


def test_null_keys_match_unless_told_otherwise(spark, by_type):
    first = type_frame(spark, [("a", DAY1, None, 1, 1), ("a", DAY1, "Push", 1, 1)])
    again = type_frame(spark, [("a", DAY1, None, 2, 2), ("a", DAY1, "Push", 2, 2)])
    loads.upsert_days(first, by_type, DAILY_TYPE_KEYS, [DAY1])
    loads.upsert_days(again, by_type, DAILY_TYPE_KEYS, [DAY1])
    assert values(spark.table(by_type), "event_type", "total_events") == [("Push", 2), (None, 2)]
    loads.upsert_days(again, by_type, DAILY_TYPE_KEYS, [DAY1], nulls_match=False)
    assert values(spark.table(by_type), "event_type", "total_events") == [
        ("Push", 2), (None, 2), (None, 2),
    ]


def test_retention_drops_days_outside(spark, daily):
    loads.replace_days(
        frame(spark, [("a", d, 1, 1) for d in (DAY1, DAY2, DAY3)]), daily, [DAY1, DAY2, DAY3]
    )
    assert loads.retain_days(spark, daily, DAY2, DAY2) == [DAY1, DAY3]
    assert loads.partition_days(spark, daily) == [DAY2]
    assert not (location(spark, daily) / f"event_date={DAY1}").exists()


def test_full_rebuild_leaves_nothing_behind(spark, database):
    table = f"{database}.full"
    loads.full_rebuild(frame(spark, [("a", DAY1, 1, 1)]), table, loads.DAY, ["repo_name"])
    loads.full_rebuild(frame(spark, [("b", DAY2, 1, 1)]), table, loads.DAY, ["repo_name"])
    assert values(spark.table(table), "repo_name", "event_date") == [("b", DAY2)]
    loads.full_rebuild(frame(spark, []), table, loads.DAY, ["repo_name"])
    assert spark.table(table).count() == 0


def test_a_hot_repository_is_spread_over_sorted_files(spark, database, monkeypatch):
    """A third of one day's rows in one repository does not end up in one file."""
    table = f"{database}.hot"
    repo = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 997))
    rows = spark.range(0, 600_000, 1, 12).select(
        repo.alias("repo_name"), F.lit(DAY1).alias("event_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    monkeypatch.setattr(loads, "WRITE_BYTES", "4m")
    loads.full_rebuild(rows, table, loads.DAY, ["repo_name"])
    files = list(location(spark, table).rglob("*.parquet"))
    sizes = [pq.read_metadata(f).num_rows for f in files]
    assert sum(sizes) == 600_000 and max(sizes) < 120_000
    for file in files:
        names = pq.read_table(file, columns=["repo_name"], partitioning=None)["repo_name"]
        assert names.to_pylist() == sorted(names.to_pylist())
