"""Hourly files as written, delivered again, and read back."""

from datetime import date

import pytest

from forgepulse.config import DayRange, Tables
from forgepulse.operators import marts
from forgepulse.plans import incremental, window
from forgepulse.sinks import loads
from forgepulse.sinks.hourly import land_hours
from forgepulse.sources import landing, ndjson
from tests.builders import event, raw_frame, values
from tests.test_plans import plan

DAY1, DAY2 = date(2026, 3, 1), date(2026, 3, 2)


def events(day, *hours, type="PushEvent"):
    return [event(f"{day}-{h}-{type}", f"{day}T{h:02d}:10:00Z", type=type) for h in hours]


def test_an_hour_is_one_file(spark, tmp_path):
    raw = raw_frame(spark, events(DAY1, 0, 7, 7, 23) + events(DAY2, 7)).repartition(4)
    names = land_hours(raw, str(tmp_path))
    assert names == [f"{DAY1}-0.json.gz", f"{DAY1}-23.json.gz", f"{DAY1}-7.json.gz", f"{DAY2}-7.json.gz"]
    assert sorted(p.name for p in tmp_path.glob("*.gz")) == names
    assert not list(tmp_path.glob("_landing*"))
    read = ndjson.scan_ndjson(spark, str(tmp_path))
    assert values(read, "id", "created_at") == values(raw, "id", "created_at")
    verdicts = landing.file_verdicts(spark, str(tmp_path))
    assert sorted(r.lines for r in verdicts.collect()) == [1, 1, 1, 2]


def test_a_failed_write_leaves_the_landing_zone(spark, tmp_path):
    land_hours(raw_frame(spark, events(DAY1, 5)), str(tmp_path))
    with pytest.raises(Exception, match="no time"):
        land_hours(raw_frame(spark, [event(9, None)]), str(tmp_path))
    assert [p.name for p in tmp_path.glob("*.gz")] == [f"{DAY1}-5.json.gz"]


def test_a_second_delivery_replaces_the_hours_it_has(spark, database, tmp_path):
    table = Tables(database)["raw_events"]
    load = lambda days: window.load_landed(spark, str(tmp_path), table, days, min_bytes=1)
    land_hours(raw_frame(spark, events(DAY1, 5) + events(DAY2, 6, 7)), str(tmp_path))
    load(DayRange(DAY1, DAY2))
    land_hours(raw_frame(spark, events(DAY2, 6, type="ForkEvent")), str(tmp_path))
    load(DayRange(DAY2, DAY2))
    assert values(spark.table(table), "id") == [(f"{DAY2}-6-ForkEvent",), (f"{DAY2}-7-PushEvent",)]


def test_marts_over_all_days_read_the_loaded_days_and_the_state(spark, database, tmp_path):
    root, tables = str(tmp_path / "lake"), Tables(database)
    for day, hours in ((DAY1, (5, 6)), (DAY2, (7,))):
        loads.export_days(raw_frame(spark, events(day, *hours)), root, [day])
        incremental.run_days(spark, root, tables, [day])
    loads.export_days(raw_frame(spark, events(DAY1, 5, type="ForkEvent")), root, [DAY1])
    incremental.run_days(spark, root, tables, [DAY1])
    selected = spark.table(tables["stg_selected_events"])
    columns = ["repo_name", "actor_login", "total_events", "event_types_count", "first_activity", "last_activity"]
    built = values(spark.table(tables["mart_repo_actor_activity"]), *columns)
    assert built == values(marts.actor_activity(selected), *columns) and built[0][2:4] == (2, 2)
    summary = spark.table(tables["mart_repo_summary"])
    assert values(summary, *summary.columns) == values(marts.repo_summary_by_type(selected), *summary.columns)
    # The state is by day, so a load reads one day of the events; the marts read no event.
    text = plan(marts.activity_state(selected.where(selected[loads.DAY] == DAY1)))
    assert "PartitionFilters: [isnotnull(event_date" in text and "2026-03-01" in text
    assert "stg_selected_events" not in plan(marts.actor_activity_of(spark.table(tables["activity_state"])))


def test_state_of_days_loaded_before_it_was_kept(spark, database, tmp_path):
    root, tables = str(tmp_path / "lake"), Tables(database)
    for day in (DAY1, DAY2):
        loads.export_days(raw_frame(spark, events(day, 5)), root, [day])
    incremental.run_days(spark, root, tables, [DAY1])
    spark.sql(f"DROP TABLE {tables['activity_state']}")
    incremental.run_days(spark, root, tables, [DAY2])
    assert spark.table(tables["mart_repo_summary"]).first().total_events == 2
