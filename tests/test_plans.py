"""The physical plans are the ones the design counts on."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest

import __spark_entry__ as contract
from forgepulse import schemas
from forgepulse.operators import marts, serving, staging
from forgepulse.session import settings
from forgepulse.sinks import loads
from forgepulse.sources import landing
from forgepulse.sources.ndjson import scan_ndjson
from tests.builders import event, land, raw_frame
from workload.feed import END, START, raw_events
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")

# Dozens of jobs each; they are made of the operators of the other queries.
PIPELINES = {
    "window_run", "incremental_run", "incremental_actor_activity", "incremental_summary",
    "served_kpis", "served_event_types", "served_top_contributors", "raw_refresh_redelivered",
    # Reads gzip trailers, which no built-in function can.
    "landing_readable",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, operator):
    return sum(operator in line for line in text.splitlines())


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES.keys() - PIPELINES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for operator in (
        "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
        "BroadcastNestedLoopJoin",
    ):
        assert operator not in text


@needs_data
def test_copies_are_dropped_before_the_shuffle(spark):
    text = plan(staging.stage_events(raw_events(spark, SF_DIR)))
    assert count(text, "WindowGroupLimit") == 2
    assert count(text, "Exchange") == 1
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert "payload" not in text.split("Exchange")[0]


@needs_data
def test_a_window_reads_its_days_and_columns_only(spark):
    events = staging.stage_events(raw_events(spark, SF_DIR), START, ["actor_login", "repo_name"])
    text = plan(serving.kpis(events, START, END))
    assert f"GreaterThanOrEqual(ts,{START}" in text
    assert "event_type" not in text


def test_flat_columns_read_single_fields(spark, database):
    raw_frame(spark, [event(1, "2026-03-01T00:00:00Z")]).write.saveAsTable(f"{database}.raw")
    events = staging.flatten_event(spark.table(f"{database}.raw"))
    schema = plan(events.select("actor_login")).split("ReadSchema: ")[1]
    assert schema.startswith("struct<actor:struct<login:string>>")


def test_repository_list_and_day_reach_the_scan(spark, database):
    table = f"{database}.stg"
    loads.create_if_absent(spark, table, schemas.STAGING)
    day = date(2026, 3, 1)
    names = [f"o/{i}" for i in range(15)]
    text = plan(staging.select_repos(staging.on_day(spark.table(table), day), names))
    assert "PushedFilters: [In(repo_name" in text
    assert "event_date" in text.split("PartitionFilters: [")[1].split("]")[0]


@needs_data
def test_top_five_needs_no_full_sort(spark):
    for name in ("top_repos", "top_contributors", "top_contributors_in_range"):
        assert "TakeOrderedAndProject(limit=5" in plan(contract.queries()[name](spark, SF_DIR))


@needs_data
def test_distinct_counts_shuffle_by_group_and_value(spark):
    events = staging.flatten_event(raw_events(spark, SF_DIR))
    text = plan(marts.daily_activity(events))
    spread = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert len(spread) == 2
    assert "repo_name" in spread[1] and "actor_login" in spread[1]
    assert "partial_count" in text.split("hashpartitioning")[-1]


def test_raw_rows_are_written_where_they_were_read(spark, database, tmp_path):
    land(tmp_path, "2026-03-01-0.json.gz", [event(1, "2026-03-01T00:00:00Z")])
    scan_ndjson(spark, str(tmp_path)).createOrReplaceTempView("landed")
    table = f"{database}.raw"
    loads.create_like(spark.table("landed"), table, "file_date")
    insert = f"EXPLAIN INSERT OVERWRITE {table} SELECT * FROM landed"
    with settings(spark, loads._in_place()):
        text = spark.sql(insert).first()[0]
    assert "Sort" not in text and "Exchange" not in text


def test_clustered_rows_are_sorted_once(spark, database):
    table = f"{database}.daily"
    loads.create_if_absent(spark, table, schemas.DAILY_ACTIVITY)
    rows = spark.createDataFrame([("a", date(2026, 3, 1), 1, 1)], schemas.DAILY_ACTIVITY)
    loads.clustered(rows, ["repo_name"]).createOrReplaceTempView("new_rows")
    text = spark.sql(
        f"EXPLAIN INSERT OVERWRITE {table} "
        "SELECT repo_name, total_events, unique_actors, event_date FROM new_rows"
    ).first()[0]
    assert count(text, "Sort [") == 1 and "REBALANCE_PARTITIONS_BY_COL" in text


def test_a_merge_shuffles_both_sides_once(spark):
    rows = spark.createDataFrame([("a", date(2026, 3, 1), 1, 1)], schemas.DAILY_ACTIVITY)
    text = plan(loads.merged(rows, rows, marts.DAILY_KEYS))
    assert count(text, "Exchange") == 1 and "Join" not in text


def test_listing_files_does_not_read_them(spark, tmp_path):
    land(tmp_path, "2026-03-01-0.json.gz", [])
    text = plan(landing.landed_files(spark, str(tmp_path)))
    read = text.split("ReadSchema: ")[1].splitlines()[0]
    assert read == "struct<path:string,modificationTime:timestamp,length:bigint>"
    assert "content" not in read
