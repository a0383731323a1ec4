import logging
from datetime import date

import pytest
from pyspark.sql import functions as F

from forgepulse.__main__ import main
from forgepulse.config import DayRange, Tables
from forgepulse.operators import staging
from forgepulse.operators.checks import CheckFailed
from forgepulse.plans import incremental, window
from forgepulse.plans.dashboard import Dashboard
from forgepulse.session import scratch_database
from forgepulse.sinks import loads
from forgepulse.sources import landing
from tests.builders import event, land, raw_frame, values

DAY1, DAY2, DAY3 = (date(2026, 3, d) for d in (1, 2, 3))
DAYS = [DAY1, DAY2, DAY3]
REPOS = ["apache/spark", "apache/flink"]
MARTS = [
    "mart_repo_daily_activity", "mart_repo_daily_event_type_activity",
    "mart_repo_actor_activity", "mart_repo_summary",
]


def day_events(day, extra=()):
    return [
        event(f"{day}-{i}", f"{day}T{i:02d}:30:00Z", repo, actor, type)
        for i, (repo, actor, type) in enumerate([
            ("apache/spark", "ann", "PushEvent"), ("apache/spark", "bob", "IssuesEvent"),
            ("apache/flink", "ann", "PushEvent"), ("other/tool", "cid", "PushEvent"),
            ("apache/spark", "ann", "PushEvent"),
        ])
    ] + list(extra)


def dump(spark, tables, names=MARTS):
    return {n: values(spark.table(tables[n]), *sorted(spark.table(tables[n]).columns)) for n in names}


@pytest.fixture
def landed(tmp_path):
    directory = tmp_path / "landing"
    for day in DAYS:
        rows = day_events(day)
        for hour in (3, 9):
            # The first event of the day is delivered in both files.
            part = rows[:3] if hour == 3 else rows[:1] + rows[3:]
            land(directory, f"{day}-{hour}.json.gz", part)
    return directory


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = [e for day in DAYS for e in day_events(day) + day_events(day)[:2]]
    loads.export_days(raw_frame(spark, rows), root, DAYS, F.to_date("created_at"))
    return root


def run_window(spark, landed, tables, days=DayRange(DAY1, DAY3)):
    window.run_window(spark, str(landed), tables, days, REPOS, min_bytes=10)


def test_window_run(spark, database, landed, caplog):
    tables = Tables(database)
    with caplog.at_level(logging.WARNING):
        run_window(spark, landed, tables)
    assert "hours not landed beyond these: 56" in caplog.text
    assert spark.table(tables["raw_events"]).count() == 18
    assert spark.table(tables["stg_events"]).count() == 15
    first = spark.table(tables["stg_events"]).where(f"event_id = '{DAY1}-0'").first()
    assert first.filename.endswith(f"{DAY1}-9.json.gz")
    assert spark.table(tables["stg_selected_events"]).count() == 12
    assert values(spark.table(tables["mart_repo_summary"]), "repo_name", "total_events",
                  "unique_actors", "active_days") == [
        ("apache/flink", 3, 1, 3), ("apache/spark", 9, 2, 3),
    ]
    before = dump(spark, tables)
    run_window(spark, landed, tables)
    assert dump(spark, tables) == before


def test_window_moves_and_parses_only_changed_days(spark, database, landed, monkeypatch):
    tables = Tables(database)
    run_window(spark, landed, tables, DayRange(DAY1, DAY2))
    parsed = []
    scan = window.SCANS["variant"]

    def recorded(spark, path, days):
        parsed.append(list(days))
        return scan(spark, path, days)

    monkeypatch.setitem(window.SCANS, "variant", recorded)
    run_window(spark, landed, tables, DayRange(DAY2, DAY3))
    assert parsed == [[DAY3]]
    assert sorted(loads.partition_days(spark, tables["raw_events"])) == [DAY2, DAY3]
    land(landed, f"{DAY2}-12.json.gz", [event("late", f"{DAY2}T12:00:00Z", actor="eve")])
    (landed / f"{DAY3}-9.json.gz").unlink()
    run_window(spark, landed, tables, DayRange(DAY2, DAY3))
    assert parsed[1:] == [[DAY2, DAY3]]

    other = Tables(scratch_database(spark, "test"))
    run_window(spark, landed, other, DayRange(DAY2, DAY3))
    assert dump(spark, tables) == dump(spark, other)


@pytest.mark.parametrize("scan", ["variant", "inferred"])
def test_other_scans_keep_more_fields(spark, database, tmp_path, scan):
    tables = Tables(database)
    land(tmp_path, f"{DAY1}-0.json.gz", day_events(DAY1) + [
        event("more", f"{DAY1}T01:00:00Z", payload={"x": 1, "X": 2}, extra={"deep": True}),
    ])
    window.run_window(
        spark, str(tmp_path), tables, DayRange(DAY1, DAY1), REPOS, min_bytes=10, scan=scan
    )
    raw = spark.table(tables["raw_events"]).where("id = 'more'")
    deep = "body:extra.deep::boolean" if scan == "variant" else "extra.deep"
    assert values(raw, F.expr(deep), F.get_json_object("payload", "$.X")) == [(True, "2")]
    assert spark.table(tables["stg_selected_events"]).count() == 5


def test_a_failed_check_stops_before_the_next_table(spark, database, tmp_path):
    tables = Tables(database)
    land(tmp_path, f"{DAY1}-0.json.gz", [event(1, f"{DAY1}T00:00:00Z", type=None)])
    with pytest.raises(CheckFailed, match=r"stg_events: not_null\(event_type\)"):
        run_window(spark, tmp_path, tables, DayRange(DAY1, DAY1))
    assert not spark.catalog.tableExists(tables["stg_selected_events"])


def test_small_files_stop_the_run(spark, database, landed):
    with pytest.raises(landing.LandingError, match="too small"):
        window.run_window(spark, str(landed), Tables(database), DayRange(DAY1, DAY3), REPOS)


def test_any_order_of_days_gives_the_same_tables(spark, lake):
    together, single = (Tables(scratch_database(spark, "test")) for _ in range(2))
    incremental.run_days(spark, lake, together, DAYS, REPOS)
    for day in (DAY3, DAY1, DAY2):
        incremental.run_days(spark, lake, single, [day], REPOS)
    names = ["stg_events", "stg_selected_events", *MARTS]
    assert dump(spark, together, names) == dump(spark, single, names)
    assert spark.table(together["raw_events"]).count() == 21
    assert spark.table(together["stg_events"]).count() == 15


def test_both_modes_agree(spark, landed, lake):
    by_window, by_day = (Tables(scratch_database(spark, "test")) for _ in range(2))
    run_window(spark, landed, by_window)
    incremental.run_days(spark, lake, by_day, DAYS, REPOS)
    assert dump(spark, by_window, MARTS[:3]) == dump(spark, by_day, MARTS[:3])
    common = ["repo_name", "total_events", "first_activity", "last_activity"]
    assert values(spark.table(by_window["mart_repo_summary"]), *common) == values(
        spark.table(by_day["mart_repo_summary"]), *common
    )


def test_events_in_another_days_directory_are_left_out(spark, tmp_path):
    root = str(tmp_path)
    stray = event("stray", f"{DAY1}T23:59:59Z")
    loads.export_days(raw_frame(spark, day_events(DAY1)), root, [DAY1])
    loads.export_days(raw_frame(spark, day_events(DAY2, [stray])), root, [DAY2])
    together, single = (Tables(scratch_database(spark, "test")) for _ in range(2))
    incremental.run_days(spark, root, together, [DAY1, DAY2], REPOS)
    for day in (DAY1, DAY2):
        incremental.run_days(spark, root, single, [day], REPOS)
    for tables in (together, single):
        assert spark.table(tables["raw_events"]).count() == 10


def test_loading_part_of_the_days_reads_only_those(spark, database, lake):
    """What makes a month's part of a long backfill read that month."""
    tables = Tables(database)
    incremental.create_tables(spark, tables)
    incremental.load_raw_days(spark, lake, tables, DAYS)
    raw = spark.table(tables["raw_events"])
    staged = staging.stage_events_by_day(raw).where(F.col(loads.DAY).isin([DAY2]))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    dated = incremental.lake_events(spark, lake, DAYS).where(F.col(loads.DAY).isin([DAY2]))
    plan = dated._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_an_empty_day(spark, database, tmp_path):
    root, tables = str(tmp_path), Tables(database)
    rows = raw_frame(spark, day_events(DAY1) + day_events(DAY2))
    loads.export_days(rows, root, [DAY1, DAY2], F.to_date("created_at"))
    incremental.run_days(spark, root, tables, [DAY1, DAY2], REPOS)
    loads.export_days(rows.where("false"), root, [DAY2])
    with pytest.raises(loads.EmptyDay):
        incremental.run_days(spark, root, tables, [DAY2], REPOS)
    assert spark.table(tables["stg_events"]).count() == 10
    incremental.run_days(spark, root, tables, [DAY2], REPOS, allow_empty=True)
    assert loads.partition_days(spark, tables["stg_events"]) == [DAY1]
    # Merging never deletes; replacing does.
    assert len(loads.partition_days(spark, tables["mart_repo_daily_activity"])) == 2
    incremental.run_days(
        spark, root, tables, [DAY2], REPOS, allow_empty=True, marts_keep_stale=False
    )
    assert loads.partition_days(spark, tables["mart_repo_daily_activity"]) == [DAY1]


def test_dashboard(spark, database, landed):
    tables = Tables(database)
    board = Dashboard(spark, tables)
    incremental.create_tables(spark, tables)
    assert board.window() is None
    run_window(spark, landed, tables)
    shown = board.window(2)
    assert shown == DayRange(DAY2, DAY3)
    assert [r.repo_name for r in board.repo_options().collect()] == [
        "apache/flink", "apache/spark",
    ]
    assert values(board.active_repo_count(shown), "*") == [(2,)]
    assert values(board.kpis(shown), "*") == [(8, 2, 4.0)]
    assert values(board.kpis(shown, "apache/flink"), "*") == [(2, 1, 1.0)]
    assert [tuple(r) for r in board.activity_over_time(shown).collect()] == [
        (DAY2, 4, 2), (DAY3, 4, 2),
    ]
    assert board.activity_chart(DayRange(DAY3, date(2026, 3, 4))).collect()[1][:2] == (
        date(2026, 3, 4), 0,
    )
    assert [tuple(r) for r in board.event_type_distribution(shown).collect()] == [
        ("PushEvent", 6), ("IssuesEvent", 2),
    ]
    assert [tuple(r) for r in board.top_entities(shown, "All repos").collect()] == [
        ("apache/spark", 9, "spark"), ("apache/flink", 3, "flink"),
    ]
    assert [r.entity_label for r in board.top_entities(shown, "apache/spark").collect()] == [
        "ann", "bob",
    ]
    assert board.top_repos().first().repo_name == "apache/spark"
    assert board.top_contributors("apache/spark").first().total_events == 6
    plan = board.kpis(shown)._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_jobs_from_the_command_line(spark, database, tmp_path):
    source = raw_frame(spark, day_events(DAY1))
    source.write.saveAsTable(f"{database}.day_20260301")
    lake_root = str(tmp_path / "lake")
    main(["export", "--source", f"{database}.day_", "--lake", lake_root,
          "--execution-date", "2026-03-02T02:00:00Z"])
    main(["days", "--lake", lake_root, "--database", database, "--execution-date", "2026-03-02"])
    tables = Tables(database)
    assert values(spark.table(tables["mart_repo_summary"]), "repo_name", "total_events") == [
        ("apache/flink", 1), ("apache/spark", 3),
    ]
    with pytest.raises(SystemExit):
        main(["days", "--lake", lake_root, "--database", database, "--start-date", "2026-03-01"])
    land(tmp_path / "landing", f"{DAY1}-0.json.gz", day_events(DAY1))
    files = ["--landing", str(tmp_path / "landing"), "--end-date", "2026-03-01",
             "--lookback-days", "1", "--min-bytes", "10"]
    main(["audit", *files])
    other = scratch_database(spark, "test")
    main(["window", "--database", other, *files])
    assert spark.table(Tables(other)["stg_selected_events"]).count() == 4
