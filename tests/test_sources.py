import gzip
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from forgepulse.config import DayRange
from forgepulse.functions.columns import calendar
from forgepulse.operators.staging import flatten_event
from forgepulse.sources import lake, landing, ndjson
from forgepulse.sinks import loads
from tests.builders import event, land, raw_frame, values

DAY1, DAY2 = date(2026, 3, 1), date(2026, 3, 2)


@pytest.fixture
def landed(tmp_path):
    """Files that differ in their fields, payload keys that differ in case."""
    land(tmp_path, "2026-03-01-9.json.gz", [
        event(1, "2026-03-01T09:00:00Z", payload={"x": 1, "X": [2]}),
    ])
    land(tmp_path, "2026-03-01-23.json.gz", [
        event(2, "2026-03-01T23:59:59Z", org="acme", extra={"deep": True}),
    ])
    land(tmp_path, "2026-03-02-0.json.gz", [event(3, "2026-03-02T00:00:00Z", actor=None)])
    (tmp_path / "notes.txt").write_text("not an event file")
    return str(tmp_path)


@pytest.mark.parametrize(
    "scan", [ndjson.scan_ndjson, ndjson.scan_ndjson_variant, ndjson.scan_ndjson_inferred]
)
def test_scans_agree(spark, landed, scan):
    raw = scan(spark, landed)
    assert values(raw, "id", "type", "repo.name", "actor.login", "org.login", "created_at") == [
        ("1", "PushEvent", "apache/spark", "ann", None, datetime(2026, 3, 1, 9)),
        ("2", "PushEvent", "apache/spark", "ann", "acme", datetime(2026, 3, 1, 23, 59, 59)),
        ("3", "PushEvent", "apache/spark", None, None, datetime(2026, 3, 2)),
    ]
    assert values(raw, F.substring_index("filename", "/", -1), "file_date") == [
        ("2026-03-01-23.json.gz", DAY1), ("2026-03-01-9.json.gz", DAY1),
        ("2026-03-02-0.json.gz", DAY2),
    ]
    assert flatten_event(raw).count() == 3


def test_payload_stays_text(spark, landed):
    payloads = values(ndjson.scan_ndjson(spark, landed).where("id = '1'"), "payload")
    assert payloads == [('{"x": 1, "X": [2]}',)]


def test_variant_scan_keeps_unknown_fields(spark, landed):
    raw = ndjson.scan_ndjson_variant(spark, landed).where("id = '2'")
    assert values(raw, F.expr("body:extra.deep::boolean"), "payload") == [(True, '{"ref":"main"}')]


def test_inferred_scan_keeps_unknown_fields(spark, landed):
    raw = ndjson.scan_ndjson_inferred(spark, landed)
    assert values(raw.where("id = '2'"), "extra.deep") == [(True,)]


def test_inferred_scan_adds_absent_columns(spark, tmp_path):
    land(tmp_path, "2026-03-01-0.json.gz", [event(1, "2026-03-01T00:00:00Z")])
    raw = ndjson.scan_ndjson_inferred(spark, str(tmp_path))
    assert values(flatten_event(raw), "event_id", "org_id", "org_login") == [("1", None, None)]


def test_scan_of_a_window_reads_its_files_only(spark, landed):
    raw = ndjson.scan_ndjson(spark, landed, DayRange(DAY2, date(2026, 3, 5)).days)
    assert values(raw, "id") == [("3",)]
    assert len(raw.inputFiles()) == 1
    assert ndjson.scan_ndjson(spark, landed, [date(2025, 1, 1)]).count() == 0


def test_malformed_line_stops_the_scan_unless_asked(spark, tmp_path):
    land(tmp_path, "2026-03-01-0.json.gz", [event(1, "2026-03-01T00:00:00Z")], '{"id": "2", \n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        ndjson.scan_ndjson(spark, str(tmp_path)).select("id").collect()
    kept = ndjson.scan_ndjson(spark, str(tmp_path), malformed="PERMISSIVE")
    broken = [row[1] for row in values(kept, "id", F.col("_corrupt_record").isNotNull())]
    assert sorted(broken) == [False, True]


# -- lake ------------------------------------------------------------------------------


def test_lake_round_trip(spark, tmp_path):
    root = str(tmp_path / "raw")
    raw = raw_frame(spark, [
        event(1, "2026-03-01T01:00:00Z"), event(2, "2026-03-02T01:00:00Z", org="acme"),
    ])
    loads.export_days(raw, root, [DAY1, DAY2], F.to_date("created_at"))
    assert (tmp_path / "raw/year=2026/month=03/day=02").is_dir()
    one = lake.scan_lake_days(spark, root, DAY2, DAY2)
    assert one.columns == raw.columns
    assert values(one, "id", "org.login") == [("2", "acme")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "day=01" not in plan and "make_date" in plan.split("PartitionFilters")[1]


def test_lake_skips_absent_days_and_needs_one(spark, tmp_path):
    root = str(tmp_path)
    loads.export_days(raw_frame(spark, [event(1, "2026-03-01T01:00:00Z")]), root, [DAY1])
    assert lake.scan_lake_days(spark, root, date(2026, 2, 1), date(2026, 4, 1)).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.scan_lake_days(spark, root, date(2025, 1, 1), date(2025, 1, 3))


def test_export_replaces_a_day_even_with_nothing(spark, tmp_path):
    root = str(tmp_path)
    both = raw_frame(spark, [event(1, "2026-03-01T01:00:00Z"), event(2, "2026-03-02T01:00:00Z")])
    at = F.to_date("created_at")
    loads.export_days(both, root, [DAY1, DAY2], at)
    loads.export_days(both, root, [DAY1, DAY2], at)
    assert lake.scan_lake_days(spark, root, DAY1, DAY2).count() == 2
    loads.export_days(both.where("id = '2'"), root, [DAY1, DAY2], at)
    assert values(lake.scan_lake_days(spark, root, DAY1, DAY2), "id") == [("2",)]


def test_source_day_and_paths(spark, database):
    raw_frame(spark, [event(1, "2026-03-01T01:00:00Z")]).write.saveAsTable(
        f"{database}.day_20260301"
    )
    assert lake.scan_source_day(spark, f"{database}.day_", DAY1).count() == 1
    paths = lake.lake_day_paths(calendar(spark, DAY1, DAY2), "s3a://lake/raw/")
    assert values(paths, "path") == [
        ("s3a://lake/raw/year=2026/month=03/day=01",),
        ("s3a://lake/raw/year=2026/month=03/day=02",),
    ]
    assert lake.joined_paths(paths).first()[0] == (
        "'s3a://lake/raw/year=2026/month=03/day=01/part-*', "
        "'s3a://lake/raw/year=2026/month=03/day=02/part-*'"
    )


# -- landing ---------------------------------------------------------------------------


def fill_day(directory, hours):
    for hour in hours:
        land(directory, f"2026-03-01-{hour}.json.gz", [event(hour, "2026-03-01T00:00:00Z")])
    return str(directory)


def test_missing_hour_is_a_warning(spark, tmp_path):
    path = fill_day(tmp_path, range(23))
    expected, landed = landing.expected_files(spark, DAY1, DAY1), landing.landed_files(spark, path)
    issues = landing.audit(expected, landed, min_bytes=10)
    assert values(issues, "*") == [("warn", "missing", "2026-03-01-23.json.gz")]
    assert landing.require_sound(issues) == ["not landed: 2026-03-01-23.json.gz"]
    assert values(landing.incomplete_days(expected, landed), "*") == [(DAY1, 23)]


def test_many_missing_are_summed_up(spark, tmp_path):
    path = fill_day(tmp_path, [0])
    expected, landed = landing.expected_files(spark, DAY1, DAY1), landing.landed_files(spark, path)
    report = landing.missing_report(expected, landed).collect()
    assert len(report) == 11
    assert [tuple(r) for r in report if r.filename is None] == [(None, 13)]
    lines = landing.require_sound(landing.audit(expected, landed, min_bytes=10))
    assert len(lines) == 11 and lines[-1] == "hours not landed beyond these: 13"


def test_small_file_and_empty_directory_are_errors(spark, tmp_path):
    path = fill_day(tmp_path / "full", range(24))
    expected = landing.expected_files(spark, DAY1, DAY1)
    with pytest.raises(landing.LandingError, match="too small: 24 file"):
        landing.require_sound(landing.audit(expected, landing.landed_files(spark, path)))
    (tmp_path / "empty").mkdir()
    nothing = landing.landed_files(spark, str(tmp_path / "empty"))
    with pytest.raises(landing.LandingError, match="nothing landed"):
        landing.require_sound(landing.audit(expected, nothing))


def test_full_day_is_sound(spark, tmp_path):
    path = fill_day(tmp_path, range(24))
    expected, landed = landing.expected_files(spark, DAY1, DAY1), landing.landed_files(spark, path)
    assert landing.require_sound(landing.audit(expected, landed, min_bytes=10)) == []
    assert landing.incomplete_days(expected, landed).count() == 0
    assert landing.require_readable(spark, path) == 24


def test_files_outside_the_window(spark, tmp_path):
    fill_day(tmp_path, [5])
    land(tmp_path, "2026-02-20-5.json.gz", [])
    outside = landing.files_outside(
        landing.expected_files(spark, DAY1, DAY1), landing.landed_files(spark, str(tmp_path))
    )
    assert values(outside, "filename") == [("2026-02-20-5.json.gz",)]


def test_damaged_files_are_found(spark, tmp_path):
    fill_day(tmp_path, [0])
    (tmp_path / "2026-03-01-1.json.gz").write_bytes(b"this is no gzip file")
    whole = gzip.compress(b"one\ntwo\n" * 50_000 + b"no line end")
    (tmp_path / "2026-03-01-2.json.gz").write_bytes(whole[:-4])
    (tmp_path / "2026-03-01-3.json.gz").write_bytes(b"")
    (tmp_path / "2026-03-01-4.json.gz").write_bytes(whole + gzip.compress(b"more\n"))
    (tmp_path / "2026-03-01-5.json.gz").write_bytes(whole[:-8] + bytes(8))
    (tmp_path / "2026-03-01-6.json.gz").write_bytes(whole + b"stray")
    (tmp_path / "2026-03-01-7.json.gz").write_bytes(gzip.compress(b""))
    verdicts = landing.file_verdicts(spark, str(tmp_path))
    assert values(verdicts, "filename", "lines", "sound") == [
        ("2026-03-01-0.json.gz", 1, True), ("2026-03-01-1.json.gz", None, False),
        ("2026-03-01-2.json.gz", None, False), ("2026-03-01-3.json.gz", None, False),
        ("2026-03-01-4.json.gz", 100_001, True), ("2026-03-01-5.json.gz", None, False),
        ("2026-03-01-6.json.gz", None, False), ("2026-03-01-7.json.gz", 0, True),
    ]
    assert verdicts.where("NOT sound AND problem IS NULL").isEmpty()
    empty = landing.undersized_files(landing.landed_files(spark, str(tmp_path)), 1)
    assert values(empty, "filename", "length") == [("2026-03-01-3.json.gz", 0)]
    with pytest.raises(Exception, match="2026-03-01-1.json.gz"):
        landing.require_readable(spark, str(tmp_path))


def test_truncated_gzip_stops_the_read(spark, tmp_path):
    whole = gzip.compress("".join(f'{{"id": "{i * 7919}"}}\n' for i in range(50_000)).encode())
    (tmp_path / "2026-03-01-0.json.gz").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="2026-03-01-0.json.gz"):
        landing.require_readable(spark, str(tmp_path))
    with pytest.raises(Exception, match="2026-03-01-0.json.gz"):
        ndjson.scan_ndjson(spark, str(tmp_path)).select("id").write.format("noop").mode(
            "overwrite"
        ).save()
