"""Loads neither lose nor add rows: changed and stray files, new columns, failures."""

from __future__ import annotations

import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from forgepulse.__main__ import main
from forgepulse.config import DayRange, Tables
from forgepulse.plans import incremental, window
from forgepulse.sinks import loads
from forgepulse.sources import lake
from tests.builders import event, raw_frame, values

DAY = date(2026, 3, 1)
NEXT = date(2026, 3, 2)


def lines(day, count, **more):
    return [
        {
            "id": f"{day}-{k}", "type": "PushEvent", "actor": {"id": k, "login": f"u{k}", "url": "x"},
            "repo": {"id": 1, "name": "apache/spark"}, "created_at": f"{day}T01:00:00Z",
            "payload": {"a": 1, "A": 2}, "public": True, **more,
        }
        for k in range(count)
    ]


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / name, "wt") as out:
        out.writelines(json.dumps(row) + "\n" for row in rows)


def run(spark, folder, database, scan="variant", last=DAY):
    tables = Tables(database)
    window.run_window(spark, str(folder), tables, DayRange(DAY, last), min_bytes=1, scan=scan)
    return spark.table(tables["raw_events"])


@pytest.mark.parametrize("scan", ["variant", "fixed"])
def test_a_file_delivered_again_is_loaded_again(spark, database, tmp_path, scan):
    name = f"{DAY}-0.json.gz"
    put(tmp_path / "in", name, lines(DAY, 1))
    assert run(spark, tmp_path / "in", database, scan).count() == 1
    put(tmp_path / "in", name, lines(DAY, 3))
    assert run(spark, tmp_path / "in", database, scan).count() == 3
    summary = spark.table(Tables(database)["mart_repo_summary"]).first()
    assert summary.total_events == 3


def test_stray_files_are_not_loaded(spark, database, tmp_path):
    for name in ("0", "24", "part"):
        put(tmp_path / "in", f"{DAY}-{name}.json.gz", lines(DAY, 1))
    assert run(spark, tmp_path / "in", database).count() == 1


def test_whole_lines_are_kept_and_another_scan_rebuilds(spark, database, tmp_path):
    put(tmp_path / "in", f"{DAY}-0.json.gz", lines(DAY, 2, extra="kept"))
    raw = run(spark, tmp_path / "in", database)
    found = raw.select(F.variant_get("body", "$.extra", "string"), F.variant_get("body", "$.actor.url", "string"))
    assert [tuple(r) for r in found.collect()] == [("kept", "x")] * 2
    assert "body" not in run(spark, tmp_path / "in", database, "fixed").columns
    assert "body" in run(spark, tmp_path / "in", database, last=NEXT).columns


def test_a_broken_file_stops_the_load(spark, database, tmp_path):
    put(tmp_path / "in", f"{DAY}-0.json.gz", lines(DAY, 5000))
    whole = (tmp_path / "in" / f"{DAY}-0.json.gz").read_bytes()
    (tmp_path / "in" / f"{DAY}-0.json.gz").write_bytes(whole[: len(whole) // 2])
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    with pytest.raises(Exception, match=f"{DAY}-0.json.gz"):
        run(spark, tmp_path / "in", database)


def lake_day(spark, root, day, count, extra=False):
    df = spark.createDataFrame(
        [(f"{day}-{k}", "PushEvent", (k, f"u{k}"), (1, "apache/spark"), "{}", True, (k, "o")) for k in range(count)],
        "id STRING, type STRING, actor STRUCT<id: BIGINT, login: STRING>, repo STRUCT<id: BIGINT, name: STRING>, "
        "payload STRING, public BOOLEAN, org STRUCT<id: BIGINT, login: STRING>",
    ).withColumn("created_at", F.lit(f"{day} 05:00:00").cast("timestamp"))
    if extra:
        df = df.withColumn("extra", F.lit("new"))
    loads.export_days(df, root, [day])


def test_new_lake_columns_are_kept(spark, database, tmp_path):
    root, tables = str(tmp_path / "lake"), Tables(database)
    lake_day(spark, root, DAY, 2)
    lake_day(spark, root, NEXT, 3, extra=True)
    both = lake.scan_lake_days(spark, root, DAY, NEXT)
    assert both.where("extra = 'new'").count() == 3 and both.where("extra IS NULL").count() == 2
    incremental.run_days(spark, root, tables, [DAY])
    incremental.run_days(spark, root, tables, [NEXT])
    incremental.run_days(spark, root, tables, [DAY])
    raw = spark.table(tables["raw_events"])
    assert raw.where("extra = 'new'").count() == 3 and raw.where("extra IS NULL").count() == 2


def test_an_unknown_column_is_an_error_elsewhere(spark, database):
    rows = spark.range(1).select("id", F.lit(DAY).alias(loads.DAY))
    loads.create_like(rows, f"{database}.t")
    with pytest.raises(loads.UnknownColumns, match="other"):
        loads.replace_days(rows.withColumn("other", F.lit(1)), f"{database}.t", [DAY])


def test_an_empty_day_does_not_hold_up_the_others(spark, database, tmp_path):
    root, tables = str(tmp_path / "lake"), Tables(database)
    lake_day(spark, root, DAY, 2)
    lake_day(spark, root, NEXT, 0)
    with pytest.raises(loads.EmptyDay, match=str(NEXT)):
        incremental.run_days(spark, root, tables, [DAY, NEXT])
    for name in ("raw_events", "stg_events", "stg_selected_events"):
        assert spark.table(tables[name]).count() == 2
    assert spark.table(tables["mart_repo_summary"]).first().total_events == 2


def test_a_failed_rebuild_keeps_the_old_table(spark, database):
    loads.full_rebuild(spark.range(3).toDF("n"), f"{database}.t")
    with pytest.raises(Exception, match="broken"):
        loads.full_rebuild(spark.range(3).selectExpr("if(id > 1, raise_error('broken'), id) AS n"), f"{database}.t")
    assert spark.table(f"{database}.t").count() == 3
    loads.full_rebuild(spark.table(f"{database}.t").where("n > 0"), f"{database}.t")
    assert spark.table(f"{database}.t").count() == 2
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]


def test_audit_looks_at_its_window_only(spark, tmp_path, capsys):
    folder = tmp_path / "in"
    for hour in range(24):
        put(folder, f"{DAY}-{hour}.json.gz", lines(DAY, 1))
    put(folder, "2020-01-01-0.json.gz", [])
    args = ["audit", "--landing", str(folder), "--end-date", str(DAY), "--lookback-days", "1", "--min-bytes", "60"]
    main(args)
    assert "lines: 24" in capsys.readouterr().out
    (folder / f"{DAY}-7.json.gz").write_bytes((folder / f"{DAY}-7.json.gz").read_bytes()[:90])
    with pytest.raises(Exception, match=f"{DAY}-7.json.gz"):
        main(args)


def test_lake_days_with_a_file_name_are_staged(spark, database, tmp_path):
    root, tables = str(tmp_path / "lake"), Tables(database)
    raw = raw_frame(spark, [event(1, "2026-03-01T05:00:00Z")], ["2026-03-01-5.json.gz"])
    loads.export_days(raw, root, [DAY])
    incremental.run_days(spark, root, tables, [DAY])
    assert "filename" in spark.table(tables["raw_events"]).columns
    assert values(spark.table(tables["stg_events"]), "event_id") == [("1",)]
