from datetime import date, datetime
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from forgepulse.operators import staging
from tests.builders import event, raw_frame, values

DAY1, DAY2 = date(2026, 3, 1), date(2026, 3, 2)
AT = "2026-03-01T10:00:00Z"


def test_flatten_reads_leaves_and_keeps_null_structs(spark):
    raw = raw_frame(spark, [event(1, AT, org="acme"), event(2, AT, actor=None)])
    flat = staging.flatten_event(raw)
    assert flat.columns == [
        "event_id", "event_type", "actor_id", "actor_login", "repo_id", "repo_name",
        "created_at", "org_id", "org_login",
    ]
    assert values(flat, "event_id", "actor_login", "repo_name", "org_id", "org_login") == [
        ("1", "ann", "apache/spark", 7, "acme"), ("2", None, "apache/spark", None, None),
    ]


def test_latest_time_wins_then_the_last_file_in_text_order(spark):
    raw = raw_frame(
        spark,
        [
            event(1, AT), event(1, "2026-03-01T11:00:00Z", type="late"),
            event(2, AT, type="nine"), event(2, AT, type="twenty-three"),
            event(3, None, type="unknown"), event(3, AT, type="known"),
        ],
        ["h-9", "h-10", "2026-03-01-9.json.gz", "2026-03-01-23.json.gz", "z", "a"],
    )
    assert values(staging.stage_events(raw), "event_id", "event_type") == [
        ("1", "late"), ("2", "nine"), ("3", "known"),
    ]


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    copies = [event(1, AT, type=t, actor=a) for t, a in [("a", "x"), ("b", None), ("b", "y")]]
    kept = {
        values(staging.stage_events(raw_frame(spark, list(p))), "event_type", "actor_login")[0]
        for p in permutations(copies)
    }
    assert kept == {("b", "y")}


def test_null_ids_are_one_key(spark):
    raw = raw_frame(spark, [event(1, AT), event(2, AT)]).withColumn("id", F.lit(None).cast("string"))
    assert staging.stage_events(raw).count() == 1


def test_an_id_on_two_days_is_kept_once_or_once_a_day(spark):
    raw = raw_frame(spark, [
        event(1, "2026-03-01T23:59:59Z"), event(1, "2026-03-01T23:00:00Z"),
        event(1, "2026-03-02T00:00:00Z"),
    ])
    assert values(staging.stage_events(raw), "created_at") == [(datetime(2026, 3, 2),)]
    assert values(staging.stage_events_by_day(raw), "event_date", "created_at") == [
        (DAY1, datetime(2026, 3, 1, 23, 59, 59)), (DAY2, datetime(2026, 3, 2)),
    ]


def test_leaving_out_old_copies_first_changes_nothing(spark):
    times = ["2026-03-01T10:00:00Z", "2026-03-02T10:00:00Z", "2026-03-03T10:00:00Z", None]
    rows = [
        event(f"{i}{j}", at, type=str(n))
        for i in range(4) for j in range(4) for n, at in enumerate((times[i], times[j]))
    ]
    raw = raw_frame(spark, rows)
    columns = ("event_id", "event_type", "created_at")
    whole = staging.stage_events(raw).where(F.to_date("created_at") >= F.lit(DAY2))
    assert values(staging.stage_events(raw, since=DAY2), *columns) == values(whole, *columns)


def test_fewer_columns_keep_the_same_copies(spark):
    raw = raw_frame(spark, [event(1, AT), event(1, "2026-03-02T10:00:00Z", actor="bob")])
    some = staging.stage_events(raw, columns=["actor_login"])
    assert some.columns == ["event_id", "actor_login", "created_at"]
    assert values(some, "actor_login") == [("bob",)]


def test_repositories_match_exactly(spark):
    raw = raw_frame(spark, [
        event(1, AT), event(2, AT, repo="Apache/Spark"), event(3, AT, repo="apache/spark "),
        event(4, AT, repo=None),
    ])
    events = staging.flatten_event(raw)
    assert values(staging.select_repos(events, ["apache/spark"]), "event_id") == [("1",)]
    listed = spark.createDataFrame([("apache/spark",), ("apache/spark",)], "name STRING")
    joined = staging.select_repos(events, listed)
    assert joined.columns == events.columns
    assert values(joined, "event_id") == [("1",)]


def test_days_are_utc_days(spark):
    events = staging.flatten_event(raw_frame(spark, [
        event(1, "2026-03-01T23:59:59Z"), event(2, "2026-03-02T00:00:00Z"),
        event(3, "2026-03-02T01:00:00+02:00"),
    ]))
    assert values(staging.on_day(events, DAY1), "event_id") == [("1",), ("3",)]
    assert values(staging.in_days(events, DAY1, DAY2), "event_id") == [("1",), ("2",), ("3",)]


@pytest.mark.parametrize("repo", [None, "", "All repos"])
def test_no_repository_means_all(spark, repo):
    events = staging.flatten_event(raw_frame(spark, [event(1, AT), event(2, AT, repo=None)]))
    assert staging.for_repo(events, repo).count() == 2


def test_repository_names_are_values_not_sql(spark):
    name = "o'brien/x' OR '1'='1"
    events = staging.flatten_event(raw_frame(spark, [event(1, AT), event(2, AT, repo=name)]))
    assert values(staging.for_repo(events, name), "event_id") == [("2",)]
