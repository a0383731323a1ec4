from datetime import date, datetime

from forgepulse.operators import marts, staging
from tests.builders import event, raw_frame, values

DAY1, DAY2 = date(2026, 3, 1), date(2026, 3, 2)


def events(spark):
    return staging.flatten_event(raw_frame(spark, [
        event(1, "2026-03-01T01:00:00Z"),
        event(2, "2026-03-01T02:00:00Z", actor="bob", type="IssuesEvent"),
        event(3, "2026-03-02T03:00:00Z"),
        event(4, "2026-03-02T04:00:00Z", actor=None),
        event(5, "2026-03-02T05:00:00Z", actor=None, type=None),
        event(6, "2026-03-02T06:00:00Z", repo="apache/flink"),
    ]))


def test_daily(spark):
    assert values(marts.daily_activity(events(spark)), "*") == [
        ("apache/flink", DAY2, 1, 1), ("apache/spark", DAY1, 2, 2), ("apache/spark", DAY2, 3, 1),
    ]


def test_daily_by_type(spark):
    rows = values(marts.daily_event_type_activity(events(spark)), "*")
    assert ("apache/spark", DAY2, "PushEvent", 2, 1) in rows
    assert ("apache/spark", DAY2, None, 1, 0) in rows
    assert len(rows) == 5


def test_actors_include_the_unknown_one(spark):
    rows = values(marts.actor_activity(events(spark)), "*")
    assert (
        "apache/spark", None, 2, 1, datetime(2026, 3, 2, 4), datetime(2026, 3, 2, 5)
    ) in rows
    assert (
        "apache/spark", "ann", 2, 1, datetime(2026, 3, 1, 1), datetime(2026, 3, 2, 3)
    ) in rows
    assert len(rows) == 4


def test_summaries(spark):
    first, last = datetime(2026, 3, 1, 1), datetime(2026, 3, 2, 5)
    rows = values(marts.repo_summary(events(spark)), "*")
    assert ("apache/spark", 5, 2, 2, first, last) in rows and len(rows) == 2
    by_type = marts.repo_summary_by_type(events(spark))
    assert by_type.columns == [
        "repo_name", "total_events", "total_actors", "total_event_types",
        "first_activity", "last_activity",
    ]
    assert ("apache/spark", 5, 2, 2, first, last) in values(by_type, "*")
