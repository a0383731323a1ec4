from datetime import date

import pytest

from forgepulse.functions.columns import short_name
from forgepulse.operators import marts, serving, staging
from tests.builders import event, raw_frame, values
from pyspark.sql import functions as F

START, END = date(2026, 3, 1), date(2026, 3, 3)


@pytest.fixture
def selected(spark):
    return staging.flatten_event(raw_frame(spark, [
        event(1, "2026-03-01T01:00:00Z"),
        event(2, "2026-03-01T02:00:00Z", actor="bob"),
        event(3, "2026-03-03T03:00:00Z", type="IssuesEvent"),
        event(4, "2026-03-03T04:00:00Z", repo="apache/flink", actor=None),
        event(5, "2026-02-28T04:00:00Z", repo="duckdb/duckdb"),
    ]))


def test_kpis_divide_by_days_with_events(selected):
    assert values(serving.kpis(selected, START, END), "*") == [(4, 2, 2.0)]
    assert values(serving.kpis(selected, START, END, "apache/flink"), "*") == [(1, 0, 1.0)]


def test_kpis_without_events_are_zero(selected):
    assert values(serving.kpis(selected, date(2030, 1, 1), END.replace(year=2030)), "*") == [
        (0, 0, 0.0)
    ]


def test_activity_over_time(selected):
    rows = [tuple(r) for r in serving.activity_over_time(selected, START, END).collect()]
    assert rows == [(START, 2, 2), (END, 2, 1)]


def test_every_day_is_in_the_chart(selected):
    rows = serving.activity_zero_filled(selected, START, END).collect()
    assert [tuple(r) for r in rows] == [
        (START, 2, "Mar 01"), (date(2026, 3, 2), 0, "Mar 02"), (END, 2, "Mar 03"),
    ]
    nothing = serving.activity_zero_filled(selected, START, END, "unique_actors", "no/such")
    assert [r.unique_actors for r in nothing.collect()] == [0, 0, 0]
    with pytest.raises(ValueError):
        serving.activity_zero_filled(selected, START, END, "repo_name")


def test_event_types(selected):
    by_type = marts.daily_event_type_activity(selected)
    rows = serving.event_type_distribution(by_type, START, END).collect()
    assert [tuple(r) for r in rows] == [("PushEvent", 3), ("IssuesEvent", 1)]


def test_counts_and_dates(selected):
    assert values(serving.active_repo_count(selected, START, END), "*") == [(2,)]
    assert values(serving.last_loaded_date(selected), "*") == [(END,)]
    assert values(serving.last_loaded_date(selected.where("false")), "*") == [(None,)]
    assert values(serving.dashboard_window(selected), "*") == [(date(2026, 2, 25), END)]


def test_equal_totals_are_ranked_by_name(spark):
    summary = marts.repo_summary(staging.flatten_event(raw_frame(spark, [
        event(i, "2026-03-01T01:00:00Z", repo=f"o/{name}") for i, name in enumerate("fbdace")
    ])))
    assert [r.repo_name for r in serving.top_repos(summary).collect()] == [
        "o/a", "o/b", "o/c", "o/d", "o/e",
    ]
    assert [r[0] for r in serving.repo_options(summary).collect()] == [f"o/{c}" for c in "abcdef"]


def test_top_entities_and_labels(selected):
    summary = marts.repo_summary(selected)
    repos = serving.with_labels(serving.top_entities(summary, selected, START, END), True)
    assert tuple(repos.first()) == ("apache/spark", 3, "spark")
    actors = serving.top_entities(summary, selected, START, END, "apache/spark")
    assert [tuple(r) for r in serving.with_labels(actors, False).collect()] == [
        ("ann", 2, "ann"), ("bob", 1, "bob"),
    ]
    by_actor = marts.actor_activity(selected)
    top = serving.top_contributors(by_actor, "apache/spark").collect()
    assert [(r.actor_login, r.total_events) for r in top] == [("ann", 2), ("bob", 1)]


def test_short_names(spark):
    names = spark.createDataFrame([("a/b/c",), ("n",), ("x/",), (None,)], "name STRING")
    assert values(names, "name", short_name(F.col("name"))) == [
        ("a/b/c", "b/c"), ("n", "n"), ("x/", ""), (None, None),
    ]
