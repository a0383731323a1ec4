from datetime import date

import pytest

from forgepulse.operators import checks

DAY1, DAY2 = date(2026, 3, 1), date(2026, 3, 2)
SUMMARY = (
    "repo_name STRING, total_events BIGINT, unique_actors BIGINT, active_days BIGINT, "
    "first_activity TIMESTAMP, last_activity TIMESTAMP"
)


def verdicts(results):
    return {row[0]: row[1] for row in results.collect()}


def test_an_empty_mart_fails_counts_and_minimums_only(spark):
    got = verdicts(checks.run_checks(
        spark.createDataFrame([], SUMMARY), checks.WINDOW_CHECKS["mart_repo_summary"]
    ))
    assert {name for name, passed in got.items() if not passed} == {
        "row_count_positive", "min_positive(total_events)", "min_positive(unique_actors)",
        "min_positive(active_days)",
    }


@pytest.mark.parametrize(
    ("rows", "exact", "joined"),
    [
        ([("ab", "c"), ("a", "bc")], True, False),
        ([("a", "b"), ("a", "b")], False, False),
        ([("a", None)], False, False),
        ([("a", "b"), ("a", "c")], True, True),
        ([], True, True),
    ],
)
def test_unique_grain(spark, rows, exact, joined):
    df = spark.createDataFrame(rows, "repo_name STRING, actor_login STRING")
    for mode, expected in (("struct", exact), ("concat", joined)):
        check = checks.unique_grain("repo_name", "actor_login", mode=mode)
        assert list(verdicts(checks.run_checks(df, [check])).values()) == [expected]


def test_each_rule_can_fail(spark):
    df = spark.createDataFrame([("a", 0, 2, 1), (None, None, 1, 2)], "k STRING, n INT, lo INT, hi INT")
    assert verdicts(checks.run_checks(df, [
        checks.row_count_positive(), checks.complete("k"), checks.not_null("k"),
        checks.min_positive("n"), checks.ordered_range("lo", "hi"), checks.unique_key("k"),
    ])) == {
        "row_count_positive": True, "complete(k)": False, "not_null(k)": False,
        "min_positive(n)": False, "ordered_range(lo,hi)": False, "unique_key(k)": False,
    }


def test_days_are_judged_one_by_one(spark):
    daily = spark.createDataFrame(
        [("a", DAY1, 1, 1), ("a", DAY1, 2, 1)],
        "repo_name STRING, event_date DATE, total_events BIGINT, unique_actors BIGINT",
    )
    got = checks.run_checks_by_day(
        daily, checks.DAY_CHECKS["mart_repo_daily_activity"], [DAY1, DAY2]
    )
    failed = {(r.event_date, r.check) for r in got.collect() if not r.passed}
    assert got.count() == 8
    assert failed == {
        (DAY1, "unique_grain(repo_name,event_date)"), (DAY2, "row_count_positive"),
        (DAY2, "min_positive(total_events)"), (DAY2, "min_positive(unique_actors)"),
    }


def test_a_failed_check_raises_with_its_name(spark):
    results = checks.run_checks(spark.range(0), [checks.row_count_positive()])
    with pytest.raises(checks.CheckFailed, match="stg_events: row_count_positive"):
        checks.require(results, "stg_events")
    checks.require(checks.run_checks(spark.range(1), [checks.row_count_positive()]), "x")


def test_number_of_checks():
    assert sum(map(len, checks.WINDOW_CHECKS.values())) == 36
    assert sum(map(len, (*checks.DAY_CHECKS.values(), *checks.REBUILD_CHECKS.values()))) == 16
