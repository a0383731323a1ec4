from datetime import date, datetime, timedelta, timezone

import pytest

from forgepulse.config import (
    SELECTED_REPOS, DayRange, Tables, days_in, parse_day, rolling_window, target_day,
)


def test_parse_day_takes_days_and_timestamps():
    assert parse_day("2026-03-01") == date(2026, 3, 1)
    assert parse_day("2026-03-01T23:59:59Z") == date(2026, 3, 1)
    assert parse_day(datetime(2026, 3, 1, 5)) == date(2026, 3, 1)
    with pytest.raises(ValueError):
        parse_day("yesterday")


def test_target_day_is_the_one_before():
    assert target_day("2026-03-01T02:00:00Z") == date(2026, 2, 28)
    assert target_day() == datetime.now(timezone.utc).date() - timedelta(days=1)


def test_rolling_window_is_closed():
    window = rolling_window("2026-03-07", 7)
    assert (window.start, window.end) == (date(2026, 3, 1), date(2026, 3, 7))
    assert len(window.days) == 7
    assert rolling_window("2026-03-07", "1").days == [date(2026, 3, 7)]
    assert rolling_window().end == target_day()


@pytest.mark.parametrize("days", ["x", None, 0, -3])
def test_rolling_window_needs_a_positive_integer(days):
    with pytest.raises(ValueError):
        rolling_window("2026-03-07", days)


def test_ranges():
    assert days_in(date(2026, 2, 28), date(2026, 3, 1)) == [date(2026, 2, 28), date(2026, 3, 1)]
    assert days_in(date(2026, 3, 2), date(2026, 3, 1)) == []
    with pytest.raises(ValueError):
        DayRange(date(2026, 3, 2), date(2026, 3, 1))


def test_tables():
    assert Tables("daily")["stg_events"] == "daily.stg_events"
    with pytest.raises(KeyError):
        Tables("daily")["nope"]
    assert len(set(SELECTED_REPOS)) == 15
