"""The whole path from raw events to marts against plain Python on skewed random events."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta, timezone

import pytest

from forgepulse.operators import marts, serving, staging
from tests.builders import event, raw_frame, values

REPOS = ["apache/spark", "apache/flink", "duckdb/duckdb"]
START, END = date(2026, 3, 2), date(2026, 3, 4)


def random_events(seed, size=3000):
    """A third of the rows are copies of one event, another third is one repository."""
    rng = random.Random(seed)
    first = datetime(2026, 3, 1, tzinfo=timezone.utc)
    rows, files = [], []
    for _ in range(size):
        id = "hot" if rng.random() < 0.33 else rng.randrange(size // 2)
        repo = REPOS[0] if rng.random() < 0.33 else rng.choice([*REPOS, "other/tool", None])
        at = first + timedelta(minutes=rng.randrange(5 * 24 * 60))
        rows.append(event(
            id, at.isoformat(), repo, rng.choice(["ann", "bob", "cid", None]),
            rng.choice(["PushEvent", "IssuesEvent", None]),
        ))
        files.append(rng.choice(["f-10", "f-9", "f-2"]))
    return rows, files


def kept(rows, files):
    """The latest copy of each event, as the last in order of time and file name."""
    best = {}
    for row, file in zip(rows, files, strict=True):
        rank = (row["created_at"], file)
        if row["id"] not in best or rank > best[row["id"]][0]:
            best[row["id"]] = (rank, row)
    return [row for _, row in best.values()]


def unambiguous(rows, files):
    """Rows without a rival of the same id, time and file."""
    seen = defaultdict(list)
    for i, (row, file) in enumerate(zip(rows, files, strict=True)):
        seen[row["id"], row["created_at"], file].append(i)
    chosen = sorted(indexes[0] for indexes in seen.values())
    return [rows[i] for i in chosen], [files[i] for i in chosen]


@pytest.mark.parametrize("seed", [1, 2])
def test_marts_and_tiles(spark, seed):
    rows, files = unambiguous(*random_events(seed))
    raw = raw_frame(spark, rows, files).repartition(6)
    selected = staging.select_repos(staging.stage_events(raw), REPOS)

    wanted = [r for r in kept(rows, files) if r["repo"]["name"] in REPOS]
    assert selected.count() == len(wanted)

    days = defaultdict(list)
    actors = defaultdict(list)
    repos = defaultdict(list)
    for row in wanted:
        at = datetime.fromisoformat(row["created_at"]).replace(tzinfo=None)
        row = (row["repo"]["name"], row["actor"]["login"], row["type"], at)
        days[row[0], at.date(), row[2]].append(row)
        actors[row[0], row[1]].append(row)
        repos[row[0]].append(row)

    def distinct(group, i):
        return len({row[i] for row in group} - {None})

    def span(group):
        return min(row[3] for row in group), max(row[3] for row in group)

    assert values(marts.daily_event_type_activity(selected), "*") == sorted(
        ((*key, len(g), distinct(g, 1)) for key, g in days.items()), key=repr
    )
    assert values(marts.actor_activity(selected), "*") == sorted(
        ((*key, len(g), distinct(g, 2), *span(g)) for key, g in actors.items()), key=repr
    )
    assert values(marts.repo_summary(selected), "*") == sorted(
        (
            (key, len(g), distinct(g, 1), len({row[3].date() for row in g}), *span(g))
            for key, g in repos.items()
        ),
        key=repr,
    )
    shown = [r for g in repos.values() for r in g if START <= r[3].date() <= END]
    assert values(serving.kpis(selected, START, END), "*") == [
        (len(shown), distinct(shown, 1), len(shown) / len({r[3].date() for r in shown}))
    ]
    since = staging.select_repos(staging.stage_events(raw, START, ["actor_login", "repo_name"]), REPOS)
    assert values(serving.kpis(since, START, END), "*") == values(
        serving.kpis(selected, START, END), "*"
    )


def test_day_by_day_keeps_one_copy_per_day(spark):
    rows, files = unambiguous(*random_events(3))
    raw = raw_frame(spark, rows, files).repartition(6)
    per_day = defaultdict(list)
    for row, file in zip(rows, files, strict=True):
        per_day[row["created_at"][:10]].append((row, file))
    wanted = sorted(
        (row["id"], row["created_at"][:19].replace("T", " "))
        for day in per_day.values() for row in kept(*zip(*day))
    )
    staged = staging.stage_events_by_day(raw)
    assert values(staged.selectExpr("event_id", "cast(created_at AS STRING) AS at"), "*") == wanted
