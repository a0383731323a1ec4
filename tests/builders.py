"""Small hand-made events."""

from __future__ import annotations

import gzip
import json
from datetime import datetime, timezone
from pathlib import Path

from forgepulse import schemas

REPO_IDS = {"apache/spark": 1, "apache/flink": 2, "duckdb/duckdb": 3, "other/tool": 4}


def event(id, at, repo="apache/spark", actor="ann", type="PushEvent", org=None, **extra):
    """A raw event as its JSON object."""
    row = {
        "id": str(id),
        "type": type,
        "actor": {"id": sum(map(ord, actor)) if actor else None, "login": actor},
        "repo": {"id": REPO_IDS.get(repo, 99), "name": repo},
        "payload": {"ref": "main"},
        "public": True,
        "created_at": at,
    }
    if org:
        row["org"] = {"id": 7, "login": org}
    return row | extra


def land(directory, filename, events, text=None):
    """Write an hourly file; `text` is appended as it is."""
    path = Path(directory) / filename
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = "".join(json.dumps(e) + "\n" for e in events) + (text or "")
    path.write_bytes(gzip.compress(lines.encode()))
    return path


def raw_frame(spark, events, filenames=None):
    """The same events as a raw table."""
    def pair(value):
        return (value["id"], value.get("login") or value.get("name")) if value else None

    rows = [
        (
            e["id"], e["type"], pair(e["actor"]), pair(e["repo"]), json.dumps(e["payload"]),
            e["public"],
            e["created_at"] and datetime.fromisoformat(e["created_at"]).astimezone(timezone.utc),
            pair(e.get("org")),
        )
        for e in events
    ]
    if filenames is None:
        return spark.createDataFrame(rows, schemas.RAW)
    rows = [row + (name,) for row, name in zip(rows, filenames, strict=True)]
    return spark.createDataFrame(rows, schemas.RAW + ", filename STRING")


def values(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)
