"""Each registered query gives the rows its SQL gives on the same files."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from workload.queries import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return f"{value:.9g}" if math.isfinite(value) else repr(value)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return str(value)


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(cell(row[i]) for i in order) for row in values)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_oracle(spark, db, name):
    expected = db.execute(contract.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    wanted = expected.fetchall()
    result = contract.queries()[name](spark, str(SF_DIR))
    assert sorted(result.columns) == sorted(names)
    assert rows(result.columns, result.collect()) == rows(names, wanted)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
