"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from mixwright.plans.catalog import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        db.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return db


def settled(v):
    """Values as they are compared: doubles are rounded by the queries, so that equal ones are equal to the last place."""
    return round(v, 6) + 0.0 if isinstance(v, float) else v


def key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_as_sql(spark, tables, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    expected = tables.execute(ORACLE[name])
    assert sorted(d[0] for d in expected.description) == columns
    order = [[d[0] for d in expected.description].index(c) for c in columns]
    theirs = sorted((tuple(settled(row[i]) for i in order) for row in expected.fetchall()), key=key)
    ours = sorted((tuple(map(settled, row)) for row in found.select(*columns).collect()), key=key)
    assert ours == theirs
