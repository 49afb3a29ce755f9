"""Shared session and comparison with DuckDB."""

from __future__ import annotations

import glob
import math
import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from criba.session import local_session  # noqa: E402

DATA = os.environ.get("CRIBA_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(int(os.environ.get("CRIBA_TEST_CPUS", "8")), 8, "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(DATA):
        pytest.skip("the test tables are not here")
    return DATA


def views_of(folder):
    """A DuckDB connection with a view of every table of a folder."""
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        connection.execute(f"create view {Path(path).stem} as select * from '{path}'")
    return connection


@pytest.fixture(scope="session")
def duck(folder):
    return views_of(folder)


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19].replace("T", " ")
    if type(value).__name__ == "Decimal":
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(map(_plain, value))
    return value


def sorted_rows(columns, rows):
    """Rows as tuples in order of column names, sorted; dates and numbers in one form."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def assert_parity(spark_df, connection, sql):
    ours = sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    relation = connection.sql(sql)
    theirs = sorted_rows(relation.columns, relation.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1]), f"{len(ours[1])} rows, expected {len(theirs[1])}"
    different = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    assert not different, different[:3]
