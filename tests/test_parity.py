"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import pytest
from conftest import assert_parity

from criba.plans import core, mart, reference

CASES = sorted({**core.ORACLES, **reference.ORACLES, **mart.ORACLES}.items())


@pytest.mark.parametrize("name,sql", CASES, ids=[n for n, _ in CASES])
def test_parity(spark, folder, duck, name, sql):
    found = {**core.QUERIES, **reference.QUERIES, **mart.QUERIES}[name](spark, folder)
    assert_parity(found, duck, sql)


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) | set(reference.QUERIES) | set(mart.QUERIES)))
def test_has_unique_columns(spark, folder, name):
    columns = {**core.QUERIES, **reference.QUERIES, **mart.QUERIES}[name](spark, folder).columns
    assert len(columns) == len(set(columns)) > 0
