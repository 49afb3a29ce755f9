"""Queries of the llm subpackage with SQL give the same rows as DuckDB."""

import os

import pytest
from conftest import assert_parity, views_of

from criba.llm import queries

#: Words of dosage forms are learned, which takes more brands than the smallest tables hold.
LARGER = {"p6_found": "/root/testdata/sf0.01", "p6_grupos": "/root/testdata/sf0.01"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_parity(spark, folder, name):
    place = LARGER.get(name, folder)
    if not os.path.isdir(place):
        pytest.skip("the test tables are not here")
    assert_parity(queries.QUERIES[name](spark, place), views_of(place), queries.ORACLES[name])
