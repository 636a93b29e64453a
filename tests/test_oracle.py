"""Every registered query against DuckDB, on the smallest generated tables."""

import os

import pytest

from checks import ORACLES, QUERIES
from checks.compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == []
