"""Every registered query with SQL gives the same rows on the smallest tables."""

import pytest

from catalog import load
from check_oracle import compare, connect

BASE = load()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(BASE.SQL))
def test_query_equals_sql(spark, con, name):
    ok, message = compare(spark, con, SF, BASE.QUERIES[name], BASE.SQL[name])
    assert ok, message
