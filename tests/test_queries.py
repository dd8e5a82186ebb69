"""Every registered query against its SQL on the smallest data set."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, queries()[name], oracle_sql().get(name)) == ""


def test_entry(spark):
    assert entry(spark).count() == 1443
