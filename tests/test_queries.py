"""Every registered query against its check SQL at the smallest scale."""

import pytest

from check import compare, duck
from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, sf_dir, name):
    result = compare(spark, con, queries()[name], oracle_sql().get(name), sf_dir)
    assert not result.startswith("FAIL"), result


def test_entry(spark):
    assert entry(spark).count() > 0
