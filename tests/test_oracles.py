"""Every registered query against its SQL at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from shiplens.catalog import QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    if name not in oracle_sql():
        pytest.skip("model queries have their own tests")
    message, _, _ = compare(spark, FOLDER, name, con)
    assert message is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "risk_tier" in df.columns
