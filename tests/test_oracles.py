"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from checks import ORACLES, QUERIES
from checks.run import difference, oracle_connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    connection = oracle_connection(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    found = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert found
        return
    problem = difference(df.columns, found, oracle, ORACLES[name])
    assert problem is None, problem


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() == 10
    assert set(driver.queries()) >= set(QUERIES)
    assert set(driver.oracle_sql()) <= set(driver.queries())
