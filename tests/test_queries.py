"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from agreement import connect, differences

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, sql, name):
    query, check = driver.queries()[name], driver.oracle_sql().get(name)
    if check is None:
        assert query(spark, FOLDER).count() > 0
    else:
        assert differences(spark, sql, FOLDER, query, check) == ""


def test_entry(spark):
    assert driver.entry(spark).count() > 0
