"""Every registered query against its SQL, on whole tables."""

import pytest
from compare import database, difference

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    run, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert run(spark, FOLDER).count() >= 0
    else:
        assert difference(run, sql, spark, con, FOLDER) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
