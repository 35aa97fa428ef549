"""Every registered query against its SQL, on the smallest tables."""

import pytest

from tallymark.bindings import ORACLES, QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns[0] == "state"
    assert set(e.oracle_sql()) <= set(e.queries())
