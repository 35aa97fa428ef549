import pytest

from tallymark import session


@pytest.fixture(scope="session")
def spark():
    s = session.local(4, "tests", "4g")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()


@pytest.fixture
def frame(spark):
    """A small DataFrame from rows and a schema text."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
