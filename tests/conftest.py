import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE.parent), str(HERE)]


@pytest.fixture(scope="session")
def spark():
    from tallyloom.session import local_session

    s = local_session(4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """A small DataFrame from tuples and a schema text."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


def pytest_configure(config):
    config.addinivalue_line("markers", "tables: runs a query over the driver's tables")
