import pytest

from oracle import TABLES, same
from tallyloom.llm import queries

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no tables")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_its_statement(spark, name):
    same(spark, name, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.SQL])
def test_query_without_a_statement_runs(spark, name):
    df = queries.QUERIES[name](spark, str(TABLES))
    assert df.count() == df.distinct().count() > 0
