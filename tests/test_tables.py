import pytest

from oracle import TABLES, same
from tallyloom.queries import MODULES

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no tables")


@pytest.mark.parametrize("name", [n for m in MODULES for n in m.SQL])
def test_query_equals_its_statement(spark, name):
    module = next(m for m in MODULES if name in m.SQL)
    same(spark, name, module.QUERIES[name], module.SQL[name])


@pytest.mark.parametrize("name", [n for m in MODULES for n in m.QUERIES if n not in m.SQL])
def test_query_without_a_statement_runs(spark, name):
    module = next(m for m in MODULES if name in m.QUERIES)
    df = module.QUERIES[name](spark, str(TABLES))
    assert df.count() == df.distinct().count() > 0


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 80


def test_plans(spark):
    """No cartesian product, no row-at-a-time Python and pruned scans in the plans of the main operators."""
    for name in ("attribution_split", "volume_one_scan", "nearest_forward_op", "launch_windows", "resolve_first_match", "p1_found", "p3_found", "p5_found", "p6_found"):
        module = next(m for m in MODULES if name in m.QUERIES)
        plan = module.QUERIES[name](spark, str(TABLES))._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "Python" not in plan, name
