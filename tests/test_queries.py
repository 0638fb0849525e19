"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as contract
import oracle

# The queries of the subpackage for training data have their tests beside it.
QUERIES = {name: run for name, run in contract.queries().items() if name not in contract.CORPUS}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, folder, duck):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name in SQL:
        assert oracle.compare(df, duck, SQL[name]) is None
    else:
        assert df.count() > 0


def test_only_queries_beyond_sql_have_none():
    assert set(QUERIES) - set(SQL) == {"file_manifest", "kmeans_best_of_n"}
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 10
    assert [r["total_lines"] for r in rows] == sorted((r["total_lines"] for r in rows), reverse=True)
