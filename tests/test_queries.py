import os

import pytest

from docflux import queries as core
from tests.oracle import DATA, connect, spark_rows, sql_rows

SF = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_query_equals_its_sql(spark, db, name):
    assert spark_rows(core.QUERIES[name](spark, SF)) == sql_rows(db, core.SQL[name])


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.SQL)))
def test_query_without_sql_runs(spark, name):
    df = core.QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns) and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_plans_have_no_cartesian_product(spark):
    for name in ("coverage_rowwise", "alerts", "pending_embeddings", "merge_events", "knn_topk"):
        plan = core.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scan_reads_only_the_columns_needed(spark):
    plan = core.QUERIES["doc_length_profile"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<clean_text:string>" in plan
