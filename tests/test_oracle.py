import os

import pytest

import __spark_entry__ as contract
from check import compare, oracle

SF = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"


@pytest.fixture(scope="module")
def db():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_oracle(spark, db, name):
    df = contract.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    ours = df.toPandas()
    assert len(ours)
    assert compare(ours, db.sql(contract.oracle_sql()[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    assert contract.queries()[name](spark, SF).count()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["account", "hour", "day_of_week", "metric", "value"]
    assert not df.isEmpty()


def test_oracles_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
