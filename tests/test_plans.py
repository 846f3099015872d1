"""Plan checks and the driver contract."""

import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["l_returnflag", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "n"]


def test_every_query_has_callable_and_oracles_are_subset():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 80


TIER1 = sorted(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", TIER1)
def test_sql_checked_plans_have_no_row_udfs(spark, name):
    df = entry_mod.queries()[name](spark, SF)
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    df = entry_mod.queries()["join_inner"](spark, SF)
    df.collect()
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    # lineitem scan reads only the four columns the query needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan
