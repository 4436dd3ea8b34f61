"""Every registered query against its SQL text, and the shape of its plan."""

import pytest

from rowmill.catalog import all_queries
from tests.compare import compare

QUERIES = all_queries()
# plans with a user's own pandas function
OWN_FUNCTION = {"udf_1_two_column_function"}


def check_plan(name, df):
    plan = df._jdf.queryExecution().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    if name not in OWN_FUNCTION and not name.startswith(("rsm_", "win_3", "cmp_1_rebalanced")):
        assert "ArrowEvalPython" not in plan and "InPandas" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, folder, name):
    def run(spark, folder):
        df = QUERIES[name].run(spark, folder)
        check_plan(name, df)
        return df

    result, rows = compare(spark, con, folder, run, QUERIES[name].sql)
    assert result in ("ok", "rows only")
    assert rows > 0


def test_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) <= set(e.queries())
    assert not any(n.startswith(("op", "llm")) or "pipeline" in n for n in QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["Geography", "CreditScoreBins", "customers", "churn_share", "mean_age"]
    assert df.count() > 0


def test_filter_and_columns_reach_the_scan(spark, folder):
    from rowmill.operators.profile import value_counts

    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet").filter("l_quantity > 40")
    plan = value_counts(lineitem, "l_returnflag")._jdf.queryExecution().toString()
    assert "GreaterThan(l_quantity,40.0)" in plan
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan
