"""Physical-plan guards: the joins that would be quadratic when written
naively must stay equi-joins."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # run so AQE settles the final plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["client_files", "client_files_component", "changed_clients", "plan_diff",
                                 "match_pairs", "latest_changes", "batch_contents"])
def test_no_cartesian_or_nested_loop(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark):
    from foliant import fixtures as fx
    df = fx.fx_catalog(spark, SF).select("id", "name")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan and "o_totalprice" not in plan
