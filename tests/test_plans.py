"""Scale guards on the physical plans of every registered query."""

import pytest

import __spark_entry__ as E
from shopcube.plans.registry import QUERIES
from tests.conftest import SF001

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set",
             "PythonUDF", "BatchEvalPython", "ArrowEvalPython"]
EXPAND_OK = {"sales_cube", "sales_cube_levels", "time_rollup"}   # grouping sets over pre-aggregated rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_scale_hazards(spark, name):
    df = QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in FORBIDDEN if w in plan], plan
    if name not in EXPAND_OK:
        assert "Expand" not in plan, plan


def test_scans_are_pruned_and_filters_pushed(spark):
    df = E.queries()["product_performance"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # lineitem: 5 of 11 columns read; orders: 2 of 6 and the status filter pushed
    assert "FileScan parquet [l_orderkey#" in plan
    scan = plan[plan.index("FileScan parquet [l_orderkey"):].split("]")[0]
    assert scan.count(",") == 4
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
    assert "Not(EqualTo(o_orderstatus,P))" in plan
