"""Every registered query against its SQL, and the shape of its plan."""

import pytest

from check import compare, connect
from conftest import SF_DIR
from dugout.plans.catalog import ORACLES, QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    ok, text, _ = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert ok, text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"gbt_predict", "roster_full", "model_contract", "target_models", "nominal_slots"}))
def test_plan_has_no_nested_loop_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["listing_range_prune"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_forecast_reads_only_its_window(spark):
    plan = QUERIES["forecast_day_sums"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_group_limit_runs_before_the_shuffle(spark):
    plan = QUERIES["topk_per_group"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
