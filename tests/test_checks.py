"""Every registered query beside its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from checks import all_queries, all_sql
from checks.compare import spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_its_sql(spark, name):
    df = all_queries()[name](spark, SF_DIR)
    assert spark_rows(df) == sql_rows(all_sql()[name], SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns == ["data", "estado", "precipitacao_media_diaria"]



@pytest.mark.parametrize(
    "name, parts",
    [
        ("q_monthly_sum", ["ReadSchema: struct<l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>"]),
        ("q_daily_price_mean", ["ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>"]),
        ("q_state_series", ["EqualTo(l_returnflag,R)"]),
        ("q_date_filter", ["GreaterThanOrEqual(o_orderdate,1996-01-01", "LessThan(o_orderdate,1999-01-01"]),
        ("q_join_rows", ["GreaterThanOrEqual(l_shipdate,1996", "LessThan(o_orderdate,1999"]),
        ("q_trend", ["ReadSchema: struct<l_quantity:double,l_extendedprice:double>"]),
        ("q_head", ["TakeOrderedAndProject(limit=5"]),
    ],
)
def test_scans_are_pruned_and_filters_pushed(spark, name, parts):
    df = all_queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for part in parts:
        assert part in plan, part
