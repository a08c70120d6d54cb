"""Registered queries against DuckDB, and checks on their plans."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

import compare  # noqa: E402

from tickloom import suite  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = suite.queries()
ORACLE = suite.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    mine = compare.rows_of_spark(QUERIES[name](spark, SF))
    if name in ORACLE:
        assert compare.differences(mine, compare.rows_of_duckdb(duck, ORACLE[name])) is None
    else:
        assert len(mine)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["W3_simple_averages", "W6_rsi", "W13_lags", "W19_W20_extrema_counts"])
def test_no_window_over_everything_and_no_cross_join(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_date_slices_and_columns_reach_the_scan(spark):
    plan = physical(QUERIES["P9_inclusive_date_slice"](spark, SF))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan
