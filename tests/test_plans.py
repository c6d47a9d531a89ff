"""Physical plan checks: pushdown, pruning, top-k, checked broadcasts, no
row-pair joins, no Python on data rows."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

Q = entry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_filters_reach_the_parquet_scan(spark):
    text = _formatted(Q["platform_filtered"](spark, SF_SMALL))
    assert "GreaterThan(price,0.0)" in text and "GreaterThan(averagePlaytime,0)" in text


def test_column_pruning_on_driver_tables(spark):
    text = _formatted(Q["hist_lineitem_price"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in text


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(Q["popularity_top10"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in _plan(Q["sql_top_popularity"](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["box_lineitem_flag", "kde_genre"])
def test_summary_is_broadcast_not_the_data(spark, name):
    text = _formatted(Q[name](spark, SF_SMALL))
    # the broadcast side is the materialized summary (an RDD scan), never parquet
    for block in text.split("BroadcastExchange")[1:]:
        head = block.split("\n")[1:3]
        assert not any("Scan parquet" in line for line in head), block[:300]
    assert "BroadcastHashJoin" in text


@pytest.mark.parametrize("name", sorted(n for n in set(Q) - {"ingest_stream", "ingest_twice", "regression_summary", "tree_model",
                                                     "forest_importances", "inspect_landed", "pipeline"}
                                  if not re.match(r"tukey|op\d", n)))
def test_no_cartesian_or_nested_loop_joins(spark, name):
    plan = _plan(Q[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["tukey_platform", "tukey_orders_priority"])
def test_tukey_pairs_are_pairs_of_summary_rows(spark, name):
    plan = _plan(Q[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "FileScan" not in plan
    assert plan.count("BroadcastNestedLoopJoin") == 1


def test_python_udfs_only_on_summary_rows(spark):
    plan = _plan(Q["levene_platform_test"](spark, SF_SMALL))
    assert "ArrowEvalPython" in plan
    below = plan.split("ArrowEvalPython")[1]
    # the UDF sits above the final single-row aggregate
    assert "HashAggregate(keys=[]" in below


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.1"])
def test_exact_ranks_use_bucketed_windows_at_any_size(spark, sf):
    """No data window without a bucket: the only other windows run over the
    per-bucket totals."""
    plan = _plan(Q["mannwhitney_lineitem_flag"](spark, sf))
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and any("_cin" in line for line in windows)
    for line in windows:
        assert "_bucket" in line or "_bt" in line, line


def test_dedupe_is_one_partial_aggregate_shuffle(spark):
    plan = _plan(Q["dedupe_rows"](spark, SF_SMALL))
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
