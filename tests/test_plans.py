"""Shapes that have to hold at any size, for every registered batch query."""

import re

import pytest

import __spark_entry__ as entry_points
from conftest import TESTDATA, plan_text

SF = str(TESTDATA / "sf0.001")
# Their result is a written table; the plans that wrote it are the operators' own.
WRITTEN = {"merge_live_metrics", "merge_daily_summary", "merge_anomalies", "stream_live_metrics",
           "stream_dedup", "stream_daily_summary", "stream_dead_letters"}
QUERIES = [name for name in entry_points.queries() if name not in WRITTEN]
EXCHANGES = {
    "payload_decode": 0, "json_parse": 0, "valid_orders": 0, "dead_letters": 0,
    "dead_letter_reasons": 0, "order_json_encode": 0, "event_time": 0, "revenue_projection": 0,
    "tumbling_window": 1, "window_sku_revenue": 1, "live_metrics": 2, "latest_windows": 2,
    "part_daily_top": 2, "daily_summary_all": 2, "hourly_orders": 2, "daily_report": 3,
}


@pytest.mark.parametrize("name", QUERIES)
def test_shape(spark, name):
    frame = entry_points.queries()[name](spark, SF)
    plan = plan_text(frame)
    for bad in ("CartesianProduct", "NestedLoopJoin", "SinglePartition", "EvalPython", "InPandas"):
        assert bad not in plan
    optimized = frame._jdf.queryExecution().optimizedPlan().toString()
    scans = len(re.findall(r"^[ :+|-]*Relation ", optimized, re.M))
    parses = optimized.count("from_json(")
    assert parses <= scans
    if name in EXCHANGES:
        assert plan.count("\nArguments: hashpartitioning") == EXCHANGES[name]


def test_projection_reads_only_its_columns(spark):
    plan = plan_text(entry_points.queries()["part_daily_top"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
    plan = plan_text(entry_points.queries()["payload_decode"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,props:string>" in plan


@pytest.mark.parametrize("name", ["day_filter", "daily_summary"])
def test_day_is_pushed_to_the_scan(spark, name):
    plan = plan_text(entry_points.queries()[name](spark, SF))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2024-01-15T00:00\), "
                     r"LessThan\(ts,2024-01-16T00:00\)", plan)
