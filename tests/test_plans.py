"""Plans that must hold at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from costalloc.operators import correlate, measures, reports, sinks, summaries
from costalloc.plans.fact import correlated_fact, windowed_cost, windowed_usage
from costalloc.session import run_dir
from costalloc.sources import store
from costalloc.sources import testtables as tt


def _final_plan(frame):
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.fixture(params=["broadcast allowed", "no broadcast"])
def joined(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if request.param == "no broadcast" else "10MB")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def _fact(spark, small):
    return correlated_fact(tt.telemetry(spark, small), tt.billing(spark, small), tt.AS_OF)


def test_events_are_scanned_once(spark, small, joined):
    plan = _final_plan(_fact(spark, small))
    assert len(re.findall(r"FileScan parquet.*event_id", plan)) == 1
    assert len(re.findall(r"FileScan parquet.*l_orderkey", plan)) == 1
    assert plan.count("ReusedExchange") == 1
    assert "Window" not in re.sub(r"TimeWindow|WindowDate", "", plan)
    if joined == "no broadcast":
        assert plan.count("SortMergeJoin") == 2


def test_columns_are_pruned(spark, small):
    plan = _final_plan(tt.telemetry(spark, small).select("StatusCode"))
    assert "ReadSchema: struct<event_type:string>" in plan


def test_time_filter_reaches_the_scan(spark, small):
    rows = spark.read.parquet(f"{small}/events.parquet").where("ts >= TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in _final_plan(rows)


@pytest.mark.parametrize("operator", [
    summaries.cost_breakdowns, summaries.correlation_summary, summaries.store_summary, reports.kpi_core,
    reports.daily_cost_trend])
def test_one_pass(spark, small, operator):
    plan = _final_plan(operator(_fact(spark, small)))
    assert len(re.findall(r"FileScan parquet.*event_id", plan)) == 1


def test_ranking_has_no_single_task_window(spark, small):
    plan = _final_plan(measures.device_rank(_fact(spark, small)))
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
    assert windows and all(w.strip() for w in windows)


def test_a_range_of_the_stored_fact_reads_only_its_days(spark, small):
    base = run_dir(spark, "t")
    fact = _fact(spark, small)
    sinks.write_by_window(fact, base, dt.datetime(2024, 1, 31))
    late = fact.where("TimeWindow >= TIMESTAMP '2024-01-10'").withColumn("AllocatedCost", F.lit(2.0))
    sinks.write_by_window(late, base, dt.datetime(2024, 1, 31, 0, 6))
    rows = store.read_windows(spark, base, "2024-01-08 06:00:00", "2024-01-12")
    plan = _final_plan(rows)
    assert "PartitionFilters: [isnotnull(WindowDate" in plan
    want = fact.where("TimeWindow >= TIMESTAMP '2024-01-08 06:00:00' AND TimeWindow < TIMESTAMP '2024-01-12'")
    assert rows.count() == want.count() > 0
    newest = rows.where("TimeWindow >= TIMESTAMP '2024-01-10'")
    assert newest.where("AllocatedCost <> 2.0").count() == 0 and newest.count() > 0


def test_methods_share_one_join(spark, small):
    usage = windowed_usage(tt.telemetry(spark, small), decay_hours=2.0)
    plan = _final_plan(correlate.allocated_by_all(usage, windowed_cost(tt.billing(spark, small))))
    assert len(re.findall(r"FileScan parquet.*event_id", plan)) == 1
    assert len(re.findall(r"(?:SortMergeJoin|BroadcastHashJoin) ", plan)) == 2
