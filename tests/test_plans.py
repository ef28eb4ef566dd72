"""Physical-plan properties the design relies on at scale."""

import re

import pytest

from aeolus.plans.catalog import QUERIES
from conftest import SF001


def plan(spark, name):
    df = QUERIES[name](spark, SF001)
    df.write.format("noop").mode("overwrite").save()  # final AQE plan
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(p):
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                          r"Exchange RoundRobin|Exchange SinglePartition", p))


def test_reject_report_has_no_window(spark):
    p = plan(spark, "silver_reject_report")
    assert "Window" not in p and "partial_count" in p


def test_silver_dedup_limits_before_shuffle(spark):
    p = plan(spark, "silver_weather")
    assert "WindowGroupLimit" in p and ", Partial" in p


def test_response_expansion_is_narrow(spark):
    p = plan(spark, "response_expand")
    assert exchanges(p) == 0 and "Generate" in p


@pytest.mark.parametrize("name", ["temperature_hourly", "precipitation_daily", "wind_daily_extremes",
                                  "kpt_cell_hour", "hourly_snapshot", "heatmap_predicted",
                                  "weather_hourly"])
def test_aggregates_are_partial_before_shuffle(spark, name):
    p = plan(spark, name)
    assert "partial_" in p


def test_only_bounded_side_is_broadcast(spark):
    p = plan(spark, "tomtom_weather")
    assert "BroadcastHashJoin" in p
    assert p.count("BroadcastExchange") == 1


def test_no_single_partition_exchange_in_core_queries(spark):
    for name in ("silver_weather", "temperature_hourly", "kpt_labelled", "tomtom_weather",
                 "silver_reject_report", "onehot_levels"):
        assert "SinglePartition" not in plan(spark, name), name


def test_scan_reads_only_needed_columns(spark):
    p = plan(spark, "time_range")
    assert "ReadSchema: struct<src_id:bigint,event_ts:timestamp>" in p
