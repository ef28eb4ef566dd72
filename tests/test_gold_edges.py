"""Gold edge cases and fused-pair equivalence."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aeolus.operators import gold

COLS = ("event_ts timestamp, city string, temperature_2m double, relative_humidity_2m double, "
        "precipitation double, wind_speed_10m double, wind_direction_10m double")


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_single_sample_stddev_is_zero(spark):
    df = frame(spark, [(datetime(2024, 1, 1, 10, 5), "Kyiv", 3.0, 50.0, 0.0, 1.0, 90.0)])
    r = gold.temperature_hourly(df).first()
    assert r.temperature_stddev_c == 0.0 and r.window_hour == "10" and r.window_date == "2024-01-01"


def test_calm_day_points_north_and_null_direction_ignored(spark):
    df = frame(spark, [(datetime(2024, 1, 1, 1), "Kyiv", 0.0, 50.0, 0.0, 0.0, 270.0),
                       (datetime(2024, 1, 1, 2), "Kyiv", 0.0, 50.0, 0.0, 4.0, None)])
    r = gold.wind_daily_extremes(df).first()
    assert r.prevailing_wind_deg == 0.0
    assert r.mean_wind_vector_ms == 0.0
    assert r.wind_speed_max_ms == 4.0 and r.wind_speed_avg_ms == 2.0


def test_prevailing_direction_west(spark):
    df = frame(spark, [(datetime(2024, 1, 1, 1), "Kyiv", 0.0, 50.0, 0.0, 5.0, 270.0)])
    r = gold.wind_daily_extremes(df).first()
    assert r.prevailing_wind_deg == pytest.approx(270.0)
    assert r.mean_wind_vector_ms == pytest.approx(5.0)


def test_rain_threshold_and_subzero_are_per_hour(spark):
    rows = [(datetime(2024, 1, 1, 1, 0), "Kyiv", 0.0, 50.0, 0.05, 1.0, 0.0),
            (datetime(2024, 1, 1, 1, 30), "Kyiv", -0.5, 50.0, 0.05, 1.0, 0.0),
            (datetime(2024, 1, 1, 2, 0), "Kyiv", 0.0, 50.0, 0.09, 1.0, 0.0)]
    p = gold.precipitation_daily(frame(spark, rows)).first()
    assert p.hours_observed == 2 and p.rainy_hours == 1
    z = gold.subzero_hours_daily(frame(spark, rows)).first()
    assert z.subzero_hours == 1 and z.coldest_hour_temp_c == -0.5


def test_null_city_dropped(spark):
    df = frame(spark, [(datetime(2024, 1, 1, 1), None, 1.0, 50.0, 0.0, 1.0, 0.0)])
    assert gold.temperature_hourly(df).count() == 0


def test_fused_pairs_equal_individual(spark):
    from conftest import SF001
    from aeolus.plans.catalog import silver_fixture
    s = silver_fixture(spark, SF001)
    levels = gold.shared_levels(gold.select_metrics("weather"))
    assert sorted(map(sorted, levels)) == [
        ["comfort_index_hourly", "temperature_hourly"],
        ["precipitation_daily", "subzero_hours_daily"], ["wind_daily_extremes"]]
    shared = {n: gold.output(gold.aggregate(s, names), n) for names in levels for n in names}
    g1, g5 = shared["temperature_hourly"], shared["comfort_index_hourly"]
    g2, g4 = shared["precipitation_daily"], shared["subzero_hours_daily"]

    def same(a, b):
        cols = sorted(b.columns)
        ra = sorted(tuple(r) for r in a.select(*cols).collect())
        rb = sorted(tuple(r) for r in b.select(*cols).collect())
        assert len(ra) == len(rb)
        for x, y in zip(ra, rb):
            assert x == pytest.approx(y) if all(isinstance(v, float) for v in x) else True
            for u, v in zip(x, y):
                assert u == pytest.approx(v) if isinstance(u, float) else u == v

    same(g1, gold.temperature_hourly(s))
    same(g5, gold.comfort_index_hourly(s))
    same(g2, gold.precipitation_daily(s))
    same(g4, gold.subzero_hours_daily(s))


def test_metric_registry():
    assert set(gold.select_metrics("weather")) == {
        "temperature_hourly", "precipitation_daily", "wind_daily_extremes",
        "subzero_hours_daily", "comfort_index_hourly"}
    assert list(gold.select_metrics("weather", ["wind_daily_extremes"])) == ["wind_daily_extremes"]
    with pytest.raises(ValueError):
        gold.select_metrics("weather", ["nope"])
    with pytest.raises(ValueError):
        gold.select_metrics("traffic")


def test_wind_unit_option(spark):
    df = frame(spark, [(datetime(2024, 1, 1, 1), "Kyiv", 0.0, 50.0, 0.0, 36.0, 0.0)])
    assert gold.wind_daily_extremes(df, "kmh_to_ms").first().wind_speed_max_ms == pytest.approx(10.0)
    with pytest.raises(ValueError):
        gold.wind_daily_extremes(df, "mph")


def test_gold_aggregates_partially_before_shuffle(spark):
    df = frame(spark, [(datetime(2024, 1, 1, 1), "Kyiv", 0.0, 50.0, 0.0, 1.0, 0.0)])
    plan = gold.temperature_hourly(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 or "partial" in plan.lower()
    assert F is not None
