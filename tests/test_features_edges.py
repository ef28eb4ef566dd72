"""Feature-dataset edge cases and plan shape."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aeolus.functions import calendar_features, direction_bucket
from aeolus.operators import features as fe


def test_null_heading_falls_to_west(spark):
    df = spark.createDataFrame([(None,), (0.0,), (44.99,), (45.0,), (135.0,), (224.9999999999999,),
                                (225.0,), (315.0,)], "d double")
    got = [r.b for r in df.select(direction_bucket("d").alias("b")).collect()]
    assert got == ["W", "N", "N", "E", "S", "S", "W", "N"]
    snapped = [r.b for r in df.select(direction_bucket("d", 9).alias("b")).collect()]
    assert snapped == ["W", "N", "N", "E", "S", "W", "W", "N"]


def test_week_conventions(spark):
    # 2024-01-07 is a Sunday, 2024-01-08 a Monday.
    df = spark.createDataFrame([(datetime(2024, 1, 7, 13),), (datetime(2024, 1, 8, 0),)], "t timestamp")
    sun = df.select(*[c.alias(n) for n, c in calendar_features("t", "sunday").items()]).collect()
    mon = df.select(*[c.alias(n) for n, c in calendar_features("t", "monday").items()]).collect()
    assert [(r.hour_of_day, r.day_of_week, r.is_weekend) for r in sun] == [(13, 0, 1), (0, 1, 0)]
    assert [(r.day_of_week, r.is_weekend) for r in mon] == [(6, 1), (0, 0)]
    with pytest.raises(ValueError):
        calendar_features("t", "friday")


def test_lenient_coercion_and_closure_filter(spark):
    df = spark.createDataFrame(
        [("2024-01-05 10:00:00", 50.3, 30.5, "40", "60", "90", "0.5", False),
         ("2024-01-05 10:00:00", 50.3, 30.5, "NaN", "60", "90", "0.5", False),
         ("garbage", 50.3, 30.5, "40", "60", "90", "0.5", False),
         ("2024-01-05 10:00:00", 50.3, 30.5, "abc", "60", "90", "0.5", False),
         ("2024-01-05 10:00:00", 50.3, 30.5, "40", "60", "90", "0.5", None),
         ("2024-01-05 10:00:00", 50.3, 30.5, "40", "60", "90", "0.5", True)],
        "event_ts string, lat double, lon double, current_speed_kmh string, "
        "free_flow_speed_kmh string, current_travel_time_s string, confidence string, "
        "road_closure boolean")
    c = fe.coerce_road(df)
    assert dict(c.dtypes)["current_speed_kmh"] == "double"
    assert c.filter(F.col("current_speed_kmh").isNull()).count() == 2
    assert c.filter(F.col("event_ts").isNull()).count() == 1
    kept = fe.road_filter(c).withColumns({"road_id": F.lit("r1"), "road_name": F.lit("R1")})
    assert kept.count() == 2  # NaN/bad speed, null closure and closed road dropped
    out = fe.road_features(kept).first()
    assert out.speed_ratio == pytest.approx(40 / 60) and out.is_congested == 1


def test_min_support_and_std_fill(spark):
    rows = [(datetime(2024, 1, 5, 10, m), 50.301, 30.501, 10.0 + m, 90.0) for m in range(3)]
    rows += [(datetime(2024, 1, 5, 11), 50.301, 30.501, 30.0, None)]
    df = spark.createDataFrame(rows, "event_ts timestamp, lat double, lon double, speed double, heading double")
    cells = fe.cell_hour_stats(fe.prepare_probes(df))
    single = cells.filter(F.hour("event_hour") == 11).first()
    assert single.speed_std_kmh == 0.0 and single.heading_sin is None
    lab = fe.label_cells(fe.with_heading(cells)).collect()
    assert len(lab) == 1 and lab[0].events_count == 3 and lab[0].is_congested == 1
    assert lab[0].direction_bucket == "E"


def test_hours_bound_controls_broadcast(spark):
    t = spark.createDataFrame([(datetime(2024, 1, 5, 10), 1)], "event_hour timestamp, x int")
    w = spark.createDataFrame([(datetime(2024, 1, 5, 10), 2.0)], "event_hour timestamp, temp_c double")
    assert fe.hours_in_range("2024-01-05", "2024-01-25") == 480
    assert fe.hours_in_range(None, "2024-01-25") is None
    bounded = fe.join_weather(t, w, "2024-01-05", "2024-01-25")
    assert "broadcast" in bounded._jdf.queryExecution().analyzed().toString().lower() or \
        "BroadcastHashJoin" in bounded._jdf.queryExecution().executedPlan().toString()
    huge = fe.join_weather(t, w, "1900-01-01", "2200-01-01", max_broadcast_hours=1000)
    assert "broadcast" not in huge._jdf.queryExecution().logical().toString().lower()


def test_bbox_pushed_to_parquet_scan(spark):
    from conftest import SF001
    from aeolus.sources import landing
    df = fe.in_box(landing.read_layer(spark, SF001, "probe_traffic")).select("lat", "lon")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lat), IsNotNull(lon), GreaterThanOrEqual(lat,50.2)" in plan
    assert "ReadSchema: struct<lat:double,lon:double>" in plan


def test_timestamp_coercion_to_utc(spark):
    df = spark.createDataFrame([("2024-01-05T12:00:00+02:00",), ("2024-01-05 10:30:00",), ("nope",)],
                               "event_ts string")
    got = [r.h for r in fe.coerce_road(df, numeric=()).select(
        F.date_format("event_ts", "yyyy-MM-dd HH:mm").alias("h")).collect()]
    assert got == ["2024-01-05 10:00", "2024-01-05 10:30", None]


def test_direction_edges_are_exact(spark):
    want = {314.9999999999: "W", 315.0: "N", 44.9999999999: "N", 45.0: "E", 134.99: "E", 135.0: "S",
            224.99: "S", 225.0: "W", 0.0: "N", 359.9: "N", None: "W"}
    df = spark.createDataFrame([(d,) for d in want], "d double")
    got = {r.d: r.b for r in df.select("d", direction_bucket("d").alias("b")).collect()}
    assert got == want


def test_launcher_partition_count_is_kept(spark):
    from aeolus.session import build_session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "777")
        assert build_session("again").conf.get("spark.sql.shuffle.partitions") == "777"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
