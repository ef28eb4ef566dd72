"""Structured Streaming: ingest, ordered vs first-seen dedup, late data."""

import json
import os

import pytest

from pyspark.sql import functions as F

from aeolus import schemas
from aeolus.sinks import write_bronze
from aeolus.sources.bronze import read_bronze
from aeolus.streaming import runner
from aeolus.streaming.ingest import checkpoint_root, ingest_all, ingest_domain, wait_all
from aeolus.streaming.metrics import hourly_stream
from aeolus.streaming.silver import silver_stream


def env(eid, observed, t=1.0, ingest="2024-01-05T10:00:05Z"):
    return {"ingest_ts": ingest, "source": "open_meteo_current", "schema_v": 1, "author": "me",
            "event_id": eid,
            "payload": {"city": "Kyiv", "latitude": 50.4, "longitude": 30.5, "elevation_m": 1.0,
                        "observed_at": observed,
                        "metrics": {"temperature_2m": t, "relative_humidity_2m": 50.0,
                                    "precipitation": 0.0, "wind_speed_10m": 1.0,
                                    "wind_direction_10m": 0.0, "surface_pressure": 1.0},
                        "units": {}}}


def drop(landing, name, records):
    os.makedirs(landing, exist_ok=True)
    with open(os.path.join(landing, name), "w") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")


def test_ingest_available_now(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "bronze")
    drop(landing, "a.json", [env("a", "2024-01-05T10:00"), env("b", "2024-01-05T11:00",
                                                               ingest="2024-01-05T11:00:01Z")])
    q = ingest_domain(spark, landing, root, "weather", "open_meteo_current",
                      schemas.WEATHER_ENVELOPE, interval_seconds=0,
                      checkpoint=os.path.join(tmp_dir, "progress"))
    q.awaitTermination()
    back = read_bronze(spark, root, "weather", "open_meteo_current", schemas.WEATHER_ENVELOPE)
    assert sorted(r.hour for r in back.select("hour").collect()) == ["10", "11"]


def _stream(spark, landing, mode):
    s = spark.readStream.schema(schemas.WEATHER_ENVELOPE).json(landing)
    return silver_stream(s, producer="me", delay="1 hour", mode=mode)


def test_late_duplicates_dropped_and_counted(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    drop(landing, "1.json", [env("x", "2024-01-05T10:00", t=2.0, ingest="2024-01-05T10:00:09Z"),
                             env("x", "2024-01-05T10:00", t=1.0, ingest="2024-01-05T10:00:01Z"),
                             env("y", "2024-01-05T13:00")])
    df = _stream(spark, landing, "ordered")
    q, out = runner.start(df, "t_late", spark, run="fixed")
    q.awaitTermination()
    first = spark.read.parquet(out).collect()
    # Ordered dedup keeps the earliest ingest; "y" is still within the delay.
    assert [(r.event_id, r.temperature_2m) for r in first] == [("x", 1.0)]
    drop(landing, "2.json", [env("x", "2024-01-05T10:00", t=3.0), env("z", "2024-01-05T09:00")])
    q2, _ = runner.start(_stream(spark, landing, "ordered"), "t_late", spark, run="fixed")
    q2.awaitTermination()
    assert runner.rows_dropped_by_watermark(q2) >= 1
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["x"]


def test_first_seen_mode_and_hourly_windows(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    drop(landing, "1.json", [env("a", "2024-01-05T10:10", t=1.0), env("a", "2024-01-05T10:10", t=1.0),
                             env("b", "2024-01-05T10:20", t=3.0), env("c", "2024-01-05T12:30")])
    dedup, _ = runner.run_available_now(_stream(spark, landing, "first_seen"), "t_first", spark)
    assert dedup.count() == 3
    hourly, _ = runner.run_available_now(
        hourly_stream(_stream(spark, landing, "ordered"), delay=None), "t_hourly", spark)
    rows = hourly.collect()
    assert [(r.window_hour, r.samples_cnt, r.temperature_avg_c) for r in rows] == [("10", 2, 2.0)]
    assert F is not None


def test_ordered_dedup_aggregates_before_state_store(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    drop(landing, "1.json", [env("a", "2024-01-05T10:10"), env("a", "2024-01-05T10:10"),
                             env("b", "2024-01-05T13:20")])
    q, _ = runner.start(_stream(spark, landing, "ordered"), "t_plan", spark)
    q.awaitTermination()
    plan = q._jsq.explainInternal(True)
    assert "StateStoreSave" in plan
    assert "partial_min_by" in plan or "partial_min(" in plan


def _round(session, tmp_dir):
    running, failed = ingest_all(
        session, os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "bronze"),
        {"weather": ("open_meteo_current", schemas.WEATHER_ENVELOPE),
         "missing": ("nowhere", schemas.WEATHER_ENVELOPE)},
        interval_seconds=0, checkpoint=os.path.join(tmp_dir, "progress"))
    return failed | wait_all(running, 0.1)


def test_ingest_goes_on_after_a_restart_and_isolates_failures(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing", "weather")
    drop(landing, "a.json", [env("a", "2024-01-05T10:00"), env("b", "2024-01-05T11:00")])
    # The domain without a landing folder fails alone.
    assert set(_round(spark.newSession(), tmp_dir)) == {"missing"}
    drop(landing, "b.json", [env("c", "2024-01-05T12:00"), env("d", "2024-01-05T13:00")])
    assert set(_round(spark.newSession(), tmp_dir)) == {"missing"}
    back = read_bronze(spark, os.path.join(tmp_dir, "bronze"), "weather", "open_meteo_current",
                       schemas.WEATHER_ENVELOPE)
    assert sorted(r.event_id for r in back.collect()) == ["a", "b", "c", "d"]


def test_batch_and_stream_rows_are_both_read(spark, tmp_dir):
    root = os.path.join(tmp_dir, "bronze")
    drop(os.path.join(tmp_dir, "landing", "weather"), "a.json", [env("a", "2024-01-05T10:00")])
    _round(spark, tmp_dir)
    batch = spark.createDataFrame([env("z", "2024-01-05T10:00")], schemas.WEATHER_ENVELOPE)
    write_bronze(batch, root, "weather", "open_meteo_current")
    back = read_bronze(spark, root, "weather", "open_meteo_current", schemas.WEATHER_ENVELOPE)
    assert sorted(r.event_id for r in back.collect()) == ["a", "z"]


def test_ingest_needs_a_lasting_checkpoint(spark):
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        with pytest.raises(ValueError, match="checkpoint"):
            checkpoint_root(spark)
    assert checkpoint_root(spark, "/x/y/") == "/x/y"


def test_resumed_stream_emits_windows_left_open(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    drop(landing, "1.json", [env("a", "2024-01-05T10:10"), env("b", "2024-01-05T10:50")])
    run = os.path.basename(tmp_dir)
    first, _ = runner.run_available_now(_stream(spark, landing, "ordered"), "t_resume", spark, run=run)
    assert first.count() == 0
    drop(landing, "2.json", [env("c", "2024-01-05T14:00")])
    then, _ = runner.run_available_now(_stream(spark, landing, "ordered"), "t_resume", spark, run=run)
    assert sorted(r.event_id for r in then.collect()) == ["a", "b"]
