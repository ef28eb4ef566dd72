"""Exact split, late counts over many batches, closing windows, versions, rows of one run."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from aeolus import schemas
from aeolus.operators.ml import prep
from aeolus.plans import jobs
from aeolus.sinks import write_hourly
from aeolus.sources.silver import read_hourly, read_silver_recursive
from aeolus.streaming import runner
from aeolus.streaming.metrics import daily_stream
from aeolus.streaming.silver import close_input, marker_stream, silver_stream
from aeolus.streaming.traffic import road_weather_stream
from test_streaming import drop, env


# ---- split ------------------------------------------------------------------

def test_exact_split(spark):
    rows = [(k, None if k % 50 == 0 else int(k % 7 == 0), "x") for k in range(3000)] + [(9001, 5, "x"), (9002, 6, "x"), (9003, 6, "x"), (9004, 6, "x")]
    df = spark.createDataFrame(rows, "key long, label int, is_test_like string").repartition(5)
    got = prep.exact_split(df, "key", "label").collect()
    assert len(got) == len(rows) and got[0].is_test_like == "x"
    for label in {r[1] for r in rows}:
        own = sorted((hashlib.sha1(str(k).encode()).hexdigest()[:15], k) for k, v, _ in rows if v == label)
        test = {k for _, k in own[: int(0.2 * len(own) + 0.5)]}
        assert {r.key for r in got if r.label == label and r.is_test} == test
    assert prep.exact_split(df.limit(0), "key", "label").count() == 0
    other = prep.exact_split(df, "key", "label", 0.5, seed=7)
    assert other.where("is_test AND label = 1").count() == int(0.5 * sum(v == 1 for _, v, _ in rows) + 0.5)


# ---- late rows --------------------------------------------------------------

def _stream(spark, landing, markers=None, **options):
    reader = spark.readStream.schema(schemas.WEATHER_ENVELOPE).options(**options)
    return silver_stream(reader.json(landing), producer="me", delay="1 hour", markers=markers)


def test_late_rows_counted_beyond_the_progress_buffer(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    for i in range(12):  # every file after the first two holds two late rows
        drop(landing, f"{i:02}.json", [env(f"n{i}", f"2024-01-{5 + i:02}T10:00"), *(
            [env(f"a{i}", "2024-01-01T10:00"), env(f"b{i}", "2024-01-01T11:00")] if i > 1 else [])])
        os.utime(os.path.join(landing, f"{i:02}.json"), (i + 1, i + 1))
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    q, _ = runner.start(_stream(session, landing, maxFilesPerTrigger=1), "t_log", session)
    with runner.ProgressLog(q, 0.05) as log:
        q.awaitTermination()
    assert log.rows_dropped == 20
    assert len(q.recentProgress) <= 3 and runner.rows_dropped_by_watermark(q) < 20
    table = log.table(spark).collect()
    assert sum(r.input_rows for r in table) == 32 and [r.batch_id for r in table] == list(range(len(table)))


def test_progress_log_tells_of_missed_batches(spark):
    class Query:
        recentProgress = [{"batchId": k, "numInputRows": 1, "stateOperators": []} for k in (0, 3)]

    with pytest.raises(RuntimeError, match=r"\[1, 2\]"):
        with runner.ProgressLog(Query()):
            pass


# ---- closing ----------------------------------------------------------------

def test_marked_end_emits_open_windows(spark, tmp_dir):
    landing, folder, run = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "marks"), os.path.basename(tmp_dir)
    drop(landing, "1.json", [env("a", "2024-01-05T10:10", t=2.0), env("b", "2024-01-05T23:50", t=-3.0)])

    def once():
        stream = daily_stream(_stream(spark, landing, marker_stream(spark, folder)), delay=None)
        return runner.run_available_now(stream, "t_close", spark, run=run)[0].collect()

    assert once() == []
    drop(landing, "2.json", [env("c", "2024-01-06T00:10", t=1.0)])
    assert once() == []
    close_input(spark, folder)
    rows = sorted(once(), key=lambda r: r.window_date)
    assert [(r.window_date, r.city, r.hours_observed, r.subzero_hours) for r in rows] == [
        ("2024-01-05", "Kyiv", 2, 1), ("2024-01-06", "Kyiv", 1, 0)]


# ---- hourly versions --------------------------------------------------------

def _hourly(spark, temp):
    return spark.createDataFrame([("2024-01-05 10:00:00", temp, 0.0, 1.0, 50.0)],
                                 "event_hour string, temp_c double, precip_mm double, wind_mps double, humidity_pct double"
                                 ).withColumn("event_hour", F.col("event_hour").cast("timestamp"))


def _reading(spark, folder, minute):
    (spark.createDataFrame([(f"2024-01-05 10:{minute}:00", 50.3, 30.5, "r", "r", 30.0, 60.0, 100.0, 0.9, False)],
                           "event_ts string, lat double, lon double, road_id string, road_name string,"
                           " current_speed_kmh double, free_flow_speed_kmh double, current_travel_time_s double,"
                           " confidence double, road_closure boolean")
     .withColumn("event_ts", F.col("event_ts").cast("timestamp")).write.mode("append").parquet(folder))


def test_stream_joins_the_latest_weather_version(spark, tmp_dir):
    folder, root, run = os.path.join(tmp_dir, "roads"), os.path.join(tmp_dir, "w"), os.path.basename(tmp_dir)
    with pytest.raises(ValueError, match="no version"):
        read_hourly(spark, root)

    def once():
        roads = spark.readStream.schema(schemas.ROAD_TRAFFIC).parquet(folder)
        hourly = read_hourly(spark, root)
        assert "Aggregate" not in hourly._jdf.queryExecution().executedPlan().toString()
        out, _ = runner.run_available_now(road_weather_stream(roads, hourly, "2024-01-05", "2024-01-06"), "t_version", spark, run=run)
        return sorted(r.temp_c for r in out.collect())

    _reading(spark, folder, "05")
    write_hourly(_hourly(spark, 1.0), root, "v1")
    assert once() == [1.0]
    _reading(spark, folder, "15")
    write_hourly(_hourly(spark, 2.0), root, "v2")
    # A version whose record was never written isn't seen.
    _hourly(spark, 3.0).write.parquet(f"{root}/hourly/run_id=v3")
    assert once() == [1.0, 2.0]


# ---- rows of one run --------------------------------------------------------

def test_equal_readings_of_a_run_stay_and_reruns_add_none(spark, tmp_dir):
    rows = [(1.0, 2.0), (1.0, 2.0), (3.0, 4.0), (None, 5.0)]
    for run, own in (("a", rows), ("b", rows + [(6.0, 7.0)]), ("c", rows[1:2])):
        spark.createDataFrame(own, "lat double, lon double").write.parquet(f"{tmp_dir}/t/run_id={run}")
    df = read_silver_recursive(spark, f"{tmp_dir}/t", runs=True)
    got = jobs.one_per_event(df)
    assert got.columns == ["lat", "lon"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows + [(6.0, 7.0)]))
    assert json.dumps(df.columns) == '["lat", "lon", "_run"]'
