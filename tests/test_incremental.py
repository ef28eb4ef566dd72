"""Incremental Silver: only new files are read, the layer equals a full run, kills leave nothing."""

import datetime as dt
import glob
import json
import os

import pytest

from aeolus.plans import incremental as inc
from aeolus.plans import jobs
from aeolus.sinks import manifest, write_bronze
from aeolus.sources import fixtures as fx
from conftest import SF001

SOURCE = "open_meteo_current"
COLUMNS = ["event_id", "ingest_ts", "event_ts", "city", "temperature_2m"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def bronze_rows(spark):
    return fx.weather_bronze(fx.read_table(spark, SF001, "events")).drop("src_id")


def run(spark, base, **options):
    return inc.run_silver_incremental(spark, f"{base}/b", f"{base}/s", SOURCE, producer="fixture", **options)


def test_runs_add_up_to_a_full_run_and_read_only_new_files(spark, tmp_dir):
    env = bronze_rows(spark)
    later = env.ingest_ts >= "2024-01-12"
    write_bronze(env.filter(later), f"{tmp_dir}/b", "weather", SOURCE)
    first = run(spark, tmp_dir)
    assert first.raw_rows > 0 and first.path
    # Files that were read stay unread: with new content of the same age they change nothing.
    for name in glob.glob(f"{tmp_dir}/b/**/*.json", recursive=True):
        age = os.stat(name).st_mtime_ns
        with open(name, "w") as fh:
            fh.write("{}\n" * 1000)
        os.utime(name, ns=(age, age))
        os.remove(os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc"))
    write_bronze(env.filter(~later), f"{tmp_dir}/b", "weather", SOURCE)
    second = run(spark, tmp_dir, overlap="0 seconds")
    assert second.raw_rows == env.filter(~later).count()
    assert first.raw_rows + second.raw_rows == env.count()
    third = run(spark, tmp_dir, overlap="0 seconds")
    assert (third.raw_rows, third.path) == (0, None)

    write_bronze(env, f"{tmp_dir}/whole/b", "weather", SOURCE)
    full = run(spark, f"{tmp_dir}/whole")
    assert rows(inc.current_silver(spark, f"{tmp_dir}/s", SOURCE)) == rows(
        inc.current_silver(spark, f"{tmp_dir}/whole/s", SOURCE))
    assert full.valid_rows == 972
    # Reading everything again adds nothing.
    again = run(spark, f"{tmp_dir}/whole")
    assert again.raw_rows == env.count() and again.valid_rows == 0


def put(base, name, ingest, t):
    folder = f"{base}/b/domain=weather/source={SOURCE}/schema_v=1/ingest_date=2024-01-05/hour=10"
    os.makedirs(folder, exist_ok=True)
    payload = {"city": "Kyiv", "latitude": 50.4, "longitude": 30.5, "elevation_m": 1.0, "observed_at": "2024-01-05T10:00",
               "metrics": {"temperature_2m": t, "relative_humidity_2m": 50.0, "precipitation": 0.0, "wind_speed_10m": 1.0},
               "units": {}}
    with open(f"{folder}/{name}", "w") as fh:
        fh.write(json.dumps({"ingest_ts": ingest, "source": SOURCE, "schema_v": 1, "author": "fixture",
                             "event_id": "e", "payload": payload}) + "\n")


def test_an_earlier_poll_that_lands_later_wins(spark, tmp_dir):
    put(tmp_dir, "1.json", "2024-01-05T10:00:09Z", 9.0)
    run(spark, tmp_dir)
    put(tmp_dir, "2.json", "2024-01-05T10:00:05Z", 5.0)
    put(tmp_dir, "3.json", "2024-01-05T10:00:20Z", 20.0)
    assert run(spark, tmp_dir).valid_rows == 1
    put(tmp_dir, "4.json", "2024-01-05T10:00:30Z", 30.0)
    assert run(spark, tmp_dir).valid_rows == 0
    assert [r[4] for r in rows(inc.current_silver(spark, f"{tmp_dir}/s", SOURCE))] == [5.0]
    # Gold reads the same layer.
    base = jobs.silver_for_gold(spark, f"{tmp_dir}/s", SOURCE, "fixture")
    assert [r.temperature_2m for r in base.collect()] == [5.0]


def test_a_killed_run_leaves_nothing_visible(spark, tmp_dir, monkeypatch):
    put(tmp_dir, "1.json", "2024-01-05T10:00:09Z", 9.0)

    def killed(*_args, **_kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            run(spark, tmp_dir)
    assert glob.glob(f"{tmp_dir}/s/domain=weather/**/*.parquet", recursive=True)
    assert inc.current_silver(spark, f"{tmp_dir}/s", SOURCE).count() == 0
    assert manifest.last_mark(spark, f"{tmp_dir}/s", "weather", SOURCE) is None
    assert run(spark, tmp_dir).valid_rows == 1
    assert inc.current_silver(spark, f"{tmp_dir}/s", SOURCE).count() == 1


def test_day_filter_reaches_the_scan(spark, tmp_dir):
    put(tmp_dir, "1.json", "2024-01-05T10:00:09Z", 9.0)
    run(spark, tmp_dir)
    there = inc.committed_silver(spark, f"{tmp_dir}/s", SOURCE).where(inc.on_days([dt.date(2024, 1, 5)]))
    plan = there._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_ts,2024-01-05" in plan
    days = [dt.date(2024, 1, d) for d in (5, 6, 9)]
    assert [(a.day, b.day) for a, b in inc.day_ranges(days)] == [(5, 7), (9, 10)]
    assert len(inc.day_ranges([dt.date(2024, 1, 1) + dt.timedelta(days=2 * k) for k in range(100)])) == 1
