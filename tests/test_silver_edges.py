"""Silver edge cases: ANSI-safe parsing, boundaries, NaN, corrupt lines, dedup."""

import json
import math
import os

from pyspark.sql import functions as F

from aeolus import schemas
from aeolus.operators import silver
from aeolus.sources.bronze import quarantine, read_bronze_json


def envelope(eid, city="Kyiv", observed="2024-01-05T10:00", lat=50.45, lon=30.52,
             t=1.0, rh=50.0, p=0.0, w=3.0, wd=90.0, author="me", ingest="2024-01-05T10:00:05Z"):
    return {"ingest_ts": ingest, "source": "open_meteo_current", "schema_v": 1,
            "author": author, "event_id": eid,
            "payload": {"city": city, "latitude": lat, "longitude": lon, "elevation_m": 100.0,
                        "observed_at": observed,
                        "metrics": {"temperature_2m": t, "relative_humidity_2m": rh,
                                    "precipitation": p, "wind_speed_10m": w,
                                    "wind_direction_10m": wd, "surface_pressure": 1000.0},
                        "units": {}}}


def land(tmp_dir, records, extra_lines=()):
    path = os.path.join(tmp_dir, "bronze.jsonl")
    with open(path, "w") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")
        for line in extra_lines:
            fh.write(line + "\n")
    return path


def run(spark, tmp_dir, records, extra_lines=(), **kw):
    df = read_bronze_json(spark, land(tmp_dir, records, extra_lines), schemas.WEATHER_ENVELOPE)
    return df, silver.silver_weather(df, producer="me", **kw)


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_corrupt_line_is_quarantined_and_rejected(spark, tmp_dir):
    raw, out = run(spark, tmp_dir, [envelope("a")], extra_lines=["{not json"])
    assert raw.count() == 2
    assert len(quarantine(raw).collect()) == 1  # a bare count() would read only _corrupt_record
    assert ids(out) == ["a"]


def test_empty_and_malformed_times_are_null_not_errors(spark, tmp_dir):
    recs = [envelope("ok"), envelope("empty", observed=""), envelope("junk", observed="garbage"),
            envelope("seconds", observed="2024-01-05T10:00:33")]
    _, out = run(spark, tmp_dir, recs)
    assert ids(out) == ["ok"]


def test_inclusive_boundaries_kept(spark, tmp_dir):
    recs = [envelope("lat", lat=90.0), envelope("lon", lon=-180.0), envelope("tmin", t=-90.0),
            envelope("tmax", t=100.0), envelope("rh0", rh=0.0), envelope("rh100", rh=100.0),
            envelope("p0", p=0.0), envelope("w0", w=0.0)]
    _, out = run(spark, tmp_dir, recs)
    assert ids(out) == sorted(r["event_id"] for r in recs)


def test_out_of_range_rejected(spark, tmp_dir):
    recs = [envelope("lat", lat=90.5), envelope("t", t=-90.01), envelope("rh", rh=100.5),
            envelope("p", p=-0.01), envelope("w", w=-1.0), envelope("other", author="x")]
    _, out = run(spark, tmp_dir, recs)
    assert ids(out) == []


def test_nan_precipitation_rejected(spark):
    df = spark.createDataFrame(
        [("a", float("nan"), 1.0), ("b", 0.5, float("nan")), ("c", 0.5, 1.0)],
        "event_id string, precipitation double, wind_speed_10m double")
    df = df.withColumns({"latitude": F.lit(50.0), "longitude": F.lit(30.0),
                         "temperature_2m": F.lit(1.0), "relative_humidity_2m": F.lit(5.0)})
    assert ids(silver.domain_filter(df)) == ["c"]


def test_epoch_bound_is_strict_and_future_rejected(spark, tmp_dir):
    recs = [envelope("epoch", observed="1971-01-01T00:00"),
            envelope("after", observed="1971-01-01T00:01"),
            envelope("future", observed="2999-01-01T00:00")]
    _, out = run(spark, tmp_dir, recs)
    assert ids(out) == ["after"]
    _, fixed = run(spark, tmp_dir, recs, as_of="3000-01-01 00:00:00")
    assert ids(fixed) == ["after", "future"]


def test_city_trimmed_and_required(spark, tmp_dir):
    recs = [envelope("a", city="  Lviv "), envelope("b", city=None)]
    _, out = run(spark, tmp_dir, recs)
    assert [r.city for r in out.collect()] == ["Lviv"]


def test_dedup_keeps_first_by_order(spark, tmp_dir):
    recs = [envelope("dup", t=5.0, ingest="2024-01-05T10:00:09Z"),
            envelope("dup", t=7.0, ingest="2024-01-05T10:00:01Z"),
            envelope("dup", t=9.0, ingest="2024-01-05T10:00:05Z")]
    _, out = run(spark, tmp_dir, recs)
    assert [r.temperature_2m for r in out.collect()] == [7.0]


def test_dedup_plans_map_side_group_limit(spark, tmp_dir):
    _, out = run(spark, tmp_dir, [envelope("a")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_restamp_reproduces_overwrite(spark, tmp_dir):
    raw = read_bronze_json(spark, land(tmp_dir, [envelope("a", author="other")]),
                           schemas.WEATHER_ENVELOPE)
    assert silver.silver_weather(raw, producer="me").count() == 0
    kept = silver.silver_weather(raw, producer="me", restamp=True).collect()
    assert [r.author for r in kept] == ["me"]


def test_reject_report_sums_to_raw(spark, tmp_dir):
    recs = [envelope("a"), envelope("a"), envelope("b", t=None), envelope("c", rh=300.0),
            envelope("d", observed="")]
    raw = read_bronze_json(spark, land(tmp_dir, recs), schemas.WEATHER_ENVELOPE)
    rep = {r.reject_reason: r.rows for r in
           silver.reject_report(silver.flatten_weather(raw), producer="me").collect()}
    assert rep == {"valid": 1, "duplicate": 1, "null_field": 2, "out_of_range": 1}
    assert not math.isnan(sum(rep.values()))
