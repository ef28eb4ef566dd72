"""Bronze operators over real files: CSV, binary captures, roads JSON,
positional expansion, hour partitions and partition-type inference."""

import json
import os

from pyspark.sql import functions as F

from aeolus import schemas
from aeolus.operators import bronze as br
from aeolus.sinks import write_bronze
from aeolus.sources.bronze import read_bronze


def test_alert_csv_naive_split(spark, tmp_dir):
    path = os.path.join(tmp_dir, "alerts.csv")
    with open(path, "w") as fh:
        fh.write("region, start ,end,start_time,end_time,oblast,notes\n")
        fh.write(" R1 , 2024-01-01 ,2024-01-01, 10:00,11:00,Kyiv,x\n")
        fh.write("\n   \n")
        fh.write("R2,2024-01-02,2024-01-02\n")
        fh.write("R3,a,b,c,d,e,f,extra1,extra2\n")
    rows = br.alert_rows(br.read_alert_csv(spark, path)).collect()
    keys = sorted(r.row["region"] + ":" + r.row["notes"] for r in rows)
    assert keys == ["R1:x", "R2:", "R3:f"]
    r2 = next(r for r in rows if r.row["region"] == "R2")
    assert r2.row["start_time"] == "" and len(r2.row) == 7


def test_alert_lines_key_fallback(spark):
    lines = spark.createDataFrame([("a,b",), ("c,d",)], "line string")
    out = br.expand_alert_lines(lines, ["x", "y"]).collect()
    assert len({r.event_id for r in out}) == 2  # no key columns: whole row is the key


def test_binary_capture_collapses_identical_payloads(spark, tmp_dir):
    for name, body in (("a.bin", b"\x00\x01payload"), ("b.bin", b"\x00\x01payload"), ("c.bin", b"other")):
        with open(os.path.join(tmp_dir, name), "wb") as fh:
            fh.write(body)
    env = br.capture_files(spark, tmp_dir, "lviv_gtfs_rt", "me", glob="*.bin").collect()
    assert len(env) == 3 and len({e.event_id for e in env}) == 2
    p = next(e.payload for e in env if e.payload.content_length == 5)
    assert p.payload_b64 == "b3RoZXI=" and p.encoding == "base64"
    assert p.content_sha256 == "d9298a10d1b0735837dc4bd85dac641b0f3cef27a47e5d53a54f2f3f5b2fcffa"


def test_roads_json_file(spark, tmp_dir):
    body = {"elements": [
        {"type": "way", "id": 7, "center": {"lat": 50.4, "lon": 30.5},
         "tags": {"highway": "primary", "name:en": "Main", "lanes": "2", "odd:key": "v"}},
        {"type": "node", "id": 8}]}
    path = os.path.join(tmp_dir, "roads.json")
    with open(path, "w") as fh:
        fh.write(json.dumps(body) + "\n")
    resp = spark.read.schema(br.ROAD_RESPONSE).json(path)
    out = br.expand_road_elements(resp).collect()
    assert len(out) == 1
    p = out[0].payload
    assert (p.way_id, p.highway_class, p.name_en, p.lanes, p.name) == (7, "primary", "Main", "2", None)
    assert p.tags["odd:key"] == "v"


def test_weather_expansion_missing_items(spark):
    body = json.dumps({"latitude": 1.0, "longitude": 2.0, "current": {"time": "2024-01-01T00:00",
                                                                       "temperature_2m": 5.0}})
    df = spark.createDataFrame([(body,)], "body string").withColumn(
        "response", br.parse_weather_response(F.col("body")))
    out = br.expand_weather(df).orderBy("pos").collect()
    assert [r.payload.city for r in out] == ["Kyiv", "Lviv", "Kharkiv", "Odesa", "Dnipro"]
    assert out[0].payload.latitude == 1.0 and out[0].payload.metrics.temperature_2m == 5.0
    assert out[1].payload.latitude == 49.8397 and out[1].payload.observed_at == ""
    assert out[1].payload.metrics.temperature_2m is None


def test_bronze_hour_partitions_stay_strings(spark, tmp_dir):
    rows = [("2024-01-05T03:00:05Z", "open_meteo_current", 1, "me", "e1", None)]
    env = spark.createDataFrame(rows, schemas.envelope(schemas.WEATHER_PAYLOAD, with_corrupt=False))
    write_bronze(env, tmp_dir, "weather", "open_meteo_current")
    back = read_bronze(spark, tmp_dir, "weather", "open_meteo_current", schemas.WEATHER_ENVELOPE)
    r = back.select("event_id", "ingest_date", "hour").first()
    assert (r.ingest_date, r.hour) == ("2024-01-05", "03")
    assert dict(back.dtypes)["hour"] == "string"
    assert back.filter(F.col("hour") == "03").count() == 1


def test_first_capture_per_hour(spark):
    from datetime import datetime
    caps = spark.createDataFrame(
        [("roads", datetime(2024, 1, 1, 10, 5), "b"), ("roads", datetime(2024, 1, 1, 10, 1), "z"),
         ("roads", datetime(2024, 1, 1, 11, 0), "c"), ("alerts", datetime(2024, 1, 1, 10, 1), "a")],
        "domain string, ingest_ts timestamp, file string")
    got = sorted((r.domain, r.hour_start.hour, r.file) for r in br.first_capture_per_hour(caps).collect())
    assert got == [("alerts", 10, "a"), ("roads", 10, "z"), ("roads", 11, "c")]


def test_alert_rows_with_empty_keys_get_distinct_ids(spark):
    header = ["region", "start", "end", "start_time", "end_time", "oblast", "notes"]
    lines = spark.createDataFrame([(",,,,,,first",), (",,,,,,second",), ("R,a,b,c,d,e,x",)], "line string")
    out = br.expand_alert_lines(lines, header).collect()
    assert len({r.event_id for r in out}) == 3
    assert {r.natural_key for r in out} == {"R|a|b|c|d|e", "||||||first", "||||||second"}


def test_of_equal_header_names_the_last_counts(spark):
    lines = spark.createDataFrame([("R1,x,y,z",), ("R2,x",)], "line string")
    rows = br.expand_alert_lines(lines, ["region", "note", "other", "note"]).collect()
    assert sorted((r.row["region"], r.row["note"], r.row["other"]) for r in rows) == [
        ("R1", "z", "y"), ("R2", "", "")]
