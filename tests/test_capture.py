"""Response bodies to Bronze: expansion, the hourly gate, restarts, the command."""

import base64
import hashlib
import json
import os

import pytest

from aeolus import schemas
from aeolus.plans import cli
from aeolus.sources.bronze import read_bronze
from aeolus.streaming import capture as cap

ROAD = {"type": "way", "center": {"lat": 50.3, "lon": 30.5}, "tags": {"highway": "trunk", "odd:key": "x"}}


def put(folder, name, body):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as fh:
        fh.write(body if isinstance(body, bytes) else body.encode())


def roads(*ids, kind="way"):
    return json.dumps({"elements": [{**ROAD, "type": kind, "id": i} for i in ids] + [{"type": "node", "id": 9}]})


def collect(spark, base, domain, **options):
    q = cap.collect_domain(spark, f"{base}/landing/{domain}", f"{base}/bronze", domain, "me",
                           interval_seconds=0, checkpoint=f"{base}/progress", **options)
    q.awaitTermination()
    spec = cap.COLLECTORS[domain]
    return read_bronze(spark, f"{base}/bronze", domain, spec.source, schemas.envelope(spec.payload)).collect()


def test_static_domain_once_an_hour_over_a_restart(spark, tmp_dir):
    landing = f"{tmp_dir}/landing/roads"
    put(landing, "b-20240105T102000Z.json", roads(2))
    put(landing, "a-20240105T101000Z.json", roads(1))
    put(landing, "c-20240105T110000Z.json", roads(3))
    assert sorted((r.payload.way_id, r.hour) for r in collect(spark, tmp_dir, "roads")) == [(1, "10"), (3, "11")]
    # The stream starts again within the hour: its state knows what it has.
    put(landing, "d-20240105T113000Z.json", roads(4))
    put(landing, "e-20240105T100500Z.json", roads(5))
    put(landing, "f-20240106T110000Z.json", roads(6))
    rows = collect(spark, tmp_dir, "roads")
    assert sorted(r.payload.way_id for r in rows) == [1, 3, 6]
    assert {(r.ingest_ts, r.author, r.source) for r in rows if r.payload.way_id == 1} == {
        ("2024-01-05T10:10:00Z", "me", "overpass_kyiv_highways")}
    assert rows[0].payload.tags["odd:key"] == "x"


def test_unreadable_body_does_not_use_up_the_hour(spark, tmp_dir):
    landing = f"{tmp_dir}/landing/roads"
    put(landing, "a-20240105T101000Z.json", "{truncated")
    put(landing, "b-20240105T101500Z.json", b"\xff\xfe")
    put(landing, "c-20240105T102000Z.json", roads(7, 8))
    # A capture without ways is the hour's capture.
    put(landing, "d-20240105T110000Z.json", roads(1, kind="node"))
    put(landing, "e-20240105T113000Z.json", roads(2))
    assert sorted(r.payload.way_id for r in collect(spark, tmp_dir, "roads")) == [7, 8]


def test_moving_domains_take_every_body(spark, tmp_dir):
    landing = f"{tmp_dir}/landing/weather"
    item = {"latitude": 1.0, "longitude": 2.0, "elevation": 3.0,
            "current": {"time": "2024-01-05T10:00", "temperature_2m": 4.5}, "current_units": {"temperature_2m": "C"}}
    put(landing, "a-20240105T101000Z.json", json.dumps([item, item]))
    put(landing, "b-20240105T102000Z.json", json.dumps(item))
    put(landing, "c-20240105T103000Z.json", "not json")
    rows = collect(spark, tmp_dir, "weather")
    assert len(rows) == 10  # five cities a body
    first = {r.payload.city: r for r in rows if r.ingest_ts == "2024-01-05T10:10:00Z"}
    assert first["Lviv"].payload.metrics.temperature_2m == 4.5 and first["Kharkiv"].payload.observed_at == ""
    key = hashlib.sha1(b"open_meteo_current:Lviv|2024-01-05T10:00").hexdigest()[:16]
    assert first["Lviv"].event_id == f"open_meteo_current-{key}"
    body = bytes(range(256))
    put(f"{tmp_dir}/landing/traffic", "x-20240105T101000Z.pb", body)
    (row,) = collect(spark, tmp_dir, "traffic")
    assert base64.b64decode(row.payload.payload_b64) == body and row.payload.content_length == 256
    assert row.payload.endpoint.endswith("x-20240105T101000Z.pb")


def test_alert_bodies_have_their_own_headers(spark, tmp_dir):
    landing = f"{tmp_dir}/landing/alerts"
    put(landing, "a-20240105T101000Z.csv", " region ,start,x,x\r\n\r\n  \nKyiv, 1 ,2,3,4\nLviv\n")
    put(landing, "b-20240105T111000Z.csv", "other\n, \n")
    put(landing, "c-20240105T121000Z.csv", "region,start\n")
    rows = collect(spark, tmp_dir, "alerts")
    assert sorted(sorted(r.payload.row.items()) for r in rows) == [
        [("other", "")], [("region", "Kyiv"), ("start", "1"), ("x", "3")], [("region", "Lviv"), ("start", ""), ("x", "")]]
    key = hashlib.sha1(b"vadimkin_air_raid:Kyiv|1||||").hexdigest()[:16]
    assert f"vadimkin_air_raid-{key}" in {r.event_id for r in rows}


def test_log_layout(spark, tmp_dir):
    lines = [
        {"captured_at": "2024-01-05T10:10:00Z", "endpoint": "u", "body": roads(1)},
        {"captured_at": "2024-01-05T10:05:00Z", "endpoint": "u", "body_b64": base64.b64encode(roads(2).encode()).decode()},
        {"captured_at": "soon", "endpoint": "u", "body": roads(3)}, {"captured_at": "2024-01-05T11:00:00Z", "endpoint": "u"},
    ]
    put(f"{tmp_dir}/landing/roads", "log.json", "\n".join(map(json.dumps, lines)))
    assert [r.payload.way_id for r in collect(spark, tmp_dir, "roads", layout="log")] == [2]


def test_domains_are_checked_and_isolated(spark, tmp_dir):
    with pytest.raises(ValueError, match="unknown domain"):
        cap.select_domains(["weather", "tides"])
    assert cli.run(["collect", "--landing", tmp_dir, "--bronze", tmp_dir, "--producer", "me", "--domains", "tides"]) == 1
    with pytest.raises(ValueError, match="layout"):
        cap.captures(spark, tmp_dir, "zip")
    put(f"{tmp_dir}/landing/roads", "a-20240105T101000Z.json", roads(1))
    running, failed = cap.collect_all(spark, f"{tmp_dir}/landing", f"{tmp_dir}/bronze", "me", ["traffic", "roads"],
                                      interval_seconds=0, checkpoint=f"{tmp_dir}/progress")
    running["roads"].awaitTermination()
    assert set(failed) == {"traffic"} and running["roads"].exception() is None
