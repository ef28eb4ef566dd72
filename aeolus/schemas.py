"""Explicit schemas: Bronze envelopes are read without inference (one pass,
and required for streams); Silver and ML tables have fixed column contracts."""

from __future__ import annotations

from pyspark.sql import types as T

from .constants import CURRENT_METRICS

CORRUPT_COL = "_corrupt_record"

WEATHER_METRICS = T.StructType(
    [T.StructField(m, T.DoubleType()) for m in CURRENT_METRICS])
WEATHER_UNITS = T.StructType(
    [T.StructField(m, T.StringType()) for m in CURRENT_METRICS])

WEATHER_PAYLOAD = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("elevation_m", T.DoubleType()),
    T.StructField("observed_at", T.StringType()),
    T.StructField("metrics", WEATHER_METRICS),
    T.StructField("units", WEATHER_UNITS),
])

CAPTURE_PAYLOAD = T.StructType([
    T.StructField("endpoint", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("content_length", T.LongType()),
    T.StructField("content_sha256", T.StringType()),
    T.StructField("encoding", T.StringType()),
    T.StructField("payload_b64", T.StringType()),
])

ALERT_PAYLOAD = T.StructType([
    T.StructField("source_url", T.StringType()),
    T.StructField("row", T.MapType(T.StringType(), T.StringType())),
])

ROAD_PAYLOAD = T.StructType([
    T.StructField("way_id", T.LongType()),
    T.StructField("highway_class", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("name_en", T.StringType()),
    T.StructField("ref", T.StringType()),
    T.StructField("maxspeed", T.StringType()),
    T.StructField("lanes", T.StringType()),
    T.StructField("surface", T.StringType()),
    T.StructField("oneway", T.StringType()),
    T.StructField("center_lat", T.DoubleType()),
    T.StructField("center_lon", T.DoubleType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])


def envelope(payload: T.StructType, with_corrupt: bool = True) -> T.StructType:
    fields = [
        T.StructField("ingest_ts", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("schema_v", T.IntegerType()),
        T.StructField("author", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("payload", payload),
    ]
    if with_corrupt:
        fields.append(T.StructField(CORRUPT_COL, T.StringType()))
    return T.StructType(fields)


WEATHER_ENVELOPE = envelope(WEATHER_PAYLOAD)

SILVER_WEATHER = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("schema_v", T.IntegerType()),
    T.StructField("ingest_ts", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("city", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in (
        "latitude", "longitude", "elevation_m", "temperature_2m",
        "relative_humidity_2m", "precipitation", "wind_speed_10m",
        "wind_direction_10m", "surface_pressure")],
])

PROBE_TRAFFIC = T.StructType([
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("heading", T.DoubleType()),
])

ROAD_TRAFFIC = T.StructType([
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("road_name", T.StringType()),
    T.StructField("current_speed_kmh", T.DoubleType()),
    T.StructField("free_flow_speed_kmh", T.DoubleType()),
    T.StructField("current_travel_time_s", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("road_closure", T.BooleanType()),
])

UNIFIED_WEATHER = T.StructType([
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("temp_c", T.DoubleType()),
    T.StructField("precip_mm", T.DoubleType()),
    T.StructField("wind_mps", T.DoubleType()),
    T.StructField("humidity_pct", T.DoubleType()),
])

PREDICTIONS = T.StructType([
    T.StructField("event_hour", T.TimestampType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("is_congested_actual", T.IntegerType()),
    T.StructField("is_congested_pred", T.IntegerType()),
    T.StructField("congestion_proba", T.DoubleType()),
    T.StructField("author", T.StringType()),
])

CENTERS = T.StructType([
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("intensity_mean", T.DoubleType()),
    T.StructField("size", T.LongType()),
])

METRICS_LONG = T.StructType([
    T.StructField("section", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
