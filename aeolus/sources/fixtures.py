"""Input tables derived from the driver's ``events`` table.

The pipeline's real inputs (Bronze weather envelopes, probe and road-sensor
traffic, three weather feeds) are re-expressed as narrow projections of
``events``: one output row per input row, no shuffle, so they scale with the
table. The derivation rules are the shared contract with the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    CURRENT_METRICS,
    KMH_PER_MS,
    INGEST_TS_FORMAT,
    OBSERVED_AT_FORMAT,
    OWM_SOURCE,
    WEATHER_API_SOURCE,
    WEATHER_CITIES,
    WEATHER_SOURCE,
)
from ..functions import stable_event_id
from ..operators.bronze import build_envelope

# --- fixed values of the fixture contract ----------------------------------
FIXTURE_AUTHOR = "fixture"
# City labels by ``user_id % 5``; the blanks around Kyiv exercise ``trim``.
FIXTURE_CITY_LABELS = (" Kyiv ", "Lviv", "Kharkiv", "Odesa", "Dnipro")
FIXTURE_UNITS = ("°C", "%", "mm", "km/h", "°", "hPa")
# --- end of fixed values ----------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_base(events: DataFrame) -> DataFrame:
    """Adds ``k`` (props.k) and ``cents`` (value in cents), renames the id."""
    return events.select(
        F.col("event_id").alias("src_id"),
        "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def weather_raw(events: DataFrame) -> DataFrame:
    """Flat weather observations (one per event) before envelope assembly."""
    b = events_base(events)
    idx = (F.col("user_id") % 5).cast("int")
    city_raw = F.get(F.array(*[F.lit(c) for c in FIXTURE_CITY_LABELS]), idx)
    lat = F.get(F.array(*[F.lit(c[1]) for c in WEATHER_CITIES]), idx)
    lon = F.get(F.array(*[F.lit(c[2]) for c in WEATHER_CITIES]), idx)
    k, cents = F.col("k"), F.col("cents")
    observed_at = (F.when(_is("purchase") & (k == 50), F.lit(""))
                   .otherwise(F.date_format("ts", OBSERVED_AT_FORMAT)))
    return b.select(
        "src_id", "ts", "event_type", "k",
        city_raw.alias("city_raw"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        (F.lit(100.0) + k).alias("elevation_m"),
        observed_at.alias("observed_at"),
        F.when(_is("error") & (k < 5), F.lit(None).cast("double"))
         .otherwise((cents % 4500) / F.lit(100.0) - F.lit(15.0)).alias("temperature_2m"),
        F.when(_is("click") & (k >= 95), k + 50).otherwise(k)
         .cast("double").alias("relative_humidity_2m"),
        F.when(_is("view"), (cents % 300) / F.lit(100.0))
         .when(_is("purchase") & (k < 3), F.lit(-1.0))
         .otherwise(F.lit(0.0)).alias("precipitation"),
        ((cents % 4000) / F.lit(100.0)).alias("wind_speed_10m"),
        F.when(_is("signup"), F.lit(None).cast("double"))
         .otherwise(((F.col("src_id") * 37) % 360).cast("double")).alias("wind_direction_10m"),
        (F.lit(990.0) + (cents % 400) / F.lit(10.0)).alias("surface_pressure"),
    )


def weather_bronze(events: DataFrame, author: str = FIXTURE_AUTHOR,
                   keep: tuple[str, ...] = ("src_id",)) -> DataFrame:
    """Bronze weather envelopes with a nested payload, plus ``src_id``."""
    r = weather_raw(events)
    metrics = F.struct(*[F.col(m).alias(m) for m in CURRENT_METRICS])
    units = F.struct(*[F.lit(u).alias(m) for m, u in zip(CURRENT_METRICS, FIXTURE_UNITS)])
    payload = F.struct(
        F.col("city_raw").alias("city"),
        "latitude", "longitude", "elevation_m", "observed_at",
        metrics.alias("metrics"), units.alias("units"),
    )
    natural_key = F.concat(F.trim("city_raw"), F.lit("|"), F.col("observed_at"))
    return build_envelope(r, WEATHER_SOURCE, author, payload,
                          event_id=stable_event_id(WEATHER_SOURCE, natural_key),
                          ingested_at=F.col("ts"), keep=keep)


def weather_api_feed(events: DataFrame) -> DataFrame:
    """Second weather feed: raw Kyiv observations of ``view``/``click`` events."""
    r = weather_raw(events)
    return (r.filter((F.trim("city_raw") == "Kyiv") & F.col("event_type").isin("view", "click"))
             .select(
                 F.try_to_timestamp("observed_at", F.lit(OBSERVED_AT_FORMAT)).alias("obs_time"),
                 "latitude", "longitude", "temperature_2m", "precipitation",
                 "wind_speed_10m", "relative_humidity_2m",
                 F.lit(WEATHER_API_SOURCE).alias("source")))


def owm_feed(events: DataFrame) -> DataFrame:
    """Third weather feed: raw Kyiv observations of ``error`` events, native m/s,
    rain null when humidity < 30."""
    r = weather_raw(events)
    return (r.filter((F.trim("city_raw") == "Kyiv") & _is("error"))
             .select(
                 F.try_to_timestamp("observed_at", F.lit(OBSERVED_AT_FORMAT)).alias("event_time"),
                 F.col("latitude").alias("lat"),
                 F.col("longitude").alias("lon"),
                 F.col("temperature_2m").alias("temp_c"),
                 F.when(F.col("relative_humidity_2m") < 30, F.lit(None).cast("double"))
                  .otherwise(F.col("precipitation")).alias("rain_1h_mm"),
                 (F.col("wind_speed_10m") / F.lit(KMH_PER_MS)).alias("wind_speed_mps"),
                 F.col("relative_humidity_2m").alias("humidity_pct"),
                 F.lit(OWM_SOURCE).alias("source")))


def probe_traffic(events: DataFrame) -> DataFrame:
    """Vehicle probes: position jittered by ``k``, speed = value / 2."""
    b = events_base(events)
    k = F.col("k")
    return b.select(
        "src_id",
        F.col("ts").cast("timestamp").alias("event_ts"),
        (F.lit(50.15) + F.lit(0.1) * (F.col("user_id") % 5) + (k - 50) * F.lit(8e-5)).alias("lat"),
        (F.lit(30.45) + F.lit(0.1) * (F.col("user_id") % 2) + (k - 50) * F.lit(6e-5)).alias("lon"),
        (F.col("value") / F.lit(2.0)).alias("speed"),
        F.when(_is("signup") & (k < 20), F.lit(None).cast("double"))
         .otherwise(((F.col("src_id") * 37) % 360).cast("double")).alias("heading"),
    )


def road_traffic(events: DataFrame) -> DataFrame:
    """Road-sensor readings over 20 roads."""
    b = events_base(events)
    k = F.col("k")
    road = F.col("user_id") % 20
    road_label = F.concat(F.lit("road-"), road.cast("string"))
    return b.select(
        "src_id", "k",
        F.col("ts").cast("timestamp").alias("event_ts"),
        (F.lit(50.25) + F.lit(0.01) * road).alias("lat"),
        (F.lit(30.45) + F.lit(0.01) * road).alias("lon"),
        road_label.alias("road_id"),
        road_label.alias("road_name"),
        F.col("value").alias("current_speed_kmh"),
        (F.lit(60) + k % 40).cast("double").alias("free_flow_speed_kmh"),
        # A zero speed has no finite travel time: null instead of an ANSI error.
        F.try_divide(F.lit(3600.0), F.col("value")).alias("current_travel_time_s"),
        (k / F.lit(100.0)).alias("confidence"),
        F.when(_is("error"), F.lit(True))
         .when(_is("signup") & (k < 10), F.lit(None).cast("boolean"))
         .otherwise(F.lit(False)).alias("road_closure"),
    )


# Hourly weather range for the fixtures (the source pipeline's default range
# lies outside the driver tables' dates).
FIXTURE_TIME_FROM = "2024-01-05"
FIXTURE_TIME_TO = "2024-01-25"


# ---- Bronze raw inputs ---------------------------------------------------------

# --- fixed values of the fixture contract ----------------------------------
ROAD_CLASSES = ("motorway", "trunk", "primary", "secondary", "tertiary")
ALERT_HEADER = ("region", " start", "end ", "start_time", "end_time", "oblast", "notes")
# --- end of fixed values ----------------------------------------------------


def weather_polls(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One multi-city forecast response per event, as JSON text: ``k % 6``
    items (0..5), item i describing city i; missing tail items exercise the
    positional defaults."""
    b = events_base(events)
    k, cents = F.col("k"), F.col("cents")
    lats = F.array(*[F.lit(c[1]) for c in WEATHER_CITIES])
    lons = F.array(*[F.lit(c[2]) for c in WEATHER_CITIES])

    def item(i):
        return F.struct(
            (F.get(lats, i) + (k % 7) * F.lit(1e-4)).alias("latitude"),
            F.get(lons, i).alias("longitude"),
            (F.lit(100.0) + i * 10).cast("double").alias("elevation"),
            F.struct(
                F.date_format("ts", OBSERVED_AT_FORMAT).alias("time"),
                ((cents % 4500) / F.lit(100.0) - F.lit(15.0) + i).alias("temperature_2m"),
                k.cast("double").alias("relative_humidity_2m"),
                ((cents % 300) / F.lit(100.0)).alias("precipitation"),
                ((cents % 4000) / F.lit(100.0)).alias("wind_speed_10m"),
                ((F.col("src_id") * 37 + i * 10) % 360).cast("double").alias("wind_direction_10m"),
                (F.lit(1000.0) + i).alias("surface_pressure"),
            ).alias("current"),
            F.struct(*[F.lit(u).alias(m) for m, u in zip(CURRENT_METRICS, FIXTURE_UNITS)])
             .alias("current_units"),
        )

    items = F.transform(F.sequence(F.lit(0), F.lit(len(WEATHER_CITIES) - 1)), item)
    return b.select("src_id", *keep, F.to_json(F.slice(items, 1, k % 6)).alias("body"))


def alert_lines(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """CSV lines of an alerts export (no quoting): short rows for ``error``,
    two extra cells when k > 90, blank lines when k = 0, padded cells."""
    b = events_base(events)
    k = F.col("k")
    pad = F.when(k % 2 == 1, F.lit(" ")).otherwise(F.lit(""))
    cells = [
        F.concat(F.lit("region-"), (F.col("user_id") % 25).cast("string")),
        F.date_format("ts", "yyyy-MM-dd"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd"),
        F.date_format("ts", "HH:mm"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "HH:mm"),
        F.col("event_type"),
        k.cast("string"),
    ]
    full = F.concat_ws(",", *[F.concat(pad, c, pad) for c in cells])
    short = F.concat_ws(",", *[F.concat(pad, c, pad) for c in cells[:4]])
    line = (F.when(k == 0, F.lit("   "))
            .when(F.col("event_type") == "error", short)
            .when(k > 90, F.concat(full, F.lit(",x,y")))
            .otherwise(full))
    return b.select("src_id", *keep, line.alias("line"))


def road_responses(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One Overpass-like response per event with two elements: a way (a node
    for ``error`` events) and a node; tag keys present depend on ``k``."""
    b = events_base(events)
    k = F.col("k")
    road = F.col("user_id") % 20
    entries = F.array(
        F.struct(F.lit("highway").alias("key"),
                 F.get(F.array(*[F.lit(c) for c in ROAD_CLASSES]), (k % 5).cast("int")).alias("value")),
        F.struct(F.lit("name").alias("key"), F.concat(F.lit("road-"), road.cast("string")).alias("value")),
        F.struct(F.lit("name:en").alias("key"),
                 F.when(k % 3 == 0, F.lit(None)).otherwise(
                     F.concat(F.lit("Road "), road.cast("string"))).alias("value")),
        F.struct(F.lit("maxspeed").alias("key"), (F.lit(30) + (k % 4) * 10).cast("string").alias("value")),
        F.struct(F.lit("lanes").alias("key"),
                 F.when(k % 2 == 0, (k % 4 + 1).cast("string")).alias("value")),
    )
    tags = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    center = F.struct((F.lit(50.25) + F.lit(0.01) * road).alias("lat"),
                      (F.lit(30.45) + F.lit(0.01) * road).alias("lon"))
    way = F.struct(
        F.when(F.col("event_type") == "error", F.lit("node")).otherwise(F.lit("way")).alias("type"),
        F.col("src_id").alias("id"), center.alias("center"), tags.alias("tags"))
    node = F.struct(F.lit("node").alias("type"), (F.col("src_id") + 1000000000).alias("id"),
                    center.alias("center"),
                    F.create_map().cast("map<string,string>").alias("tags"))
    return b.select("src_id", *keep, F.array(way, node).alias("elements"))


def capture_log(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    """Captured bodies of a domain as a collector logs them: a poll per event
    (``weather``, ``roads``, ``alerts``: an export of one line), a raw capture
    per page (``traffic``, a second apart)."""
    if domain == "traffic":
        pages = read_table(spark, sf_dir, "pages")
        when = F.timestamp_seconds(F.lit(1704412800) + F.col("page_id"))
        return pages.select(
            F.date_format(when, INGEST_TS_FORMAT).alias("captured_at"), F.col("url").alias("endpoint"),
            F.lit(None).cast("string").alias("body"), F.base64(F.encode("html", "UTF-8")).alias("body_b64"))
    events = read_table(spark, sf_dir, "events")
    if domain == "weather":
        polls = weather_polls(events, keep=("ts",))
    elif domain == "roads":
        polls = road_responses(events, keep=("ts",)).withColumn("body", F.to_json(F.struct("elements")))
    else:
        polls = alert_lines(events, keep=("ts",)).withColumn(
            "body", F.concat(F.lit(",".join(ALERT_HEADER) + "\n"), "line"))
    return polls.select(
        F.date_format("ts", INGEST_TS_FORMAT).alias("captured_at"),
        F.concat(F.lit("poll-"), F.col("src_id").cast("string")).alias("endpoint"),
        "body", F.lit(None).cast("string").alias("body_b64"))


def static_captures(events: DataFrame) -> DataFrame:
    """Capture attempts of the static domains: one per event."""
    domain = F.when(F.col("event_type").isin("signup", "purchase"), F.lit("alerts")) \
              .otherwise(F.lit("roads"))
    ts = F.col("ts").cast("timestamp")
    return events.select(
        domain.alias("domain"), ts.alias("ingest_ts"),
        F.concat(F.lit("part-"), F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"), F.lit("-"),
                 F.col("event_id").cast("string"), F.lit(".jsonl")).alias("file"))


def scored_predictions(roads: DataFrame) -> DataFrame:
    """Road readings scored by a fixed rule (no model), so scores, confusion
    matrix and AUC can be recomputed in SQL:
    ratio = current / free-flow; actual = ratio < 0.7;
    proba = 1 / (1 + exp((ratio + (k - 50) / 200 - 0.7) * 4)); pred = proba >= 0.5."""
    kept = roads.filter((F.col("current_speed_kmh") > 0) & (F.col("free_flow_speed_kmh") > 0)
                        & ~F.col("road_closure"))
    ratio = F.col("current_speed_kmh") / F.col("free_flow_speed_kmh")
    proba = F.lit(1.0) / (F.lit(1.0) + F.exp(
        (ratio + (F.col("k") - 50) / F.lit(200.0) - F.lit(0.7)) * F.lit(4.0)))
    return kept.select(
        "src_id", F.date_trunc("hour", "event_ts").alias("event_hour"), "lat", "lon",
        (ratio < F.lit(0.7)).cast("int").alias("is_congested_actual"),
        proba.alias("congestion_proba"),
    ).withColumn("is_congested_pred", (F.col("congestion_proba") >= F.lit(0.5)).cast("int"))


def bronze_lines_with_corruption(events: DataFrame) -> DataFrame:
    """Bronze weather envelopes as JSON text lines; for ``k = 7`` the line is
    malformed (``{"broken": <event id>``), as a truncated upload would be."""
    env = weather_bronze(events, keep=("src_id", "k"))
    line = (F.when(F.col("k") == 7, F.concat(F.lit('{"broken": '), F.col("src_id").cast("string")))
            .otherwise(F.to_json(F.struct(*[c for c in env.columns if c not in ("src_id", "k")]))))
    return env.select(line.alias("value"))


def road_text(events: DataFrame) -> DataFrame:
    """Road measures as text, as a sloppy feed sends them: every fifth speed is
    no number, others are NaN or empty; every seventh time can't be read."""
    b = events_base(events)
    k = F.col("k")
    number = F.concat(k.cast("string"), F.lit(".25"))
    return b.select(
        "src_id",
        F.when(F.col("src_id") % 7 == 0, "soon").when(F.col("src_id") % 7 == 1, "")
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_ts"),
        F.when(k % 5 == 0, "n/a").when(k % 5 == 1, "NaN").otherwise(number).alias("current_speed_kmh"),
        F.when(k % 3 == 0, "").otherwise(number).alias("free_flow_speed_kmh"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("-"), number)).alias("current_travel_time_s"),
        F.when(k % 6 == 0, "1,5").otherwise(F.lit("1e2")).alias("confidence"),
    )
