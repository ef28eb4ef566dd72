"""Bronze operators: what each collector does to a response body, as Spark
jobs over landed raw data (the HTTP fetch itself is not part of the engine).

* ``build_envelope``       B1 — wrap rows in the uniform event envelope
* ``expand_weather``       B4 — positional zip of a multi-city response
* ``capture_columns``      B5 — length / sha256 / base64 of raw bytes
* ``expand_alert_lines``   B6 — naive CSV split into a column map + key
* ``expand_road_elements`` B7 — Overpass ``elements`` -> one row per way
* ``with_partition_keys``  B8 — hour-partition keys from the ingest instant
* ``first_capture_per_hour`` B10 — static domains: one snapshot per hour
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    ALERT_KEY_COLUMNS,
    ALERTS_SOURCE,
    CURRENT_METRICS,
    INGEST_TS_FORMAT,
    ROAD_TAG_PICKS,
    SCHEMA_VERSION,
    WEATHER_CITIES,
)
from ..functions import partition_keys, random_event_id, stable_event_id


# ---- B1 -----------------------------------------------------------------------

def iso_utc(ts: Column) -> Column:
    """ISO-8601 UTC with seconds and a ``Z`` suffix."""
    return F.date_format(ts, INGEST_TS_FORMAT)


def build_envelope(df: DataFrame, source: str, author: str, payload: Column,
                   event_id: Column | None = None, ingested_at: Column | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """B1: ``ingest_ts, source, schema_v, author, event_id, payload``.

    ``event_id`` defaults to a random id (materialise before reuse);
    ``ingested_at`` defaults to the query's current timestamp."""
    when = F.current_timestamp() if ingested_at is None else ingested_at
    eid = random_event_id(source) if event_id is None else event_id
    return df.select(
        iso_utc(when).alias("ingest_ts"),
        F.lit(source).alias("source"),
        F.lit(SCHEMA_VERSION).cast("int").alias("schema_v"),
        F.lit(author).alias("author"),
        eid.alias("event_id"),
        payload.alias("payload"),
        *keep,
    )


# ---- B4 -----------------------------------------------------------------------

WEATHER_ITEM = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("current", T.StructType(
        [T.StructField("time", T.StringType())]
        + [T.StructField(m, T.DoubleType()) for m in CURRENT_METRICS])),
    T.StructField("current_units", T.StructType(
        [T.StructField(m, T.StringType()) for m in CURRENT_METRICS])),
])
WEATHER_RESPONSE = T.ArrayType(WEATHER_ITEM)


def parse_weather_response(body: Column) -> Column:
    """Response text -> array of city items (a single object becomes a
    one-item array, as the collector treats it)."""
    as_array = F.from_json(body, WEATHER_RESPONSE)
    as_object = F.from_json(body, WEATHER_ITEM)
    return F.when(F.trim(body).startswith("["), as_array).otherwise(F.array(as_object))


def expand_weather(polls: DataFrame, response: str = "response",
                   cities: Sequence[tuple[str, float, float]] = WEATHER_CITIES,
                   source: str = "open_meteo_current", keep: Sequence[str] = ()) -> DataFrame:
    """One payload per configured city, matched to the response item at the
    same position. A missing item yields the city's own coordinates, null
    metrics and an empty observation time.

    Narrow: the city list is a literal array exploded next to the response,
    so each poll fans out to exactly ``len(cities)`` rows with no join and no
    shuffle, and the response is parsed once per poll (below the generator)
    rather than once per city."""
    city_arr = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("city"),
                                  F.lit(la).alias("lat"), F.lit(lo).alias("lon"))
                         for i, (n, la, lo) in enumerate(cities)])
    rows = polls.select(*keep, F.col(response).alias("_resp"), F.explode(city_arr).alias("c"))
    c = F.col("c")
    it = F.get(F.col("_resp"), c["pos"])
    observed_at = F.coalesce(it["current"]["time"], F.lit(""))
    payload = F.struct(
        c["city"].alias("city"),
        F.coalesce(it["latitude"], c["lat"]).alias("latitude"),
        F.coalesce(it["longitude"], c["lon"]).alias("longitude"),
        it["elevation"].alias("elevation_m"),
        observed_at.alias("observed_at"),
        F.struct(*[it["current"][m].alias(m) for m in CURRENT_METRICS]).alias("metrics"),
        F.struct(*[it["current_units"][m].alias(m) for m in CURRENT_METRICS]).alias("units"),
    )
    key = F.concat(c["city"], F.lit("|"), observed_at)
    return rows.select(*keep, c["pos"].alias("pos"),
                       stable_event_id(source, key).alias("event_id"),
                       payload.alias("payload"))


# ---- B5 -----------------------------------------------------------------------

def _base64_plain(b: Column) -> Column:
    """Standard base64 without MIME line breaks (Spark 4 chunks by default
    unless ``spark.sql.chunkBase64String.enabled`` is false)."""
    spark = SparkSession.getActiveSession()
    chunked = True
    if spark is not None:
        chunked = spark.conf.get("spark.sql.chunkBase64String.enabled", "true") == "true"
    out = F.base64(b)
    return F.regexp_replace(out, "[\\r\\n]", "") if chunked else out


def capture_columns(content: Column, source: str, endpoint: str | Column | None = None,
                    content_type: str = "application/x-protobuf") -> dict[str, Column]:
    """Byte length, sha256 hex, base64 text and a digest-keyed event id
    (identical payloads get one id, so Silver collapses them)."""
    b = content.cast("binary")
    digest = F.sha2(b, 256)
    return {
        "endpoint": F.lit(endpoint) if isinstance(endpoint, str) or endpoint is None else endpoint,
        "content_type": F.lit(content_type),
        "content_length": F.octet_length(b).cast("long"),
        "content_sha256": digest,
        "encoding": F.lit("base64"),
        "payload_b64": _base64_plain(b),
        "event_id": stable_event_id(source, digest),
    }


def capture_files(spark: SparkSession, path: str, source: str, author: str,
                  glob: str | None = None) -> DataFrame:
    """B5 over a landing folder of raw binary captures (``binaryFile``)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.load(path)
    cols = capture_columns(F.col("content"), source, endpoint=F.col("path"))
    payload = F.struct(*[cols[k].alias(k) for k in (
        "endpoint", "content_type", "content_length", "content_sha256", "encoding", "payload_b64")])
    return build_envelope(raw, source, author, payload, event_id=cols["event_id"],
                          ingested_at=F.col("modificationTime"))


# ---- B6 -----------------------------------------------------------------------

def expand_alert_lines(lines: DataFrame, header: Sequence[str], line_col: str = "line",
                       key_columns: Sequence[str] = ALERT_KEY_COLUMNS,
                       source: str = "vadimkin_air_raid", keep: Sequence[str] = ()) -> DataFrame:
    """Naive comma split (no quoting), trimmed cells, blank lines skipped,
    short rows padded with "", extra cells ignored, of equal header names the
    last cell kept; the row becomes a ``map<string,string>``; the natural key joins six columns with "|".

    When none of the key columns exists the key would be five bare pipes for
    every row; then the whole row (all cells) is the key instead."""
    header = [h.strip() for h in header]
    cells = F.transform(F.split(F.col(line_col), ","), lambda x: F.trim(x))
    last = {h: i for i, h in enumerate(header)}
    header = list(last)
    padded = [F.coalesce(F.get(F.col("_cells"), i), F.lit("")) for i in last.values()]
    row_map = F.map_from_arrays(F.array(*[F.lit(h) for h in header]), F.array(*padded))
    key = _alert_key(header, padded, key_columns)
    return (lines.filter(F.trim(F.col(line_col)) != "")
                 .withColumn("_cells", cells)
                 .select(*keep, row_map.alias("row"),
                         stable_event_id(source, key).alias("event_id"),
                         key.alias("natural_key")))


def expand_alert_bodies(bodies: DataFrame, body: str = "text",
                        key_columns: Sequence[str] = ALERT_KEY_COLUMNS,
                        source: str = ALERTS_SOURCE, keep: Sequence[str] = ()) -> DataFrame:
    """B6 over whole bodies, each with its own header: the first line that is
    not blank. Rows as in ``expand_alert_lines``; a body without lines below
    its header gives none."""
    def cells(line):
        return F.transform(F.split(line, ","), lambda x: F.trim(x))

    lines = F.filter(F.split(F.col(body), r"\R"), lambda x: F.trim(x) != "")
    header = cells(F.get(F.col("_lines"), 0))
    rows = (bodies.select(*keep, lines.alias("_lines"))
            .select(*keep, header.alias("_header"),
                    F.explode(F.slice("_lines", 2, F.greatest(F.size("_lines") - 1, F.lit(0)))).alias("_line"))
            .select(*keep, "_header", F.array_distinct("_header").alias("_names"), cells(F.col("_line")).alias("_cells")))
    # Of equal names the last cell counts.
    place = lambda name: F.size("_header") - F.array_position(F.reverse("_header"), name)
    values = F.transform("_names", lambda name: F.coalesce(F.get(F.col("_cells"), place(name).cast("int")), F.lit("")))
    picked = [F.coalesce(F.col("row")[k], F.lit("")) for k in key_columns]
    key = (F.when(F.concat(*picked) == "", F.concat_ws("|", "_values"))
           .otherwise(F.concat_ws("|", *picked)))
    return (rows.withColumn("_values", values)
                .withColumn("row", F.map_from_arrays("_names", "_values"))
                .select(*keep, "row", stable_event_id(source, key).alias("event_id"), key.alias("natural_key")))


def read_alert_csv(spark: SparkSession, path: str) -> DataFrame:
    """B6 file reader: header from the file, no quoting, cells trimmed,
    blank lines skipped, extra cells dropped, short rows null (-> "")."""
    return (spark.read.option("header", True).option("quote", "")
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            .option("mode", "PERMISSIVE").csv(path))


def alert_rows(csv_df: DataFrame, key_columns: Sequence[str] = ALERT_KEY_COLUMNS,
               source: str = "vadimkin_air_raid") -> DataFrame:
    """B6 over a parsed CSV frame: columns -> map, key from six columns."""
    names = csv_df.columns
    vals = [F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names]
    row_map = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*vals))
    key = _alert_key(names, vals, key_columns)
    return csv_df.select(row_map.alias("row"), stable_event_id(source, key).alias("event_id"))


def _alert_key(names: Sequence[str], values: Sequence[Column],
               key_columns: Sequence[str]) -> Column:
    """Six key values joined by "|"; when all six are empty (or absent) the
    key would be five bare pipes shared by every such row, so the whole row
    is the key instead."""
    picked = [values[list(names).index(k)] if k in names else F.lit("") for k in key_columns]
    six = F.concat_ws("|", *picked)
    all_empty = F.concat(*picked) == F.lit("")
    return F.when(all_empty, F.concat_ws("|", *values)).otherwise(six)


# ---- B7 -----------------------------------------------------------------------

ROAD_ELEMENT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("center", T.StructType([T.StructField("lat", T.DoubleType()),
                                          T.StructField("lon", T.DoubleType())])),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])
ROAD_RESPONSE = T.StructType([T.StructField("elements", T.ArrayType(ROAD_ELEMENT))])


def expand_road_elements(responses: DataFrame, body: str = "elements",
                         source: str = "overpass_kyiv_highways",
                         keep: Sequence[str] = ()) -> DataFrame:
    """One row per ``way`` element; named tags picked from the open-ended
    tag map (a map, not a struct, so unknown keys never break the schema)."""
    el = F.col("el")
    tags = F.coalesce(el["tags"], F.create_map().cast("map<string,string>"))
    payload = F.struct(
        el["id"].alias("way_id"),
        *[tags[key].alias(name) for name, key in ROAD_TAG_PICKS],
        el["center"]["lat"].alias("center_lat"),
        el["center"]["lon"].alias("center_lon"),
        tags.alias("tags"),
    )
    return (responses.select(*keep, F.explode(F.col(body)).alias("el"))
            .filter(el["type"] == "way")
            .select(*keep, stable_event_id(
                source, F.concat(F.lit("way/"), el["id"].cast("string"))).alias("event_id"),
                payload.alias("payload")))


# ---- B8, B10 ----------------------------------------------------------------

def with_partition_keys(df: DataFrame, ts: Column | str = "ingest_ts") -> DataFrame:
    """``ingest_date``, ``hour``, ``part_stamp`` from the ingest instant
    (ISO strings are parsed first)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if isinstance(ts, str) and isinstance(df.schema[ts].dataType, T.StringType):
        c = F.try_to_timestamp(c, F.lit(INGEST_TS_FORMAT))
    return df.withColumns(partition_keys(c))


def first_capture_per_hour(captures: DataFrame, domain: str = "domain",
                           ts: str = "ingest_ts", file: str = "file") -> DataFrame:
    """A static domain is kept at most once per clock hour — the earliest
    capture (ties broken by file name) per (domain, hour).

    A grouped ``min(struct)`` aggregates partially before the shuffle, so a
    domain with a huge number of captures costs one row per task and hour."""
    first = F.min(F.struct(F.col(ts).alias("ts"), F.col(file).alias("file")))
    return (captures.groupBy(F.col(domain).alias("domain"),
                             F.date_trunc("hour", F.col(ts)).alias("hour_start"))
            .agg(first.alias("first"))
            .select("domain", "hour_start", F.col("first.ts").alias("ingest_ts"),
                    F.col("first.file").alias("file")))
