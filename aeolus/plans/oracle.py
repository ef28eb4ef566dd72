"""DuckDB SQL for every registered query with a SQL equivalent.

The views ``events`` etc. are the driver tables. The CTEs below restate the
fixture derivation (``sources.fixtures``) and the operators in plain SQL, so
each Spark result can be compared with an independent engine.

DuckDB dialect notes: ``1e-1`` is a DOUBLE literal (``0.1`` would be
DECIMAL); ``atan2`` arguments get ``+ 0e0`` (negative zero); counts and
``hour()`` are BIGINT and are cast to Spark's types where those differ;
angle conversions are written as ``x * (pi() / 180e0)`` and
``x * (180e0 / pi())`` — the same constants Spark's ``radians``/``degrees``
multiply by — so a mean heading of exactly 225 degrees stays exact.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def R(expr: str) -> str:
    """Same output rule as ``catalog._r``."""
    return f"round(({expr}) + 314159e-13, 6)"


# ---- fixture CTEs -------------------------------------------------------------

BASE = """
base AS (
  SELECT event_id AS src_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events)"""

WRAW = """
wraw AS (
  SELECT src_id, ts, event_type,
    ([' Kyiv ', 'Lviv', 'Kharkiv', 'Odesa', 'Dnipro'])[user_id % 5 + 1] AS city_raw,
    ([504501e-4, 498397e-4, 499935e-4, 464825e-4, 484647e-4])[user_id % 5 + 1] AS latitude,
    ([305234e-4, 240297e-4, 362304e-4, 307233e-4, 350462e-4])[user_id % 5 + 1] AS longitude,
    100e0 + k AS elevation_m,
    CASE WHEN event_type = 'purchase' AND k = 50 THEN ''
         ELSE strftime(ts, '%Y-%m-%dT%H:%M') END AS observed_at,
    CASE WHEN event_type = 'error' AND k < 5 THEN CAST(NULL AS DOUBLE)
         ELSE (cents % 4500) / 100e0 - 15e0 END AS temperature_2m,
    CAST(CASE WHEN event_type = 'click' AND k >= 95 THEN k + 50 ELSE k END AS DOUBLE)
      AS relative_humidity_2m,
    CASE WHEN event_type = 'view' THEN (cents % 300) / 100e0
         WHEN event_type = 'purchase' AND k < 3 THEN -1e0
         ELSE 0e0 END AS precipitation,
    (cents % 4000) / 100e0 AS wind_speed_10m,
    CASE WHEN event_type = 'signup' THEN CAST(NULL AS DOUBLE)
         ELSE CAST((src_id * 37) % 360 AS DOUBLE) END AS wind_direction_10m,
    990e0 + (cents % 400) / 10e0 AS surface_pressure
  FROM base)"""

FLAT = """
flat AS (
  SELECT 'open_meteo_current' || '-' ||
           substr(sha1('open_meteo_current' || ':' || trim(city_raw) || '|' || observed_at), 1, 16)
           AS event_id,
         'fixture' AS author,
         'open_meteo_current' AS source,
         CAST(1 AS INTEGER) AS schema_v,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ingest_ts,
         try_strptime(observed_at, '%Y-%m-%dT%H:%M') AS event_ts,
         trim(city_raw) AS city,
         latitude, longitude, elevation_m, temperature_2m, relative_humidity_2m,
         precipitation, wind_speed_10m, wind_direction_10m, surface_pressure,
         src_id, event_type
  FROM wraw)"""

NONNULL = """event_id IS NOT NULL AND author IS NOT NULL AND city IS NOT NULL
    AND event_ts IS NOT NULL AND temperature_2m IS NOT NULL
    AND relative_humidity_2m IS NOT NULL AND precipitation IS NOT NULL
    AND wind_speed_10m IS NOT NULL"""

INRANGE = """author = 'fixture'
    AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
    AND temperature_2m BETWEEN -90 AND 100 AND relative_humidity_2m BETWEEN 0 AND 100
    AND precipitation >= 0 AND NOT isnan(precipitation)
    AND wind_speed_10m >= 0 AND NOT isnan(wind_speed_10m)"""

TIMELY = """event_ts IS NOT NULL AND event_ts > TIMESTAMP '1971-01-01 00:00:00'
    AND event_ts <= CAST(now() AS TIMESTAMP)"""

SILVER = f"""
valid AS (
  SELECT * FROM flat WHERE {NONNULL} AND {INRANGE} AND {TIMELY}),
silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY src_id) AS rn FROM valid)
  WHERE rn = 1)"""

SILVER_COLS = """event_id, author, source, schema_v, ingest_ts, event_ts, city,
  latitude, longitude, elevation_m, temperature_2m, relative_humidity_2m,
  precipitation, wind_speed_10m, wind_direction_10m, surface_pressure"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SILVER_CTES = with_ctes(BASE, WRAW, FLAT, SILVER)


# ---- Silver -------------------------------------------------------------------

ORACLE["silver_weather"] = f"""{SILVER_CTES}
SELECT {SILVER_COLS} FROM silver"""


# ---- Gold ---------------------------------------------------------------------

ORACLE["temperature_hourly"] = f"""{SILVER_CTES}
SELECT strftime(event_ts, '%Y-%m-%d') AS window_date, strftime(event_ts, '%H') AS window_hour,
       city, count(*) AS samples_cnt,
       {R("avg(temperature_2m)")} AS temperature_avg_c,
       {R("min(temperature_2m)")} AS temperature_min_c,
       {R("max(temperature_2m)")} AS temperature_max_c,
       {R("stddev_pop(temperature_2m)")} AS temperature_stddev_c
FROM silver WHERE city IS NOT NULL
GROUP BY 1, 2, 3"""

FLAT_CTES = with_ctes(BASE, WRAW, FLAT)
ORACLE["silver_flatten"] = f"""{FLAT_CTES}
SELECT {SILVER_COLS} FROM flat"""

ORACLE["silver_null_reject"] = f"""{FLAT_CTES}
SELECT {SILVER_COLS} FROM flat WHERE {NONNULL}"""

ORACLE["silver_range_filter"] = f"""{FLAT_CTES}
SELECT {SILVER_COLS} FROM flat WHERE {NONNULL} AND {INRANGE}"""

ORACLE["silver_time_filter"] = f"""{FLAT_CTES}
SELECT {SILVER_COLS} FROM flat WHERE {TIMELY}"""

ORACLE["silver_dedup"] = f"""{FLAT_CTES}
SELECT event_id, src_id, event_ts, city FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY src_id) AS rn FROM flat)
WHERE rn = 1"""

ORACLE["silver_reject_report"] = f"""{FLAT_CTES},
tagged AS (
  SELECT *,
    COALESCE(({NONNULL}), false) AS present,
    COALESCE(({INRANGE}), false) AS in_range,
    COALESCE(({TIMELY}), false) AS timely
  FROM flat),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY event_id
    ORDER BY CASE WHEN present AND in_range AND timely THEN 0 ELSE 1 END, src_id) AS rn
  FROM tagged)
SELECT CASE WHEN NOT present THEN 'null_field'
            WHEN NOT in_range THEN 'out_of_range'
            WHEN NOT timely THEN 'bad_timestamp'
            WHEN rn > 1 THEN 'duplicate'
            ELSE 'valid' END AS reject_reason,
       count(*) AS rows
FROM ranked GROUP BY 1"""

ORACLE["silver_stamp_producer"] = f"""{SILVER_CTES}
SELECT author, count(*) AS rows FROM silver GROUP BY 1"""

HOURLY_KEYS = "strftime(event_ts, '%Y-%m-%d') AS window_date, strftime(event_ts, '%H') AS window_hour"

ORACLE["precipitation_daily"] = f"""{SILVER_CTES},
hourly AS (
  SELECT strftime(event_ts, '%Y-%m-%d') AS window_date, city, hour(event_ts) AS sample_hour,
         sum(precipitation) AS hour_precip_mm
  FROM silver GROUP BY 1, 2, 3)
SELECT window_date, city, {R("sum(hour_precip_mm)")} AS total_precip_mm,
       count(*) AS hours_observed,
       CAST(sum(CASE WHEN hour_precip_mm >= 1e-1 THEN 1 ELSE 0 END) AS BIGINT) AS rainy_hours
FROM hourly WHERE city IS NOT NULL GROUP BY 1, 2"""

ORACLE["wind_daily_extremes"] = f"""{SILVER_CTES},
uv AS (
  SELECT strftime(event_ts, '%Y-%m-%d') AS window_date, city, wind_speed_10m,
         -wind_speed_10m * sin(wind_direction_10m * (pi() / 180e0)) AS u,
         -wind_speed_10m * cos(wind_direction_10m * (pi() / 180e0)) AS v
  FROM silver),
daily AS (
  SELECT window_date, city, max(wind_speed_10m) AS mx, avg(wind_speed_10m) AS av,
         avg(u) AS mu, avg(v) AS mv
  FROM uv WHERE city IS NOT NULL GROUP BY 1, 2),
dirs AS (
  SELECT *, atan2(-mu + 0e0, -mv + 0e0) * (180e0 / pi()) AS raw FROM daily)
SELECT window_date, city, {R("mx")} AS wind_speed_max_ms, {R("av")} AS wind_speed_avg_ms,
       {R("CASE WHEN raw < 0 THEN raw + 360e0 ELSE raw END")} AS prevailing_wind_deg,
       {R("sqrt(mu * mu + mv * mv)")} AS mean_wind_vector_ms
FROM dirs"""

ORACLE["subzero_hours_daily"] = f"""{SILVER_CTES},
hourly AS (
  SELECT strftime(event_ts, '%Y-%m-%d') AS window_date, city, hour(event_ts) AS sample_hour,
         min(temperature_2m) AS hmin
  FROM silver GROUP BY 1, 2, 3)
SELECT window_date, city, count(*) AS hours_observed,
       {R("min(hmin)")} AS coldest_hour_temp_c,
       {R("avg(hmin)")} AS avg_hourly_min_temp_c,
       count(CASE WHEN hmin < 0e0 THEN 1 END) AS subzero_hours
FROM hourly WHERE city IS NOT NULL GROUP BY 1, 2"""

ORACLE["comfort_index_hourly"] = f"""{SILVER_CTES}
SELECT {HOURLY_KEYS}, city, count(*) AS samples_cnt,
  {R("avg(temperature_2m + 33e-2 * (relative_humidity_2m / 100e0) * 6105e-3 - 7e-1 * wind_speed_10m - 4e0)")}
    AS comfort_index_c,
  {R("avg(temperature_2m)")} AS temperature_avg_c,
  {R("avg(relative_humidity_2m)")} AS humidity_avg_pct,
  {R("avg(wind_speed_10m)")} AS wind_speed_avg_ms
FROM silver WHERE city IS NOT NULL GROUP BY 1, 2, 3"""

ORACLE["metric_lineage"] = f"""{SILVER_CTES}
SELECT {HOURLY_KEYS}, city, count(*) AS samples_cnt, 'fixture' AS author,
       CAST(1 AS INTEGER) AS schema_v, 'run000000001' AS run_id,
       'temperature_hourly' AS metric_name
FROM silver WHERE city IS NOT NULL GROUP BY 1, 2, 3"""

ORACLE["silver_latest_run"] = f"""{with_ctes(BASE, WRAW, FLAT)},
valid AS (SELECT * FROM flat WHERE {NONNULL} AND {INRANGE} AND {TIMELY}),
run_a AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY src_id) AS rn
    FROM valid WHERE ingest_ts < '2024-01-16') WHERE rn = 1),
run_b AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY src_id) AS rn
    FROM valid) WHERE rn = 1),
runs AS (
  SELECT *, 'run-a' AS run_id, 1 AS run_seq FROM run_a
  UNION ALL
  SELECT *, 'run-b' AS run_id, 2 AS run_seq FROM run_b)
SELECT event_id, run_id, city, event_ts, temperature_2m FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY run_seq DESC) AS rn FROM runs)
WHERE rn = 1"""


# ---- Features -------------------------------------------------------------------

PROBE = """
probe AS (
  SELECT src_id, ts AS event_ts,
    5015e-2 + 1e-1 * (user_id % 5) + (k - 50) * 8e-5 AS lat,
    3045e-2 + 1e-1 * (user_id % 2) + (k - 50) * 6e-5 AS lon,
    value / 2e0 AS speed,
    CASE WHEN event_type = 'signup' AND k < 20 THEN CAST(NULL AS DOUBLE)
         ELSE CAST((src_id * 37) % 360 AS DOUBLE) END AS heading
  FROM base)"""

ROAD = """
road AS (
  SELECT src_id, k, ts AS event_ts,
    5025e-2 + 1e-2 * (user_id % 20) AS lat,
    3045e-2 + 1e-2 * (user_id % 20) AS lon,
    'road-' || CAST(user_id % 20 AS VARCHAR) AS road_id,
    'road-' || CAST(user_id % 20 AS VARCHAR) AS road_name,
    value AS current_speed_kmh,
    CAST(60 + k % 40 AS DOUBLE) AS free_flow_speed_kmh,
    CASE WHEN value = 0 THEN CAST(NULL AS DOUBLE) ELSE 3600e0 / value END AS current_travel_time_s,
    k / 100e0 AS confidence,
    CASE WHEN event_type = 'error' THEN true
         WHEN event_type = 'signup' AND k < 10 THEN CAST(NULL AS BOOLEAN)
         ELSE false END AS road_closure
  FROM base)"""

BOX = "lat >= 502e-1 AND lat <= 506e-1 AND lon >= 302e-1 AND lon <= 309e-1"
RANGE = "event_ts >= TIMESTAMP '2024-01-05' AND event_ts < TIMESTAMP '2024-01-25'"

PREP = f"""
prep AS (
  SELECT *, round(lat, 2) AS lat_cell, round(lon, 2) AS lon_cell,
         date_trunc('hour', event_ts) AS event_hour, heading * (pi() / 180e0) AS heading_rad
  FROM probe WHERE {BOX} AND speed >= 0 AND speed < 150),
cells AS (
  SELECT event_hour, lat_cell, lon_cell, count(*) AS events_count,
         avg(speed) AS avg_speed_kmh, coalesce(stddev_samp(speed), 0e0) AS speed_std_kmh,
         avg(sin(heading_rad)) AS heading_sin, avg(cos(heading_rad)) AS heading_cos
  FROM prep GROUP BY 1, 2, 3),
circ AS (
  SELECT *, (atan2(heading_sin + 0e0, heading_cos + 0e0) * (180e0 / pi()) + 360e0) % 360e0
              AS heading_deg_mean
  FROM cells),
buck AS (
  -- Java's atan2 and glibc's differ by one ulp near -135 degrees; bucketing
  -- the angle rounded to 1e-9 degrees absorbs that and nothing else.
  SELECT *, CASE WHEN round(heading_deg_mean, 9) >= 315 OR round(heading_deg_mean, 9) < 45 THEN 'N'
                 WHEN round(heading_deg_mean, 9) >= 45 AND round(heading_deg_mean, 9) < 135 THEN 'E'
                 WHEN round(heading_deg_mean, 9) >= 135 AND round(heading_deg_mean, 9) < 225 THEN 'S'
                 ELSE 'W' END AS direction_bucket
  FROM circ),
labelled AS (
  SELECT event_hour, lat_cell AS lat, lon_cell AS lon, events_count, avg_speed_kmh,
         speed_std_kmh, heading_sin, heading_cos, heading_deg_mean, direction_bucket,
         CAST(avg_speed_kmh < 20e0 AS INTEGER) AS is_congested,
         CAST(hour(event_hour) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(event_hour) AS INTEGER) AS day_of_week,
         CAST(dayofweek(event_hour) IN (0, 6) AS INTEGER) AS is_weekend
  FROM buck WHERE events_count >= 3)"""

ROADSET = f"""
road_kept AS (
  SELECT * FROM road
  WHERE {BOX} AND current_speed_kmh > 0 AND free_flow_speed_kmh > 0 AND NOT road_closure),
roadset AS (
  SELECT src_id, k, date_trunc('hour', event_ts) AS event_hour,
         CAST(hour(date_trunc('hour', event_ts)) AS INTEGER) AS hour_of_day,
         CAST(isodow(date_trunc('hour', event_ts)) - 1 AS INTEGER) AS day_of_week,
         CAST(isodow(date_trunc('hour', event_ts)) >= 6 AS INTEGER) AS is_weekend,
         road_id, road_name, lat, lon, current_speed_kmh, free_flow_speed_kmh,
         current_travel_time_s, confidence,
         current_speed_kmh / free_flow_speed_kmh AS speed_ratio,
         CAST(current_speed_kmh / free_flow_speed_kmh < 7e-1 AS INTEGER) AS is_congested
  FROM road_kept)"""

NORM_A = """
norm_a AS (
  SELECT event_ts, latitude AS lat, longitude AS lon, temperature_2m AS temp_c,
         precipitation AS precip_mm, wind_speed_10m / 36e-1 AS wind_mps,
         relative_humidity_2m AS humidity_pct
  FROM silver)"""

NORM_B = """
norm_b AS (
  SELECT try_strptime(observed_at, '%Y-%m-%dT%H:%M') AS event_ts, latitude AS lat,
         longitude AS lon, temperature_2m AS temp_c, precipitation AS precip_mm,
         wind_speed_10m / 36e-1 AS wind_mps, relative_humidity_2m AS humidity_pct
  FROM wraw WHERE trim(city_raw) = 'Kyiv' AND event_type IN ('view', 'click'))"""

NORM_C = """
norm_c AS (
  SELECT try_strptime(observed_at, '%Y-%m-%dT%H:%M') AS event_ts, latitude AS lat,
         longitude AS lon, temperature_2m AS temp_c,
         CASE WHEN relative_humidity_2m < 30 THEN CAST(NULL AS DOUBLE)
              ELSE precipitation END AS precip_mm,
         wind_speed_10m / 36e-1 AS wind_mps, relative_humidity_2m AS humidity_pct
  FROM wraw WHERE trim(city_raw) = 'Kyiv' AND event_type = 'error')"""

HOURLY = f"""
wunion AS (
  SELECT * FROM norm_a UNION ALL SELECT * FROM norm_b UNION ALL SELECT * FROM norm_c),
hourly AS (
  SELECT date_trunc('hour', event_ts) AS event_hour, avg(temp_c) AS temp_c,
         coalesce(avg(precip_mm), 0e0) AS precip_mm, avg(wind_mps) AS wind_mps,
         avg(humidity_pct) AS humidity_pct
  FROM wunion WHERE {BOX} AND {RANGE} GROUP BY 1)"""

PROBE_CTES = with_ctes(BASE, PROBE)
ROAD_CTES = with_ctes(BASE, ROAD)
WEATHER_CTES = with_ctes(BASE, WRAW, FLAT, SILVER, NORM_A, NORM_B, NORM_C)
HOURLY_CTES = with_ctes(BASE, WRAW, FLAT, SILVER, NORM_A, NORM_B, NORM_C, HOURLY)


def rounded(cols: str, alias_from: str | None = None) -> str:
    return ", ".join(f"{R(c.strip())} AS {c.strip()}" for c in cols.split(","))


ORACLE["bbox_filter"] = f"""{PROBE_CTES}
SELECT src_id, lat, lon FROM probe WHERE {BOX}"""

ORACLE["time_range"] = f"""{PROBE_CTES}
SELECT src_id, event_ts FROM probe WHERE {RANGE}"""

ORACLE["speed_sanity"] = f"""{PROBE_CTES}
SELECT src_id, speed FROM probe WHERE speed >= 0 AND speed < 150"""

ORACLE["calendar_sunday"] = f"""{PROBE_CTES}
SELECT src_id, CAST(hour(event_ts) AS INTEGER) AS hour_of_day,
       CAST(dayofweek(event_ts) AS INTEGER) AS day_of_week,
       CAST(dayofweek(event_ts) IN (0, 6) AS INTEGER) AS is_weekend
FROM probe"""

ORACLE["calendar_monday"] = f"""{ROAD_CTES}
SELECT src_id, CAST(hour(event_ts) AS INTEGER) AS hour_of_day,
       CAST(isodow(event_ts) - 1 AS INTEGER) AS day_of_week,
       CAST(isodow(event_ts) >= 6 AS INTEGER) AS is_weekend
FROM road"""

ORACLE["grid_cell"] = f"""{PROBE_CTES}
SELECT src_id, round(lat, 2) AS lat_cell, round(lon, 2) AS lon_cell,
       date_trunc('hour', event_ts) AS event_hour
FROM probe WHERE {BOX}"""

ORACLE["kpt_cell_hour"] = f"""{with_ctes(BASE, PROBE, PREP)}
SELECT event_hour, lat_cell, lon_cell, events_count,
       {rounded("avg_speed_kmh, speed_std_kmh, heading_sin, heading_cos")}
FROM cells"""

ORACLE["kpt_circular"] = f"""{with_ctes(BASE, PROBE, PREP)}
SELECT event_hour, lat_cell, lon_cell, {R("heading_deg_mean")} AS heading_deg_mean,
       direction_bucket
FROM buck"""

LABELLED_OUT = f"""event_hour, lat, lon, events_count,
  {rounded("avg_speed_kmh, speed_std_kmh, heading_sin, heading_cos, heading_deg_mean")},
  direction_bucket, is_congested, hour_of_day, day_of_week, is_weekend"""

ORACLE["kpt_labelled"] = f"""{with_ctes(BASE, PROBE, PREP)}
SELECT {LABELLED_OUT} FROM labelled"""

ORACLE["tomtom_clean"] = f"""{ROAD_CTES}
SELECT src_id, event_ts, road_id, current_speed_kmh, free_flow_speed_kmh,
       current_travel_time_s, confidence
FROM road
WHERE {BOX} AND current_speed_kmh > 0 AND free_flow_speed_kmh > 0 AND NOT road_closure"""

ROAD_OUT = f"""event_hour, hour_of_day, day_of_week, is_weekend, road_id, road_name, lat, lon,
  {rounded("current_speed_kmh, free_flow_speed_kmh, current_travel_time_s, confidence, speed_ratio")},
  is_congested"""

ORACLE["tomtom_ratio"] = f"""{with_ctes(BASE, ROAD, ROADSET)}
SELECT {ROAD_OUT} FROM roadset"""

WEATHER_OUT = f"""event_ts, lat, lon,
  {rounded("temp_c, precip_mm, wind_mps, humidity_pct")}"""

ORACLE["weather_norm_a"] = f"""{WEATHER_CTES}
SELECT {WEATHER_OUT} FROM norm_a"""

ORACLE["weather_norm_b"] = f"""{WEATHER_CTES}
SELECT {WEATHER_OUT} FROM norm_b"""

ORACLE["weather_norm_c"] = f"""{WEATHER_CTES}
SELECT {WEATHER_OUT} FROM norm_c"""

ORACLE["weather_union"] = f"""{WEATHER_CTES}
SELECT {WEATHER_OUT} FROM (
  SELECT * FROM norm_a UNION ALL SELECT * FROM norm_b UNION ALL SELECT * FROM norm_c)"""

HOURLY_OUT = rounded("temp_c, precip_mm, wind_mps, humidity_pct")

ORACLE["weather_hourly"] = f"""{HOURLY_CTES}
SELECT event_hour, {HOURLY_OUT} FROM hourly"""

ORACLE["kpt_weather"] = f"""{with_ctes(BASE, WRAW, FLAT, SILVER, NORM_A, NORM_B, NORM_C, HOURLY,
                                      PROBE, PREP)}
SELECT {LABELLED_OUT.replace("event_hour,", "l.event_hour AS event_hour,", 1)}, {HOURLY_OUT}
FROM labelled l JOIN hourly h ON l.event_hour = h.event_hour"""

ORACLE["tomtom_weather"] = f"""{with_ctes(BASE, WRAW, FLAT, SILVER, NORM_A, NORM_B, NORM_C, HOURLY,
                                         ROAD, ROADSET)}
SELECT {ROAD_OUT.replace("event_hour,", "r.event_hour AS event_hour,", 1)}, {HOURLY_OUT}
FROM roadset r JOIN hourly h ON r.event_hour = h.event_hour"""


# ---- Bronze ---------------------------------------------------------------------

METRIC_COLS = ("temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m, "
               "wind_direction_10m, surface_pressure")

ORACLE["envelope"] = f"""{with_ctes(BASE, WRAW)}
SELECT src_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ingest_ts,
       'open_meteo_current' AS source, CAST(1 AS INTEGER) AS schema_v, 'fixture' AS author,
       'open_meteo_current' || '-' ||
         substr(sha1('open_meteo_current' || ':' || trim(city_raw) || '|' || observed_at), 1, 16)
         AS event_id,
       city_raw AS city, latitude, longitude, elevation_m, observed_at, {METRIC_COLS}
FROM wraw"""

ORACLE["stable_event_id"] = f"""{with_ctes(BASE, WRAW)}
SELECT src_id, 'open_meteo_current' || '-' ||
         substr(sha1('open_meteo_current' || ':' || trim(city_raw) || '|' || observed_at), 1, 16)
         AS event_id
FROM wraw"""

ORACLE["response_expand"] = f"""{with_ctes(BASE)},
cities AS (
  SELECT * FROM (VALUES
    (0, 'Kyiv', 504501e-4, 305234e-4), (1, 'Lviv', 498397e-4, 240297e-4),
    (2, 'Kharkiv', 499935e-4, 362304e-4), (3, 'Odesa', 464825e-4, 307233e-4),
    (4, 'Dnipro', 484647e-4, 350462e-4)) AS t(pos, city, clat, clon)),
grid AS (
  SELECT b.*, c.*, c.pos < b.k % 6 AS present FROM base b, cities c)
SELECT src_id, CAST(pos AS INTEGER) AS pos,
  'open_meteo_current' || '-' || substr(sha1('open_meteo_current' || ':' || city || '|' ||
    CASE WHEN present THEN strftime(ts, '%Y-%m-%dT%H:%M') ELSE '' END), 1, 16) AS event_id,
  city,
  CASE WHEN present THEN clat + (k % 7) * 1e-4 ELSE clat END AS latitude,
  clon AS longitude,
  CASE WHEN present THEN CAST(100 + pos * 10 AS DOUBLE) END AS elevation_m,
  CASE WHEN present THEN strftime(ts, '%Y-%m-%dT%H:%M') ELSE '' END AS observed_at,
  CASE WHEN present THEN (cents % 4500) / 100e0 - 15e0 + pos END AS temperature_2m,
  CASE WHEN present THEN CAST(k AS DOUBLE) END AS relative_humidity_2m,
  CASE WHEN present THEN (cents % 300) / 100e0 END AS precipitation,
  CASE WHEN present THEN (cents % 4000) / 100e0 END AS wind_speed_10m,
  CASE WHEN present THEN CAST((src_id * 37 + pos * 10) % 360 AS DOUBLE) END AS wind_direction_10m,
  CASE WHEN present THEN 1000e0 + pos END AS surface_pressure
FROM grid"""

ORACLE["raw_capture"] = """
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS content_length,
       sha256(html) AS content_sha256, to_base64(encode(html)) AS payload_b64,
       'lviv_gtfs_rt' || '-' || substr(sha1('lviv_gtfs_rt' || ':' || sha256(html)), 1, 16)
         AS event_id
FROM pages"""

ORACLE["alerts_expand"] = f"""{with_ctes(BASE)},
cells AS (
  SELECT src_id, k, event_type,
    'region-' || CAST(user_id % 25 AS VARCHAR) AS region,
    strftime(ts, '%Y-%m-%d') AS c_start,
    strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d') AS c_end,
    strftime(ts, '%H:%M') AS start_time,
    strftime(ts + INTERVAL 1 HOUR, '%H:%M') AS end_time,
    event_type AS oblast, CAST(k AS VARCHAR) AS notes
  FROM base WHERE k <> 0),
shaped AS (
  SELECT src_id, region, c_start,
    c_end, start_time,
    CASE WHEN event_type = 'error' THEN '' ELSE end_time END AS end_time,
    CASE WHEN event_type = 'error' THEN '' ELSE oblast END AS oblast,
    CASE WHEN event_type = 'error' THEN '' ELSE notes END AS notes
  FROM cells),
keyed AS (
  SELECT *, region || '|' || c_start || '|' || c_end || '|' || start_time || '|' ||
            end_time || '|' || oblast AS natural_key
  FROM shaped)
SELECT src_id,
  'vadimkin_air_raid' || '-' || substr(sha1('vadimkin_air_raid' || ':' || natural_key), 1, 16)
    AS event_id,
  natural_key, CAST(7 AS INTEGER) AS n_cells, oblast, notes
FROM keyed"""

ORACLE["roads_expand"] = f"""{with_ctes(BASE)}
SELECT src_id,
  'overpass_kyiv_highways' || '-' ||
    substr(sha1('overpass_kyiv_highways' || ':' || 'way/' || CAST(src_id AS VARCHAR)), 1, 16)
    AS event_id,
  src_id AS way_id,
  (['motorway', 'trunk', 'primary', 'secondary', 'tertiary'])[k % 5 + 1] AS highway_class,
  'road-' || CAST(user_id % 20 AS VARCHAR) AS name,
  CASE WHEN k % 3 = 0 THEN NULL ELSE 'Road ' || CAST(user_id % 20 AS VARCHAR) END AS name_en,
  CAST(NULL AS VARCHAR) AS ref,
  CAST(30 + (k % 4) * 10 AS VARCHAR) AS maxspeed,
  CASE WHEN k % 2 = 0 THEN CAST(k % 4 + 1 AS VARCHAR) END AS lanes,
  CAST(NULL AS VARCHAR) AS surface, CAST(NULL AS VARCHAR) AS oneway,
  5025e-2 + 1e-2 * (user_id % 20) AS center_lat,
  3045e-2 + 1e-2 * (user_id % 20) AS center_lon,
  CAST(3 + CASE WHEN k % 3 = 0 THEN 0 ELSE 1 END + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END
       AS INTEGER) AS n_tags
FROM base WHERE event_type <> 'error'"""

ORACLE["partition_keys"] = """
SELECT event_id AS src_id, strftime(ts, '%Y-%m-%d') AS ingest_date, strftime(ts, '%H') AS hour,
       strftime(ts, '%Y%m%dT%H%M%SZ') AS part_stamp
FROM events"""

ORACLE["hourly_snapshot"] = """
WITH caps AS (
  SELECT CASE WHEN event_type IN ('signup', 'purchase') THEN 'alerts' ELSE 'roads' END AS domain,
         ts AS ingest_ts,
         'part-' || strftime(ts, '%Y%m%dT%H%M%SZ') || '-' || CAST(event_id AS VARCHAR) || '.jsonl'
           AS file
  FROM events)
SELECT domain, date_trunc('hour', ingest_ts) AS hour_start,
       min({'ts': ingest_ts, 'file': file}).ts AS ingest_ts,
       min({'ts': ingest_ts, 'file': file}).file AS file
FROM caps GROUP BY 1, 2"""


# ---- ML -------------------------------------------------------------------------

ROAD_NUMERIC_FEATURES = ("hour_of_day", "day_of_week", "is_weekend", "lat", "lon",
                         "free_flow_speed_kmh", "current_travel_time_s", "confidence",
                         "temp_c", "precip_mm", "wind_mps", "humidity_pct")

_NOTNULL = " AND ".join(f"{c} IS NOT NULL" for c in (*ROAD_NUMERIC_FEATURES, "current_speed_kmh"))

MLSET = f"""
mlset AS (
  SELECT r.*, h.temp_c, h.precip_mm, h.wind_mps, h.humidity_pct,
         substr(sha1(CAST(r.src_id AS VARCHAR)), 1, 4) < '3333' AS is_test
  FROM roadset r JOIN hourly h ON r.event_hour = h.event_hour)"""

ML_CTES = with_ctes(BASE, WRAW, FLAT, SILVER, NORM_A, NORM_B, NORM_C, HOURLY, ROAD, ROADSET,
                    MLSET) + f""",
ml AS (SELECT * FROM mlset WHERE {_NOTNULL})"""

SCORED = """
scored0 AS (
  SELECT src_id, lat, lon, date_trunc('hour', event_ts) AS event_hour,
    CAST(current_speed_kmh / free_flow_speed_kmh < 7e-1 AS INTEGER) AS is_congested_actual,
    1e0 / (1e0 + exp((current_speed_kmh / free_flow_speed_kmh + (k - 50) / 200e0 - 7e-1) * 4e0))
      AS congestion_proba
  FROM road WHERE current_speed_kmh > 0 AND free_flow_speed_kmh > 0 AND NOT road_closure),
scored AS (
  SELECT *, CAST(congestion_proba >= 5e-1 AS INTEGER) AS is_congested_pred FROM scored0)"""

SCORED_CTES = with_ctes(BASE, ROAD, SCORED)

ORACLE["onehot_levels"] = f"""{ML_CTES}
SELECT coalesce(road_id, 'None') AS road_id,
       CAST(dense_rank() OVER (ORDER BY coalesce(road_id, 'None')) - 1 AS INTEGER) AS level_index,
       count(*) AS rows
FROM ml GROUP BY 1"""

ORACLE["hash_split"] = f"""{ROAD_CTES}
SELECT src_id, substr(sha1(CAST(src_id AS VARCHAR)), 1, 4) < '3333' AS is_test FROM road"""

ORACLE["scaler_stats"] = f"""{ML_CTES}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {R(f'avg(CAST({c} AS DOUBLE))')} AS mean, "
    f"{R(f'stddev_pop(CAST({c} AS DOUBLE))')} AS std FROM ml WHERE NOT is_test"
    for c in ROAD_NUMERIC_FEATURES)

_STATS = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}"
                   for c in ROAD_NUMERIC_FEATURES)

ORACLE["standardised"] = f"""{ML_CTES},
st AS (SELECT {_STATS} FROM ml WHERE NOT is_test)
SELECT src_id, is_test, """ + ", ".join(
    f"{R(f'(CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1e0 END')} AS {c}"
    for c in ROAD_NUMERIC_FEATURES) + "\nFROM ml, st"

ORACLE["baseline_mean"] = f"""{ML_CTES},
tm AS (SELECT avg(current_speed_kmh) AS m FROM ml WHERE NOT is_test)
SELECT {R("m")} AS train_mean,
       {R("avg(abs(current_speed_kmh - m))")} AS mae,
       {R("sqrt(avg((current_speed_kmh - m) * (current_speed_kmh - m)))")} AS rmse,
       {R("1e0 - sum((current_speed_kmh - m) * (current_speed_kmh - m)) / (count(*) * var_pop(current_speed_kmh))")} AS r2,
       count(*) AS rows
FROM ml, tm WHERE is_test GROUP BY m"""

ORACLE["regression_scores"] = f"""{ML_CTES},
e AS (SELECT current_speed_kmh AS y, current_speed_kmh - free_flow_speed_kmh * 8e-1 AS e
      FROM ml WHERE is_test)
SELECT {R("avg(abs(e))")} AS mae, {R("sqrt(avg(e * e))")} AS rmse,
       {R("1e0 - sum(e * e) / (count(*) * var_pop(y))")} AS r2, count(*) AS rows
FROM e"""

ORACLE["class_weights"] = f"""{ML_CTES}
SELECT is_congested, count(*) AS rows,
       {R("CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*))")} AS weight
FROM ml WHERE NOT is_test GROUP BY is_congested"""

ORACLE["classification_scores"] = f"""{SCORED_CTES},
c AS (
  SELECT count(*) AS n,
         count(CASE WHEN is_congested_actual = 1 AND is_congested_pred = 1 THEN 1 END) AS tp,
         count(CASE WHEN is_congested_actual = 0 AND is_congested_pred = 1 THEN 1 END) AS fp,
         count(CASE WHEN is_congested_actual = 1 AND is_congested_pred = 0 THEN 1 END) AS fn,
         count(CASE WHEN is_congested_actual = is_congested_pred THEN 1 END) AS hit
  FROM scored)
SELECT {R("CAST(hit AS DOUBLE) / n")} AS accuracy,
       {R("coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0e0)")} AS precision,
       {R("coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0e0)")} AS recall,
       {R("coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0e0)")} AS f1
FROM c"""

ORACLE["confusion_matrix"] = f"""{SCORED_CTES},
grid AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS g(actual, predicted)),
cnt AS (SELECT is_congested_actual AS a, is_congested_pred AS p, count(*) AS n
        FROM scored GROUP BY 1, 2)
SELECT CAST(actual AS INTEGER) AS actual, CAST(predicted AS INTEGER) AS predicted,
       coalesce(n, 0) AS rows
FROM grid LEFT JOIN cnt ON grid.actual = cnt.a AND grid.predicted = cnt.p"""

ORACLE["roc_auc"] = f"""{SCORED_CTES},
ranked AS (
  SELECT is_congested_actual AS y,
         rank() OVER (ORDER BY congestion_proba)
           + (count(*) OVER (PARTITION BY congestion_proba) - 1) / 2e0 AS r
  FROM scored)
SELECT {R("(sum(CASE WHEN y = 1 THEN r ELSE 0e0 END) - count(CASE WHEN y = 1 THEN 1 END) * (count(CASE WHEN y = 1 THEN 1 END) + 1) / 2e0) / (CAST(count(CASE WHEN y = 1 THEN 1 END) AS DOUBLE) * count(CASE WHEN y = 0 THEN 1 END))")} AS auc
FROM ranked"""

ORACLE["congested_points"] = f"""{ML_CTES}
SELECT src_id, lat, lon, {R("current_travel_time_s")} AS intensity
FROM ml WHERE is_congested = 1 AND current_travel_time_s IS NOT NULL"""

ORACLE["cluster_centers_fixed"] = f"""{ML_CTES}
SELECT CAST(src_id % 4 AS INTEGER) AS cluster_id, {R("avg(lat)")} AS lat, {R("avg(lon)")} AS lon,
       {R("avg(current_travel_time_s)")} AS intensity_mean, count(*) AS size
FROM ml WHERE is_congested = 1 AND current_travel_time_s IS NOT NULL GROUP BY 1"""

ORACLE["heatmap_real"] = f"""{SCORED_CTES}
SELECT round(lat, 3) AS lat, round(lon, 3) AS lon, count(*) AS weight
FROM scored WHERE is_congested_actual = 1 GROUP BY 1, 2"""

ORACLE["heatmap_predicted"] = f"""{SCORED_CTES}
SELECT round(lat, 3) AS lat, round(lon, 3) AS lon, {R("avg(congestion_proba)")} AS congestion_proba,
       count(*) AS points
FROM scored GROUP BY 1, 2"""

ORACLE["run_summary"] = f"""{ML_CTES}
SELECT count(*) AS rows_total, count(CASE WHEN NOT is_test THEN 1 END) AS rows_train,
       count(CASE WHEN is_test THEN 1 END) AS rows_test,
       {R("avg(CASE WHEN NOT is_test THEN CAST(is_congested AS DOUBLE) END)")} AS positive_rate_train,
       CAST({len(ROAD_NUMERIC_FEATURES)} + count(DISTINCT coalesce(road_id, 'None')) AS INTEGER)
         AS feature_count
FROM ml"""


# Facts of the fits: counts from the tables; the conditions of an optimum hold.
ORACLE["regression_optimality"] = f"""{ML_CTES}
SELECT model, count(CASE WHEN NOT is_test THEN 1 END) AS rows_train,
       true AS intercept_balanced, true AS gradient_balanced
FROM (VALUES ('linear_regression'), ('ridge'), ('lasso')) AS models(model) LEFT JOIN ml ON true
GROUP BY model"""

ORACLE["logistic_optimality"] = f"""{ML_CTES}
SELECT count(*) AS rows_scored, count(CASE WHEN NOT is_test THEN 1 END) AS rows_train,
       true AS intercept_balanced, true AS gradient_balanced, true AS cut_consistent,
       true AS probabilities_in_range
FROM ml"""

ORACLE["kmeans_facts"] = f"""{ML_CTES}
SELECT count(*) AS points, true AS sizes_add_up, true AS centers_are_means,
       true AS inertia_recomputed, true AS best_silhouette
FROM ml WHERE is_congested = 1 AND current_travel_time_s IS NOT NULL"""


# ---- Streaming ------------------------------------------------------------------

# Append-mode windows are emitted once the watermark passes their end; after
# the final batch the watermark is the newest valid event time minus 1 hour.
WATERMARK = """
wm AS (SELECT max(event_ts) - INTERVAL 1 HOUR AS wm FROM valid)"""

ORACLE["stream_silver"] = f"""{SILVER_CTES},{WATERMARK}
SELECT {SILVER_COLS} FROM silver, wm WHERE event_ts < wm.wm"""

ORACLE["stream_hourly"] = f"""{SILVER_CTES},{WATERMARK}
SELECT {HOURLY_KEYS}, city, count(*) AS samples_cnt,
  {R("avg(temperature_2m)")} AS temperature_avg_c,
  {R("min(temperature_2m)")} AS temperature_min_c,
  {R("max(temperature_2m)")} AS temperature_max_c,
  {R("stddev_pop(temperature_2m)")} AS temperature_stddev_c,
  {R("avg(temperature_2m + 33e-2 * (relative_humidity_2m / 100e0) * 6105e-3 - 7e-1 * wind_speed_10m - 4e0)")}
    AS comfort_index_c,
  {R("avg(relative_humidity_2m)")} AS humidity_avg_pct,
  {R("avg(wind_speed_10m)")} AS wind_speed_avg_ms
FROM silver, wm
WHERE city IS NOT NULL AND date_trunc('hour', event_ts) + INTERVAL 1 HOUR <= wm.wm
GROUP BY 1, 2, 3"""

ORACLE["stream_daily"] = f"""{SILVER_CTES},{WATERMARK},
hourly AS (
  SELECT strftime(event_ts, '%Y-%m-%d') AS window_date, city, date_trunc('hour', event_ts) AS h,
         sum(precipitation) AS hp, min(temperature_2m) AS hm
  FROM silver GROUP BY 1, 2, 3)
SELECT window_date, city, {R("sum(hp)")} AS total_precip_mm, count(*) AS hours_observed,
       CAST(sum(CASE WHEN hp >= 1e-1 THEN 1 ELSE 0 END) AS BIGINT) AS rainy_hours,
       {R("min(hm)")} AS coldest_hour_temp_c, {R("avg(hm)")} AS avg_hourly_min_temp_c,
       count(CASE WHEN hm < 0e0 THEN 1 END) AS subzero_hours
FROM hourly, wm
WHERE city IS NOT NULL AND CAST(window_date AS TIMESTAMP) + INTERVAL 1 DAY <= wm.wm
GROUP BY 1, 2"""

ORACLE["stream_traffic_weather"] = ORACLE["tomtom_weather"]

ORACLE["random_event_id"] = """
SELECT event_id AS src_id, CAST(length('lviv_gtfs_rt') + 33 AS INTEGER) AS id_length,
       true AS well_formed
FROM events"""

ORACLE["center_labels"] = f"""{ML_CTES},
{PROBE.strip()},
{PREP.strip()},
kptset AS (
  SELECT l.*, h.temp_c, h.precip_mm, h.wind_mps, h.humidity_pct
  FROM labelled l JOIN hourly h ON l.event_hour = h.event_hour)
SELECT 'tomtom' AS dataset, CAST(src_id % 4 AS INTEGER) AS cluster_id, {R("avg(lat)")} AS lat,
       {R("avg(lon)")} AS lon, {R("avg(current_travel_time_s)")} AS intensity_mean, count(*) AS size
FROM ml WHERE is_congested = 1 AND current_travel_time_s IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'kpt', CAST(hour_of_day % 4 AS INTEGER), {R("avg(lat)")}, {R("avg(lon)")},
       {R("avg(CAST(events_count AS DOUBLE))")}, count(*)
FROM kptset WHERE is_congested = 1 GROUP BY 2"""


ORACLE["bronze_quarantine"] = f"""{with_ctes(BASE)}
SELECT CAST(NULL AS VARCHAR) AS event_id, '{{"broken": ' || CAST(src_id AS VARCHAR) AS _corrupt_record
FROM base WHERE k = 7"""


# ---- ML on the probe dataset ----------------------------------------------------

KPT_ML = f"""{with_ctes(BASE, WRAW, FLAT, SILVER, NORM_A, NORM_B, NORM_C, HOURLY, PROBE, PREP)},
kptml AS (
  SELECT l.*, h.temp_c, h.precip_mm, h.wind_mps, h.humidity_pct,
         CAST(epoch(l.event_hour) AS BIGINT) * 100000000
           + CAST(round(l.lat * 100) AS BIGINT) * 10000
           + CAST(round(l.lon * 100) AS BIGINT) AS cell_key
  FROM labelled l JOIN hourly h ON l.event_hour = h.event_hour),
kpt AS (
  SELECT *, substr(sha1(CAST(cell_key AS VARCHAR)), 1, 4) < '3333' AS is_test
  FROM kptml
  WHERE heading_sin IS NOT NULL AND heading_cos IS NOT NULL AND temp_c IS NOT NULL
    AND wind_mps IS NOT NULL AND humidity_pct IS NOT NULL)"""

ORACLE["kpt_run_summary"] = f"""{KPT_ML}
SELECT count(*) AS rows_total, count(CASE WHEN NOT is_test THEN 1 END) AS rows_train,
       count(CASE WHEN is_test THEN 1 END) AS rows_test,
       {R("avg(CASE WHEN NOT is_test THEN CAST(is_congested AS DOUBLE) END)")} AS positive_rate_train,
       CAST(12 + count(DISTINCT coalesce(direction_bucket, 'None')) AS INTEGER) AS feature_count
FROM kpt"""

ORACLE["kpt_class_weights"] = f"""{KPT_ML}
SELECT is_congested, count(*) AS rows,
       {R("CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*))")} AS weight
FROM kpt WHERE NOT is_test GROUP BY is_congested"""


ORACLE["stream_late_data"] = f"""{SILVER_CTES},
wm AS (SELECT max(event_ts) - INTERVAL 1 HOUR AS wm FROM valid WHERE ingest_ts >= '2024-01-15')
SELECT {SILVER_COLS} FROM silver, wm
WHERE ingest_ts >= '2024-01-15' AND event_ts < wm.wm"""


# ---- Bronze from response bodies --------------------------------------------------

_SLOT = "strftime(ts, '%Y-%m-%d') AS ingest_date, strftime(ts, '%H') AS hour"
_STAMPED = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ingest_ts"

ORACLE["collect_weather"] = f"""
SELECT {_STAMPED}, 'open_meteo_current' AS source, 'fixture' AS author, {_SLOT},
       x.* EXCLUDE (src_id, pos)
FROM ({ORACLE["response_expand"]}) x JOIN events e ON e.event_id = x.src_id"""

ORACLE["collect_traffic"] = f"""
SELECT {_STAMPED}, {_SLOT}, x.* EXCLUDE (page_id), url AS endpoint
FROM ({ORACLE["raw_capture"]}) x JOIN (
  SELECT page_id, url, make_timestamp((1704412800 + page_id) * 1000000) AS ts FROM pages) p USING (page_id)"""

# A static domain's first capture of each hour, by time, then name.
_FIRST_OF_HOUR = """
firsts AS (
  SELECT event_id AS src_id, ts, 'poll-' || CAST(event_id AS VARCHAR) AS endpoint FROM events
  QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY date_trunc('second', ts), endpoint) = 1)"""

ORACLE["collect_alerts"] = f"""WITH {_FIRST_OF_HOUR}
SELECT {_STAMPED}, {_SLOT}, x.event_id, f.endpoint AS source_url, x.n_cells,
       split_part(x.natural_key, '|', 1) AS region, x.oblast, x.notes
FROM ({ORACLE["alerts_expand"]}) x JOIN firsts f USING (src_id)"""

ORACLE["collect_roads"] = f"""WITH {_FIRST_OF_HOUR}
SELECT {_STAMPED}, {_SLOT}, x.event_id, x.way_id, x.highway_class, x.name, x.name_en, x.maxspeed, x.lanes,
       x.center_lat, x.center_lon
FROM ({ORACLE["roads_expand"]}) x JOIN firsts f USING (src_id)"""


# ---- incremental Silver -----------------------------------------------------------

ORACLE["silver_incremental"] = f"""{FLAT_CTES},
valid AS (SELECT * FROM flat WHERE {NONNULL} AND {INRANGE} AND {TIMELY})
SELECT {SILVER_COLS} FROM valid
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_ts, event_ts, city, latitude, longitude, elevation_m,
  temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m, wind_direction_10m, surface_pressure) = 1"""


# ---- streams to the end of their input, exact split -------------------------------

ORACLE["stream_silver_closed"] = ORACLE["silver_weather"]

ORACLE["stream_daily_closed"] = f"""{SILVER_CTES},
hourly AS (
  SELECT strftime(event_ts, '%Y-%m-%d') AS window_date, city, date_trunc('hour', event_ts) AS h,
         sum(precipitation) AS hp, min(temperature_2m) AS hm
  FROM silver GROUP BY 1, 2, 3)
SELECT window_date, city, {R("sum(hp)")} AS total_precip_mm, count(*) AS hours_observed,
       CAST(sum(CASE WHEN hp >= 1e-1 THEN 1 ELSE 0 END) AS BIGINT) AS rainy_hours,
       {R("min(hm)")} AS coldest_hour_temp_c, {R("avg(hm)")} AS avg_hourly_min_temp_c,
       count(CASE WHEN hm < 0e0 THEN 1 END) AS subzero_hours
FROM hourly WHERE city IS NOT NULL
GROUP BY 1, 2"""

ORACLE["stratified_split"] = f"""{ML_CTES}
SELECT src_id, is_congested,
       row_number() OVER (PARTITION BY is_congested ORDER BY substr(sha1(CAST(src_id AS VARCHAR)), 1, 15))
         <= floor(2e-1 * count(*) OVER (PARTITION BY is_congested) + 5e-1) AS is_test
FROM ml"""


# ---- layers written and read back -------------------------------------------------

_LINEAGE = "'fixture' AS author, CAST(1 AS INTEGER) AS schema_v, 'run000000001' AS run_id"


def _gold_check(name: str, value: str, hourly: bool) -> str:
    count = "count(DISTINCT hour(event_ts))" if hourly else "CAST(1 AS BIGINT)"
    return (f"SELECT '{name}' AS metric_name, {_LINEAGE}, strftime(event_ts, '%Y-%m-%d') AS window_date, city, "
            f"{count} AS n_rows, {R(value)} AS value FROM first_polls WHERE city IS NOT NULL GROUP BY ALL")


ORACLE["gold_job"] = f"""WITH first_polls AS ({ORACLE["silver_incremental"]})
""" + "\nUNION ALL\n".join([
    _gold_check("temperature_hourly", "max(temperature_2m)", True),
    _gold_check("precipitation_daily", "sum(precipitation)", False),
    _gold_check("wind_daily_extremes", "max(wind_speed_10m)", False),
    _gold_check("subzero_hours_daily", "min(temperature_2m)", False),
])

ORACLE["dataset_files"] = f"""SELECT *, 'fixture' AS author FROM ({ORACLE["tomtom_weather"]})"""

ORACLE["prediction_files"] = f"""{SCORED_CTES}
SELECT src_id, event_hour, is_congested_actual, is_congested_pred, {R("congestion_proba")} AS congestion_proba FROM scored"""

ORACLE["center_files"] = f"""SELECT 'tomtom' AS dataset, * FROM ({ORACLE["cluster_centers_fixed"]})"""

ORACLE["metric_sections"] = f"""{SCORED_CTES}
SELECT 'classification' AS section, 'tomtom' AS dataset, 'rule' AS model, 'rows' AS metric, {R("CAST(count(*) AS DOUBLE)")} AS value FROM scored
UNION ALL
SELECT 'classification', 'tomtom', 'rule', 'positives', {R("CAST(sum(is_congested_actual) AS DOUBLE)")} FROM scored
UNION ALL
SELECT 'regression', 'tomtom', 'new', 'proba_mean', {R("avg(congestion_proba)")} FROM scored"""

ORACLE["silver_repartition"] = f"""{SILVER_CTES}
SELECT CAST(8 AS BIGINT) AS partitions, count(*) AS n_rows, true AS even FROM silver"""

ORACLE["lenient_coercion"] = f"""{with_ctes(BASE)}
SELECT src_id, CASE WHEN src_id % 7 > 1 THEN date_trunc('second', ts) END AS event_ts,
       CASE WHEN k % 5 > 1 THEN k + 25e-2 END AS current_speed_kmh,
       CASE WHEN k % 3 > 0 THEN k + 25e-2 END AS free_flow_speed_kmh,
       CASE WHEN k % 4 > 0 THEN -(k + 25e-2) END AS current_travel_time_s,
       CASE WHEN k % 6 > 0 THEN 1e2 END AS confidence
FROM base"""

ORACLE["weather_union_missing"] = f"""{WEATHER_CTES}
SELECT {WEATHER_OUT} FROM (
  SELECT * FROM norm_a UNION ALL SELECT * FROM norm_b
  UNION ALL SELECT * REPLACE (CAST(NULL AS DOUBLE) AS humidity_pct) FROM norm_c)"""
