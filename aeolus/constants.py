"""Fixed values.

Everything below must equal the source pipeline's values for results to match:
thresholds, bounding box, city list, metric names, key columns and formats.
They are plain data; every operator takes them as overridable parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must match the source pipeline) -------------------------

SCHEMA_VERSION = 1

# Silver timestamp sanity: strictly after this instant, not after "now".
EPOCH_LOWER_BOUND = "1971-01-01 00:00:00"

# Observation time format written by the weather collector.
OBSERVED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm"

# Bronze envelope ingest time format (ISO-8601 UTC, seconds, Z suffix).
INGEST_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Bronze hour-partition keys and file stamp.
INGEST_DATE_FORMAT = "yyyy-MM-dd"
INGEST_HOUR_FORMAT = "HH"
PART_STAMP_FORMAT = "yyyyMMdd'T'HHmmss'Z'"

# Gold window keys (kept as strings).
WINDOW_DATE_FORMAT = "yyyy-MM-dd"
WINDOW_HOUR_FORMAT = "HH"

# Gold thresholds.
RAIN_THRESHOLD_MM = 0.1
SUBZERO_C = 0.0

# Apparent-temperature (comfort index) coefficients:
# AT = T + 0.33 * (RH / 100) * 6.105 - 0.7 * wind - 4.0
COMFORT_RH_WEIGHT = 0.33
COMFORT_VAPOUR_FACTOR = 6.105
COMFORT_WIND_WEIGHT = 0.7
COMFORT_OFFSET = 4.0

# Weather cities in request order: (city, latitude, longitude).
WEATHER_CITIES = (
    ("Kyiv", 50.4501, 30.5234),
    ("Lviv", 49.8397, 24.0297),
    ("Kharkiv", 49.9935, 36.2304),
    ("Odesa", 46.4825, 30.7233),
    ("Dnipro", 48.4647, 35.0462),
)

# Current-weather metric keys, in request order.
CURRENT_METRICS = (
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "wind_speed_10m",
    "wind_direction_10m",
    "surface_pressure",
)

# Silver weather fields that must be non-null.
WEATHER_REQUIRED_FIELDS = (
    "event_id",
    "author",
    "city",
    "event_ts",
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "wind_speed_10m",
)

# Source names.
WEATHER_SOURCE = "open_meteo_current"
WEATHER_API_SOURCE = "open_meteo_api"
OWM_SOURCE = "openweathermap_api"
TRAFFIC_CAPTURE_SOURCE = "lviv_gtfs_rt"
ALERTS_SOURCE = "vadimkin_air_raid"
ROADS_SOURCE = "overpass_kyiv_highways"
PROBE_SOURCE = "kpt_socketio"

# Alerts natural-key columns, joined with "|".
ALERT_KEY_COLUMNS = ("region", "start", "end", "start_time", "end_time", "oblast")

# Road tag picks: (output column, tag key).
ROAD_TAG_PICKS = (
    ("highway_class", "highway"),
    ("name", "name"),
    ("name_en", "name:en"),
    ("ref", "ref"),
    ("maxspeed", "maxspeed"),
    ("lanes", "lanes"),
    ("surface", "surface"),
    ("oneway", "oneway"),
)

# Domains captured at most once per clock hour.
STATIC_DOMAINS = ("alerts", "roads")

# Feature-dataset constants.
CELL_DIGITS = 2
MIN_CELL_EVENTS = 3
SPEED_CAP_KMH = 150.0
KPT_CONGESTION_KMH = 20.0
TOMTOM_CONGESTION_RATIO = 0.7
KMH_PER_MS = 3.6
DEFAULT_TIME_FROM = "2026-02-01"
DEFAULT_TIME_TO = "2026-04-01"

# Valid ranges of weather measures, both ends included; None: open.
WEATHER_RANGES = (
    ("latitude", -90.0, 90.0),
    ("longitude", -180.0, 180.0),
    ("temperature_2m", -90.0, 100.0),
    ("relative_humidity_2m", 0.0, 100.0),
    ("precipitation", 0.0, None),
    ("wind_speed_10m", 0.0, None),
)

# Numeric features of the two datasets, in column order.
PROBE_FEATURES = (
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "lat",
    "lon",
    "events_count",
    "heading_sin",
    "heading_cos",
    "temp_c",
    "precip_mm",
    "wind_mps",
    "humidity_pct",
)
ROAD_FEATURES = (
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "lat",
    "lon",
    "free_flow_speed_kmh",
    "current_travel_time_s",
    "confidence",
    "temp_c",
    "precip_mm",
    "wind_mps",
    "humidity_pct",
)

# Model constants.
SEED = 42
TEST_SHARE = 0.2
K_CANDIDATES = tuple(range(2, 11))
KMEANS_RESTARTS_SEARCH = 10
KMEANS_RESTARTS_FINAL = 20
RIDGE_ALPHA = 1.0
LASSO_ALPHA = 0.1
LOGREG_C = 1.0
PROBA_CUT = 0.5

# Continuous-ingest poll interval.
POLL_INTERVAL_SECONDS = 600

# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class BBox:
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


KYIV_BOX = BBox(50.2, 50.6, 30.2, 30.9)
