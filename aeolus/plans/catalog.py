"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver tables at ``sf_dir`` (whole tables), derives the
pipeline inputs with ``sources.fixtures`` and runs the library operators.
Output columns are aliased to match ``plans.oracle``; floating-point outputs
go through ``_r`` (a tiny offset, then 6 decimals) so last-bit noise from
different summation orders cannot flip a rounding tie. The offset lives only
here and in the oracle, never in library functions.
"""

from __future__ import annotations

from typing import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .. import session as S
from ..operators import gold, silver
from ..sources import fixtures as fx
from ..sources import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROUND_OFFSET = 3.14159e-8
ROUND_DIGITS = 6


def _r(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col + F.lit(ROUND_OFFSET), ROUND_DIGITS)


def _ntz(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp_ntz")


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            S.configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.read_table(spark, sf_dir, "events")


def silver_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver weather over the Bronze fixture; duplicates resolved by src_id."""
    bronze = landing.bronze_weather(spark, sf_dir)
    return silver.silver_weather(bronze, producer=fx.FIXTURE_AUTHOR,
                                 order_by=("src_id",), carry=("src_id",))


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, landed once a session as the Silver layer is: Bronze is parsed
    and deduplicated by one job, and whatever comes after reads its Parquet."""
    path = landing.land(spark, sf_dir, "silver_weather", "parquet",
                        lambda _events: silver_fixture(spark, sf_dir))
    return spark.read.parquet(path)


SILVER_OUT = ("event_id", "author", "source", "schema_v", "ingest_ts", "event_ts", "city",
              "latitude", "longitude", "elevation_m", "temperature_2m",
              "relative_humidity_2m", "precipitation", "wind_speed_10m",
              "wind_direction_10m", "surface_pressure")


def _silver_out(df: DataFrame) -> DataFrame:
    return df.select(*[_ntz(c).alias(c) if c == "event_ts" else F.col(c) for c in SILVER_OUT])


# ---- Silver -------------------------------------------------------------------

@register("silver_weather")
def q_silver_weather(spark, sf_dir):
    """V9: composed Silver job."""
    return _silver_out(silver_fixture(spark, sf_dir))


# ---- Gold ---------------------------------------------------------------------

@register("temperature_hourly")
def q_temperature_hourly(spark, sf_dir):
    """G1."""
    g = gold.temperature_hourly(silver_table(spark, sf_dir))
    return g.select("window_date", "window_hour", "city", "samples_cnt",
                    *[_r(c).alias(c) for c in ("temperature_avg_c", "temperature_min_c",
                                               "temperature_max_c", "temperature_stddev_c")])


def _flat_fixture(spark, sf_dir) -> DataFrame:
    return silver.flatten_weather(landing.bronze_weather(spark, sf_dir), carry=("src_id",))


@register("silver_flatten")
def q_silver_flatten(spark, sf_dir):
    """V2 over every Bronze row (bad timestamps become null, not errors)."""
    return _silver_out(_flat_fixture(spark, sf_dir))


@register("silver_null_reject")
def q_silver_null_reject(spark, sf_dir):
    """V2 -> V3."""
    return _silver_out(silver.reject_nulls(_flat_fixture(spark, sf_dir)))


@register("silver_range_filter")
def q_silver_range_filter(spark, sf_dir):
    """V2 -> V3 -> V4."""
    df = silver.reject_nulls(_flat_fixture(spark, sf_dir))
    return _silver_out(silver.domain_filter(df, fx.FIXTURE_AUTHOR))


@register("silver_time_filter")
def q_silver_time_filter(spark, sf_dir):
    """V2 -> V5 alone (so null, old and future timestamps are all exercised)."""
    return _silver_out(silver.time_filter(_flat_fixture(spark, sf_dir)))


@register("silver_dedup")
def q_silver_dedup(spark, sf_dir):
    """V6 alone over all flattened rows: first src_id per event_id."""
    df = silver.dedup_events(_flat_fixture(spark, sf_dir), order_by=("src_id",))
    return df.select("event_id", "src_id", _ntz("event_ts").alias("event_ts"), "city")


@register("silver_reject_report")
def q_silver_reject_report(spark, sf_dir):
    """V7: rows per first failing rule; sums to the Bronze row count."""
    return silver.reject_report(_flat_fixture(spark, sf_dir), producer=fx.FIXTURE_AUTHOR)


@register("silver_stamp_producer")
def q_silver_stamp_producer(spark, sf_dir):
    """V1 then V9 with the source pipeline's overwrite semantics."""
    # Envelopes recorded by another producer: without restamping none survive.
    bronze = landing.bronze_weather(spark, sf_dir).withColumn("author", F.lit("someone-else"))
    df = silver.silver_weather(bronze, producer=fx.FIXTURE_AUTHOR, restamp=True,
                               order_by=("src_id",), carry=("src_id",))
    return df.groupBy("author").agg(F.count(F.lit(1)).alias("rows"))


@register("precipitation_daily")
def q_precipitation_daily(spark, sf_dir):
    """G2."""
    g = gold.precipitation_daily(silver_table(spark, sf_dir))
    return g.select("window_date", "city", _r("total_precip_mm").alias("total_precip_mm"),
                    "hours_observed", "rainy_hours")


@register("wind_daily_extremes")
def q_wind_daily_extremes(spark, sf_dir):
    """G3."""
    g = gold.wind_daily_extremes(silver_table(spark, sf_dir))
    return g.select("window_date", "city",
                    *[_r(c).alias(c) for c in ("wind_speed_max_ms", "wind_speed_avg_ms",
                                               "prevailing_wind_deg", "mean_wind_vector_ms")])


@register("subzero_hours_daily")
def q_subzero_hours_daily(spark, sf_dir):
    """G4."""
    g = gold.subzero_hours_daily(silver_table(spark, sf_dir))
    return g.select("window_date", "city", "hours_observed",
                    _r("coldest_hour_temp_c").alias("coldest_hour_temp_c"),
                    _r("avg_hourly_min_temp_c").alias("avg_hourly_min_temp_c"),
                    "subzero_hours")


@register("comfort_index_hourly")
def q_comfort_index_hourly(spark, sf_dir):
    """G5."""
    g = gold.comfort_index_hourly(silver_table(spark, sf_dir))
    return g.select("window_date", "window_hour", "city", "samples_cnt",
                    *[_r(c).alias(c) for c in ("comfort_index_c", "temperature_avg_c",
                                               "humidity_avg_pct", "wind_speed_avg_ms")])


@register("metric_lineage")
def q_metric_lineage(spark, sf_dir):
    """Lineage columns stamped on a Gold metric."""
    g = gold.temperature_hourly(silver_table(spark, sf_dir))
    g = gold.finalize_metric(g, fx.FIXTURE_AUTHOR, "run000000001", "temperature_hourly")
    return g.select("window_date", "window_hour", "city", "samples_cnt",
                    "author", "schema_v", "run_id", "metric_name")


@register("silver_latest_run")
def q_silver_latest_run(spark, sf_dir):
    """Two Silver runs (a partial one, then a full rerun) read together;
    one row per event_id survives, from the latest run."""
    from ..operators.silver import latest_per_key
    bronze = landing.bronze_weather(spark, sf_dir)
    first = silver.silver_weather(bronze.filter(F.col("ingest_ts") < "2024-01-16"),
                                  producer=fx.FIXTURE_AUTHOR, order_by=("src_id",),
                                  carry=("src_id",))
    rerun = silver.silver_weather(bronze, producer=fx.FIXTURE_AUTHOR, order_by=("src_id",),
                                  carry=("src_id",))
    runs = (first.withColumns({"run_id": F.lit("run-a"), "run_seq": F.lit(1)})
            .unionByName(rerun.withColumns({"run_id": F.lit("run-b"), "run_seq": F.lit(2)})))
    latest = latest_per_key(runs, key="event_id", order_desc=("run_seq",))
    return latest.select("event_id", "run_id", "city", _ntz("event_ts").alias("event_ts"),
                         "temperature_2m")


# ---- Features -------------------------------------------------------------------

from ..operators import features as fe  # noqa: E402


def _probes(spark, sf_dir):
    return landing.read_layer(spark, sf_dir, "probe_traffic")


def _roads(spark, sf_dir):
    return landing.read_layer(spark, sf_dir, "road_traffic")


def weather_frames(spark, sf_dir) -> list[DataFrame]:
    """The three weather feeds through the skip-on-failure registry."""
    from ..sources.silver import load_sources
    loaded = load_sources({
        "open_meteo_current": lambda: fe.normalize_current(silver_table(spark, sf_dir)),
        "open_meteo_api": lambda: fe.normalize_api(landing.read_layer(spark, sf_dir, "weather_api")),
        "openweathermap_api": lambda: fe.normalize_owm(landing.read_layer(spark, sf_dir, "owm")),
    })
    return list(loaded.values())


def hourly_fixture(spark, sf_dir) -> DataFrame:
    return fe.hourly_weather(fe.union_weather(weather_frames(spark, sf_dir)),
                             time_from=fx.FIXTURE_TIME_FROM, time_to=fx.FIXTURE_TIME_TO)


def hourly_table(spark, sf_dir) -> DataFrame:
    """The hourly weather as a written version of its table: a bounded scan that
    datasets and streams join with."""
    import os
    from ..sinks import write_hourly
    from ..sources.silver import read_hourly
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _HOURLY:
        import uuid
        root = S.scratch_path(spark, "hourly", uuid.uuid4().hex[:12])
        write_hourly(hourly_fixture(spark, sf_dir), root, "v1")
        _HOURLY[key] = root
    return read_hourly(spark, _HOURLY[key])


_HOURLY: dict[tuple[str, str], str] = {}


def datasets(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """D25 over the fixture: probe cells and road readings with hourly weather."""
    from .jobs import build_datasets
    return build_datasets(_probes(spark, sf_dir), _roads(spark, sf_dir), [], fx.FIXTURE_TIME_FROM,
                          fx.FIXTURE_TIME_TO, hourly=hourly_table(spark, sf_dir), snap_digits=HEADING_DIGITS)


# Mean headings come out of atan2, whose last bit differs between math
# libraries (Java's and glibc's disagree at -135 degrees); queries and SQL
# both bucket the angle rounded to this many decimals.
HEADING_DIGITS = 9

FIXTURE_RANGE = {"time_from": fx.FIXTURE_TIME_FROM, "time_to": fx.FIXTURE_TIME_TO}


def labelled_cells(spark, sf_dir, **time_range) -> DataFrame:
    return fe.probe_cells(_probes(spark, sf_dir), snap_digits=HEADING_DIGITS, **time_range)


def road_dataset(spark, sf_dir, **options) -> DataFrame:
    return fe.road_readings(_roads(spark, sf_dir), **options)


def _round_doubles(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Apply the output rule to every double column (except ``keep``) and
    cast instants to timestamp_ntz."""
    out = []
    for f in df.schema.fields:
        name = f.name
        t = f.dataType.typeName()
        if t == "double" and name not in keep:
            out.append(_r(name).alias(name))
        elif t == "timestamp":
            out.append(_ntz(name).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


@register("bbox_filter")
def q_bbox_filter(spark, sf_dir):
    """D1."""
    return fe.in_box(_probes(spark, sf_dir)).select("src_id", "lat", "lon")


@register("time_range")
def q_time_range(spark, sf_dir):
    """D2."""
    df = fe.in_time_range(_probes(spark, sf_dir), "event_ts", fx.FIXTURE_TIME_FROM,
                          fx.FIXTURE_TIME_TO)
    return df.select("src_id", _ntz("event_ts").alias("event_ts"))


@register("speed_sanity")
def q_speed_sanity(spark, sf_dir):
    """D3."""
    return fe.sane_speed(_probes(spark, sf_dir)).select("src_id", "speed")


@register("calendar_sunday")
def q_calendar_sunday(spark, sf_dir):
    """D4, Sunday = 0."""
    df = fe.with_calendar(_probes(spark, sf_dir), "event_ts", "sunday")
    return df.select("src_id", "hour_of_day", "day_of_week", "is_weekend")


@register("calendar_monday")
def q_calendar_monday(spark, sf_dir):
    """D4, Monday = 0."""
    df = fe.with_calendar(_roads(spark, sf_dir), "event_ts", "monday")
    return df.select("src_id", "hour_of_day", "day_of_week", "is_weekend")


@register("grid_cell")
def q_grid_cell(spark, sf_dir):
    """D5 + D6."""
    df = fe.with_event_hour(fe.with_grid_cell(fe.in_box(_probes(spark, sf_dir))))
    return df.select("src_id", "lat_cell", "lon_cell", _ntz("event_hour").alias("event_hour"))


@register("kpt_cell_hour")
def q_kpt_cell_hour(spark, sf_dir):
    """Every cell-hour, before the minimum-support filter."""
    return _round_doubles(fe.cell_hour_stats(fe.prepare_probes(_probes(spark, sf_dir))),
                          keep=("lat_cell", "lon_cell"))


@register("kpt_circular")
def q_kpt_circular(spark, sf_dir):
    """D8 + D9."""
    cells = fe.with_heading(fe.cell_hour_stats(fe.prepare_probes(_probes(spark, sf_dir))),
                            HEADING_DIGITS)
    return _round_doubles(cells.select("event_hour", "lat_cell", "lon_cell",
                                       "heading_deg_mean", "direction_bucket"),
                          keep=("lat_cell", "lon_cell"))


@register("kpt_labelled")
def q_kpt_labelled(spark, sf_dir):
    """D7-D12 + D4: the probe dataset before the weather join."""
    return _round_doubles(labelled_cells(spark, sf_dir), keep=("lat", "lon"))


@register("tomtom_clean")
def q_tomtom_clean(spark, sf_dir):
    """D13-D15."""
    df = fe.road_filter(fe.coerce_road(_roads(spark, sf_dir)))
    return df.select("src_id", _ntz("event_ts").alias("event_ts"), "road_id",
                     *fe.ROAD_NUMERIC)


@register("tomtom_ratio")
def q_tomtom_ratio(spark, sf_dir):
    """The 14-column road dataset before the weather join."""
    return _round_doubles(road_dataset(spark, sf_dir), keep=("lat", "lon"))


@register("weather_norm_a")
def q_weather_norm_a(spark, sf_dir):
    """D18."""
    return _round_doubles(weather_frames(spark, sf_dir)[0], keep=("lat", "lon"))


@register("weather_norm_b")
def q_weather_norm_b(spark, sf_dir):
    """D19."""
    return _round_doubles(weather_frames(spark, sf_dir)[1], keep=("lat", "lon"))


@register("weather_norm_c")
def q_weather_norm_c(spark, sf_dir):
    """D20."""
    return _round_doubles(weather_frames(spark, sf_dir)[2], keep=("lat", "lon"))


@register("weather_union")
def q_weather_union(spark, sf_dir):
    """D21."""
    return _round_doubles(fe.union_weather(weather_frames(spark, sf_dir)), keep=("lat", "lon"))


@register("weather_hourly")
def q_weather_hourly(spark, sf_dir):
    """D22."""
    return _round_doubles(hourly_fixture(spark, sf_dir))


@register("kpt_weather")
def q_kpt_weather(spark, sf_dir):
    """Probe dataset (D25) = labelled cells x hourly weather."""
    return _round_doubles(datasets(spark, sf_dir)[0], keep=("lat", "lon"))


@register("tomtom_weather")
def q_tomtom_weather(spark, sf_dir):
    """Road dataset (D25) = road readings x hourly weather."""
    return _round_doubles(datasets(spark, sf_dir)[1], keep=("lat", "lon"))


# ---- Bronze ---------------------------------------------------------------------

from ..operators import bronze as br  # noqa: E402
from ..constants import CURRENT_METRICS, TRAFFIC_CAPTURE_SOURCE  # noqa: E402

_PAYLOAD_OUT = ("city", "latitude", "longitude", "elevation_m", "observed_at")


def _flat_payload(df: DataFrame, *lead: str) -> DataFrame:
    return df.select(*lead, *[F.col(f"payload.{c}").alias(c) for c in _PAYLOAD_OUT],
                     *[F.col(f"payload.metrics.{m}").alias(m) for m in CURRENT_METRICS])


@register("envelope")
def q_envelope(spark, sf_dir):
    """B1: Bronze weather envelopes (payload flattened for comparison)."""
    env = landing.bronze_weather(spark, sf_dir)
    return _flat_payload(env, "src_id", "ingest_ts", "source", "schema_v", "author", "event_id")


@register("stable_event_id")
def q_stable_event_id(spark, sf_dir):
    """B2: deterministic ids; equal natural keys collide on purpose."""
    raw = fx.weather_raw(_events(spark, sf_dir))
    key = F.concat(F.trim("city_raw"), F.lit("|"), F.col("observed_at"))
    from ..functions import stable_event_id
    return raw.select("src_id", stable_event_id("open_meteo_current", key).alias("event_id"))


@register("response_expand")
def q_response_expand(spark, sf_dir):
    """JSON forecast responses -> one payload per configured city."""
    polls = landing.read_layer(spark, sf_dir, "weather_polls").withColumn(
        "response", br.parse_weather_response(F.col("body")))
    out = br.expand_weather(polls, keep=("src_id",))
    return _flat_payload(out, "src_id", "pos", "event_id")


@register("raw_capture")
def q_raw_capture(spark, sf_dir):
    """B5 column functions over raw page bytes."""
    pages = fx.read_table(spark, sf_dir, "pages")
    cols = br.capture_columns(F.col("html"), TRAFFIC_CAPTURE_SOURCE)
    return pages.select("page_id", *[cols[k].alias(k) for k in (
        "content_length", "content_sha256", "payload_b64", "event_id")])


@register("alerts_expand")
def q_alerts_expand(spark, sf_dir):
    """Naive CSV lines -> column map + six-column natural key."""
    lines = fx.alert_lines(_events(spark, sf_dir))
    out = br.expand_alert_lines(lines, fx.ALERT_HEADER, keep=("src_id",))
    return out.select("src_id", "event_id", "natural_key",
                      F.size("row").alias("n_cells"),
                      F.col("row")["oblast"].alias("oblast"),
                      F.col("row")["notes"].alias("notes"))


@register("roads_expand")
def q_roads_expand(spark, sf_dir):
    """Overpass elements -> one payload per way."""
    out = br.expand_road_elements(fx.road_responses(_events(spark, sf_dir)), keep=("src_id",))
    p = "payload"
    return out.select("src_id", "event_id",
                      *[F.col(f"{p}.{c}").alias(c) for c in (
                          "way_id", "highway_class", "name", "name_en", "ref", "maxspeed",
                          "lanes", "surface", "oneway", "center_lat", "center_lon")],
                      F.size(f"{p}.tags").alias("n_tags"))


@register("partition_keys")
def q_partition_keys(spark, sf_dir):
    """B8."""
    env = landing.bronze_weather(spark, sf_dir)
    return br.with_partition_keys(env).select("src_id", "ingest_date", "hour", "part_stamp")


@register("hourly_snapshot")
def q_hourly_snapshot(spark, sf_dir):
    """First capture per static domain and clock hour."""
    out = br.first_capture_per_hour(fx.static_captures(_events(spark, sf_dir)))
    return out.select("domain", _ntz("hour_start").alias("hour_start"),
                      _ntz("ingest_ts").alias("ingest_ts"), "file")


# ---- ML -------------------------------------------------------------------------

from ..operators.ml import classification as mc  # noqa: E402
from ..operators.ml import clustering as mk  # noqa: E402
from ..operators.ml import maps as mm  # noqa: E402
from ..operators.ml import prep as mp  # noqa: E402
from ..operators.ml import regression as mr  # noqa: E402

ML_KEY = "src_id"


def ml_dataset(spark, sf_dir) -> DataFrame:
    """Road dataset joined with hourly weather, row key carried."""
    roads = road_dataset(spark, sf_dir, keep=(ML_KEY,), **FIXTURE_RANGE)
    return fe.join_weather(roads, hourly_fixture(spark, sf_dir),
                           fx.FIXTURE_TIME_FROM, fx.FIXTURE_TIME_TO)


def scored_fixture(spark, sf_dir) -> DataFrame:
    return fx.scored_predictions(_roads(spark, sf_dir))


def _prepared(spark, sf_dir, persist: bool = True) -> mp.Prepared:
    return mp.prepare(ml_dataset(spark, sf_dir), mp.ROAD_SPEC, ML_KEY, persist=persist)


def _one_row(spark, values: dict) -> DataFrame:
    return spark.createDataFrame([tuple(values.values())], list(values.keys()))


@register("onehot_levels")
def q_onehot_levels(spark, sf_dir):
    """M2: categorical levels, ascending index, with row counts."""
    return mp.level_counts(mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC), "road_id")


@register("hash_split")
def q_hash_split(spark, sf_dir):
    """M3/M4: deterministic 80/20 split flag over every road reading."""
    return mp.hash_split(_roads(spark, sf_dir), ML_KEY).select(ML_KEY, "is_test")


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    """M4: a split that is exact in every class of the congestion label."""
    df = mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC)
    label = mp.ROAD_SPEC.classification_target
    return mp.exact_split(df, ML_KEY, label).select(ML_KEY, label, "is_test")


@register("scaler_stats")
def q_scaler_stats(spark, sf_dir):
    """M5 fit: train mean and population std per numeric feature."""
    df = mp.hash_split(mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC), ML_KEY)
    st = mp.stats_frame(df.filter(~F.col("is_test")), list(mp.ROAD_SPEC.numeric))
    return st.select("feature", _r("mean").alias("mean"), _r("std").alias("std"))


@register("standardised")
def q_standardised(spark, sf_dir):
    """M5 apply: numeric features scaled with the train statistics."""
    with _prepared(spark, sf_dir) as p:
        return _written(spark, p.data.select(
            ML_KEY, "is_test", *[_r(c).alias(c) for c in mp.ROAD_SPEC.numeric]), "standardised")


@register("baseline_mean")
def q_baseline_mean(spark, sf_dir):
    """M6 + M10: train-mean predictor scored on the test rows."""
    df = mp.hash_split(mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC), ML_KEY)
    y = mp.ROAD_SPEC.regression_target
    mean = mr.train_mean(df.filter(~F.col("is_test")), y)
    sc = mr.regression_scores(df.filter(F.col("is_test")), y, F.lit(mean))
    return sc.select(_r(F.lit(mean)).alias("train_mean"),
                     *[_r(c).alias(c) for c in ("mae", "rmse", "r2")], "rows")


@register("regression_scores")
def q_regression_scores(spark, sf_dir):
    """M10 on a fixed predictor (0.8 x free-flow speed) over the test rows."""
    df = mp.hash_split(mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC), ML_KEY)
    sc = mr.regression_scores(df.filter(F.col("is_test")), mp.ROAD_SPEC.regression_target,
                              F.col("free_flow_speed_kmh") * F.lit(0.8))
    return sc.select(*[_r(c).alias(c) for c in ("mae", "rmse", "r2")], "rows")


@register("class_weights")
def q_class_weights(spark, sf_dir):
    """Balanced weights on the train rows."""
    df = mp.hash_split(mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC), ML_KEY)
    w = mp.class_weights(df.filter(~F.col("is_test")), "is_congested")
    return w.select("is_congested", "rows", _r("weight").alias("weight"))


@register("classification_scores")
def q_classification_scores(spark, sf_dir):
    """M14 over the fixed-rule scores."""
    sc = mc.classification_scores(scored_fixture(spark, sf_dir))
    return sc.select(*[_r(c).alias(c) for c in sc.columns])


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    """M15."""
    return mc.confusion_matrix(scored_fixture(spark, sf_dir))


@register("roc_auc")
def q_roc_auc(spark, sf_dir):
    """Exact AUC of the fixed-rule scores."""
    auc = mc.roc_auc(scored_fixture(spark, sf_dir))
    return spark.createDataFrame([(auc,)], "auc double").select(_r("auc").alias("auc"))


@register("congested_points")
def q_congested_points(spark, sf_dir):
    """M19."""
    df = mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC)
    pts = df.filter(F.col("is_congested") == 1).select(
        ML_KEY, "lat", "lon", F.col("current_travel_time_s").alias("intensity")).dropna()
    return pts.select(ML_KEY, "lat", "lon", _r("intensity").alias("intensity"))


@register("cluster_centers_fixed")
def q_cluster_centers_fixed(spark, sf_dir):
    """M23 with fixed labels (src_id % 4): centers and sizes."""
    df = mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC)
    pts = (df.filter(F.col("is_congested") == 1)
             .select(ML_KEY, "lat", "lon", F.col("current_travel_time_s").alias("intensity"))
             .dropna().withColumn("cluster", F.col(ML_KEY) % 4))
    c = mk.centers_from_labels(pts)
    return c.select("cluster_id", *[_r(x).alias(x) for x in ("lat", "lon", "intensity_mean")], "size")


@register("heatmap_real")
def q_heatmap_real(spark, sf_dir):
    """Actual congestion as weighted cells."""
    return mm.heatmap_real(scored_fixture(spark, sf_dir))


@register("heatmap_predicted")
def q_heatmap_predicted(spark, sf_dir):
    """M26."""
    h = mm.heatmap_predicted(scored_fixture(spark, sf_dir))
    return h.select("lat", "lon", _r("congestion_proba").alias("congestion_proba"), "points")


@register("run_summary")
def q_run_summary(spark, sf_dir):
    """Rows, split sizes, feature count, train positive rate."""
    df = mp.hash_split(mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC), ML_KEY)
    n_levels = mp.count_levels(df, "road_id")
    return df.agg(F.count(F.lit(1)).alias("rows_total"),
                  F.count(F.when(~F.col("is_test"), 1)).alias("rows_train"),
                  F.count(F.when(F.col("is_test"), 1)).alias("rows_test"),
                  _r(F.avg(F.when(~F.col("is_test"), F.col("is_congested").cast("double"))))
                  .alias("positive_rate_train")) \
             .withColumn("feature_count", F.lit(len(mp.ROAD_SPEC.numeric) + n_levels))


def _written(spark, df: DataFrame, name: str) -> DataFrame:
    """Write a large result to the shared folder and return its scan, so
    persisted inputs can be released without recomputation later."""
    import uuid
    from ..session import scratch_path
    path = scratch_path(spark, "results", name, uuid.uuid4().hex[:12])
    df.hint("rebalance").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _materialise(spark, df: DataFrame) -> DataFrame:
    """Small results (metric rows, k <= 10 centers) computed now, so they
    outlive the persisted training data."""
    return spark.createDataFrame(df.collect(), df.schema)


def _model_query(model: str):
    def q(spark, sf_dir):
        with _prepared(spark, sf_dir) as p:
            sc = mr.model_scores(p, mp.ROAD_SPEC.regression_target, model)
            return _materialise(spark, sc.select(
                "model", *[_r(c).alias(c) for c in ("mae", "rmse", "r2")], "rows"))
    q.__doc__ = f"M7-M9: {model} fitted on train, scored on test (rows-only check)."
    return q


register("linreg")(_model_query("linear_regression"))
register("ridge")(_model_query("ridge"))
register("lasso")(_model_query("lasso"))


@register("logreg")
def q_logreg(spark, sf_dir):
    """Weighted logistic regression scored on test (rows-only)."""
    with _prepared(spark, sf_dir) as p:
        model = mc.fit_logistic(p, "is_congested")
        test = mc.score(model, p.data.filter(F.col("is_test"))).withColumnRenamed(
            "is_congested", "is_congested_actual")
        sc = mc.classification_scores(test)
        auc = mc.roc_auc(test)
        return _materialise(spark, sc.select(*[_r(c).alias(c) for c in sc.columns],
                                             _r(F.lit(auc)).alias("roc_auc")))


@register("predictions")
def q_predictions(spark, sf_dir):
    """Every row scored by the fitted model (rows-only)."""
    # The scored table is as large as the dataset: it is written to the
    # shared folder (K5), the training cache is released, and the query
    # returns a scan of the written table.
    with _prepared(spark, sf_dir) as p:
        model = mc.fit_logistic(p, "is_congested")
        out = _written(spark, mc.predictions_table(model, p, "is_congested", fx.FIXTURE_AUTHOR),
                       "predictions")
    return out.select(
        _ntz("event_hour").alias("event_hour"), "lat", "lon", "is_congested_actual",
        "is_congested_pred", _r("congestion_proba").alias("congestion_proba"), "author")


def _kmeans_run(spark, sf_dir) -> dict:
    df = mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC)
    return mk.cluster(mk.congested_points(df, mp.ROAD_SPEC))


@register("kmeans_select")
def q_kmeans_select(spark, sf_dir):
    """Silhouette and inertia per k (rows-only)."""
    res = _kmeans_run(spark, sf_dir)
    try:
        rows = [(e["k"], e["inertia"], e["silhouette"], bool(e["k"] == res.get("best_k")))
                for e in res.get("evaluations", [])]
    finally:
        if "data" in res:
            res["data"].unpersist()
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double, chosen boolean")


@register("kmeans_centers")
def q_kmeans_centers(spark, sf_dir):
    """Final centers in original units with sizes (rows-only)."""
    res = _kmeans_run(spark, sf_dir)
    if res.get("skipped"):
        return spark.createDataFrame([], "cluster_id int, lat double, lon double, "
                                         "intensity_mean double, size long")
    centers = mk.centers_from_labels(res["labelled"])
    try:
        # k <= 10 rows: collected so the result outlives the persisted points.
        return spark.createDataFrame(centers.collect(), centers.schema)
    finally:
        res["data"].unpersist()


# ---- facts of the fits: conditions that only the optimum meets -------------------
#
# Coefficients have no SQL, but what they must satisfy does: counts from the
# tables, and conditions that hold. Tolerances are relative to the target.

OPTIMUM_TOLERANCE = 1e-3


def _mean_products(df: DataFrame, error: str, weight: str | None = None) -> dict[str, float]:
    """Mean of error times each numeric feature, and of the error itself."""
    w = F.col(weight) if weight else F.lit(1.0)
    row = df.agg(F.avg(w * F.col(error)).alias("_self"),
                 *[F.avg(w * F.col(error) * F.col(c)).alias(c) for c in mp.ROAD_SPEC.numeric]).first()
    return {k: float(v or 0.0) for k, v in row.asDict().items()}


@register("regression_optimality")
def q_regression_optimality(spark, sf_dir):
    """M7-M9: the residuals of OLS, ridge and lasso on the train rows average to
    zero, and their products with each numeric feature balance the penalty."""
    from ..constants import LASSO_ALPHA, RIDGE_ALPHA

    y, rows = mp.ROAD_SPEC.regression_target, []
    with _prepared(spark, sf_dir) as p:
        train = p.data.filter(~F.col("is_test"))
        n, sd = train.agg(F.count(F.lit(1)), F.coalesce(F.stddev_pop(y), F.lit(0.0))).first()
        near = OPTIMUM_TOLERANCE * max(sd, 1e-9)
        for name in mr.MODELS:
            model = mr.fit(p, y, name)
            scored = model.transform(train).withColumn("_error", F.col(y) - F.col("prediction"))
            mean = _mean_products(scored, "_error")
            balanced = []
            for c, w in zip(mp.ROAD_SPEC.numeric, model.coefficients.toArray()):
                if name == "lasso" and w == 0:
                    balanced.append(abs(mean[c]) <= LASSO_ALPHA + near)
                    continue
                pull = {"ridge": RIDGE_ALPHA * w / max(n, 1),
                        "lasso": LASSO_ALPHA * (1 if w > 0 else -1)}.get(name, 0.0)
                balanced.append(abs(mean[c] - pull) <= near)
            rows.append((name, n, bool(abs(mean["_self"]) <= near), bool(all(balanced))))
    return spark.createDataFrame(
        rows, "model string, rows_train long, intercept_balanced boolean, gradient_balanced boolean")


@register("logistic_optimality")
def q_logistic_optimality(spark, sf_dir):
    """The weighted errors of the logistic regression balance its
    penalty, every row is scored, and the decision is the 0.5 cut."""
    from ..constants import LOGREG_C, PROBA_CUT

    label = "is_congested"
    with _prepared(spark, sf_dir) as p:
        model = mc.fit_logistic(p, label)
        data = mp.with_class_weights(p.data, label)
        scored = mc.score(model, data).withColumn("_error", F.col(label) - F.col("congestion_proba"))
        train = scored.filter(~F.col("is_test"))
        n = train.count()
        mean = _mean_products(train, "_error", "weight")
        balanced = all(
            abs(mean[c] - w / (LOGREG_C * max(n, 1))) <= OPTIMUM_TOLERANCE
            for c, w in zip(mp.ROAD_SPEC.numeric, model.coefficients.toArray()))
        facts = scored.agg(
            F.count(F.lit(1)).alias("rows_scored"),
            F.count(F.when(F.col("is_congested_pred") != (F.col("congestion_proba") >= PROBA_CUT).cast("int"), 1)),
            F.count(F.when(~F.col("congestion_proba").between(0, 1), 1))).first()
    row = (facts[0], n, bool(abs(mean["_self"]) <= OPTIMUM_TOLERANCE), bool(balanced),
           facts[1] == 0, facts[2] == 0)
    return spark.createDataFrame(
        [row], "rows_scored long, rows_train long, intercept_balanced boolean,"
               " gradient_balanced boolean, cut_consistent boolean, probabilities_in_range boolean")


@register("kmeans_facts")
def q_kmeans_facts(spark, sf_dir):
    """Sizes add up to the points, the centers are the means of their
    points, the inertia is the sum of their squared distances, and the chosen k
    has the highest silhouette. True where the guard skips the fit."""
    res = _kmeans_run(spark, sf_dir)
    if res.get("skipped"):
        row = (res["rows"], True, True, True, True)
    else:
        try:
            labelled = res["labelled"].withColumn("_x", vector_to_array("features"))
            dims = range(len(mk.POINT_COLS))
            groups = labelled.groupBy("cluster").agg(
                F.count(F.lit(1)).alias("n"), *[F.avg(F.col("_x")[i]).alias(f"m{i}") for i in dims],
                F.sum(sum(F.col("_x")[i] * F.col("_x")[i] for i in dims)).alias("squares")).collect()
            centers = res["model"].clusterCenters()
            means = all(abs(float(centers[g["cluster"]][i]) - g[f"m{i}"]) <= 1e-2 for g in groups for i in dims)
            inertia = sum(g["squares"] + sum(
                g["n"] * (float(centers[g["cluster"]][i]) ** 2 - 2 * float(centers[g["cluster"]][i]) * g[f"m{i}"])
                for i in dims) for g in groups)
            best = max(res["evaluations"], key=lambda e: e["silhouette"])["k"]
            total = sum(g["n"] for g in groups)
            row = (total, total == labelled.count(), means,
                   abs(inertia - res["inertia"]) <= 1e-6 * max(1.0, res["inertia"]), best == res["best_k"])
        finally:
            res["data"].unpersist()
    return spark.createDataFrame(
        [row], "points long, sizes_add_up boolean, centers_are_means boolean,"
               " inertia_recomputed boolean, best_silhouette boolean")


# ---- Streaming ------------------------------------------------------------------

from ..streaming import metrics as sm  # noqa: E402
from ..streaming import runner as sr  # noqa: E402
from ..streaming.silver import silver_stream  # noqa: E402
from ..streaming.traffic import road_weather_stream  # noqa: E402

STREAM_DELAY = "1 hour"


def _bronze_stream(spark, sf_dir) -> DataFrame:
    return (spark.readStream.schema(landing.BRONZE_WEATHER_SCHEMA)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(landing.bronze_weather_path(spark, sf_dir)))


def _silver_stream(spark, sf_dir, markers: DataFrame | None = None) -> DataFrame:
    return silver_stream(_bronze_stream(spark, sf_dir), producer=fx.FIXTURE_AUTHOR,
                         delay=STREAM_DELAY, order_by=("src_id",), carry=("src_id",), markers=markers)


def _closed_silver_stream(spark, sf_dir) -> DataFrame:
    """The same with the end of its input marked, so that no window stays open."""
    import uuid
    from ..streaming.silver import close_input, marker_stream
    folder = S.scratch_path(spark, "markers", uuid.uuid4().hex[:12])
    markers = marker_stream(spark, folder)
    close_input(spark, folder)
    return _silver_stream(spark, sf_dir, markers)


@register("stream_silver")
def q_stream_silver(spark, sf_dir):
    """Streaming Silver with ordered dedup: events the watermark has
    closed (event time <= newest event time - 1 hour)."""
    out, _ = sr.run_available_now(_silver_stream(spark, sf_dir), "stream_silver", spark)
    return _silver_out(out)


@register("stream_hourly")
def q_stream_hourly(spark, sf_dir):
    """Hourly windows emitted once the watermark (newest event - 1 hour)
    has passed their end."""
    out, _ = sr.run_available_now(sm.hourly_stream(_silver_stream(spark, sf_dir), delay=None),
                                  "stream_hourly", spark)
    return out.select("window_date", "window_hour", "city", "samples_cnt",
                      *[_r(c).alias(c) for c in ("temperature_avg_c", "temperature_min_c",
                                                 "temperature_max_c", "temperature_stddev_c",
                                                 "comfort_index_c", "humidity_avg_pct",
                                                 "wind_speed_avg_ms")])


@register("stream_daily")
def q_stream_daily(spark, sf_dir):
    """Chained hour -> day windows; closed days only."""
    out, _ = sr.run_available_now(sm.daily_stream(_silver_stream(spark, sf_dir), delay=None),
                                  "stream_daily", spark)
    return out.select("window_date", "city", _r("total_precip_mm").alias("total_precip_mm"),
                      "hours_observed", "rainy_hours",
                      _r("coldest_hour_temp_c").alias("coldest_hour_temp_c"),
                      _r("avg_hourly_min_temp_c").alias("avg_hourly_min_temp_c"),
                      "subzero_hours")


@register("stream_silver_closed")
def q_stream_silver_closed(spark, sf_dir):
    """T1 to the end of its input: row for row what the batch job gives."""
    out, _ = sr.run_available_now(_closed_silver_stream(spark, sf_dir), "stream_silver_closed", spark)
    return _silver_out(out)


@register("stream_daily_closed")
def q_stream_daily_closed(spark, sf_dir):
    """T3 to the end of its input: G2 and G4 for every day."""
    out, _ = sr.run_available_now(sm.daily_stream(_closed_silver_stream(spark, sf_dir), delay=None),
                                  "stream_daily_closed", spark)
    return out.select("window_date", "city", _r("total_precip_mm").alias("total_precip_mm"),
                      "hours_observed", "rainy_hours",
                      _r("coldest_hour_temp_c").alias("coldest_hour_temp_c"),
                      _r("avg_hourly_min_temp_c").alias("avg_hourly_min_temp_c"),
                      "subzero_hours")


@register("stream_traffic_weather")
def q_stream_traffic_weather(spark, sf_dir):
    """T5: road readings stream x static hourly weather."""
    roads = (spark.readStream.schema(_roads(spark, sf_dir).schema)
             .parquet(landing.layer_path(spark, sf_dir, "road_traffic")))
    stream = road_weather_stream(roads, hourly_table(spark, sf_dir),
                                 fx.FIXTURE_TIME_FROM, fx.FIXTURE_TIME_TO)
    out, _ = sr.run_available_now(stream, "stream_traffic_weather", spark)
    return _round_doubles(out, keep=("lat", "lon"))


@register("random_event_id")
def q_random_event_id(spark, sf_dir):
    """Random ids for records without a natural key; the values differ per
    run, so the output is their shape: source prefix + 32 hex digits."""
    from ..functions import random_event_id
    ids = _events(spark, sf_dir).select(
        F.col("event_id").alias("src_id"), random_event_id("lviv_gtfs_rt").alias("rid"))
    return ids.select("src_id", F.length("rid").alias("id_length"),
                      F.col("rid").rlike("^lviv_gtfs_rt-[0-9a-f]{32}$").alias("well_formed"))


@register("center_labels")
def q_center_labels(spark, sf_dir):
    """Centers of both datasets tagged with the dataset name (fixed
    labels: src_id % 4 for road readings, hour_of_day % 4 for probe cells)."""
    roads = mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC)
    probes = fe.join_weather(labelled_cells(spark, sf_dir, **FIXTURE_RANGE), hourly_fixture(spark, sf_dir),
                             fx.FIXTURE_TIME_FROM, fx.FIXTURE_TIME_TO)
    probes = mp.check_dataset(probes, mp.PROBE_SPEC)

    def pts(df, spec, label):
        return (df.filter(F.col(spec.classification_target) == 1)
                  .select("lat", "lon", F.col(spec.intensity).cast("double").alias("intensity"),
                          label.alias("cluster")).dropna())

    centers = mm.center_labels({
        "tomtom": mk.centers_from_labels(pts(roads, mp.ROAD_SPEC, F.col(ML_KEY) % 4)),
        "kpt": mk.centers_from_labels(pts(probes, mp.PROBE_SPEC, F.col("hour_of_day") % 4)),
    })
    return centers.select("dataset", "cluster_id",
                          *[_r(c).alias(c) for c in ("lat", "lon", "intensity_mean")], "size")


@register("bronze_quarantine")
def q_bronze_quarantine(spark, sf_dir):
    """S1 + P7: malformed Bronze lines land in quarantine (the rest parse);
    Silver over the same files keeps only well-formed, valid rows."""
    from .. import schemas
    from ..sources.bronze import quarantine, read_bronze_json
    raw = read_bronze_json(spark, landing.bronze_text_path(spark, sf_dir), schemas.WEATHER_ENVELOPE)
    return quarantine(raw).select("event_id", "_corrupt_record")


# ---- ML on the probe (KPT) dataset ----------------------------------------------

KPT_KEY = "cell_key"


def kpt_ml_dataset(spark, sf_dir) -> DataFrame:
    """Probe cells x hourly weather with an integer cell-hour key (hour epoch,
    then the two grid indices) for the hash split."""
    df = fe.join_weather(labelled_cells(spark, sf_dir, **FIXTURE_RANGE), hourly_fixture(spark, sf_dir),
                         fx.FIXTURE_TIME_FROM, fx.FIXTURE_TIME_TO)
    key = (F.unix_timestamp("event_hour") * F.lit(100000000)
           + F.round(F.col("lat") * 100).cast("bigint") * F.lit(10000)
           + F.round(F.col("lon") * 100).cast("bigint"))
    return df.withColumn(KPT_KEY, key)


@register("kpt_run_summary")
def q_kpt_run_summary(spark, sf_dir):
    """M1/M3/M18 on the probe dataset: rows, split, features, positive rate."""
    df = mp.hash_split(mp.check_dataset(kpt_ml_dataset(spark, sf_dir), mp.PROBE_SPEC), KPT_KEY)
    n_levels = mp.count_levels(df, "direction_bucket")
    return df.agg(F.count(F.lit(1)).alias("rows_total"),
                  F.count(F.when(~F.col("is_test"), 1)).alias("rows_train"),
                  F.count(F.when(F.col("is_test"), 1)).alias("rows_test"),
                  _r(F.avg(F.when(~F.col("is_test"), F.col("is_congested").cast("double"))))
                  .alias("positive_rate_train")) \
             .withColumn("feature_count", F.lit(len(mp.PROBE_SPEC.numeric) + n_levels))


@register("kpt_class_weights")
def q_kpt_class_weights(spark, sf_dir):
    """M11 on the probe dataset's train rows."""
    df = mp.hash_split(mp.check_dataset(kpt_ml_dataset(spark, sf_dir), mp.PROBE_SPEC), KPT_KEY)
    w = mp.class_weights(df.filter(~F.col("is_test")), "is_congested")
    return w.select("is_congested", "rows", _r("weight").alias("weight"))


@register("kpt_models")
def q_kpt_models(spark, sf_dir):
    """M5-M16 on the probe dataset: baseline, OLS, ridge, lasso (avg speed)
    and weighted logistic regression (congestion), scored on the test rows
    (rows-only: model fits)."""
    rows = []
    with mp.prepare(kpt_ml_dataset(spark, sf_dir), mp.PROBE_SPEC, KPT_KEY) as p:
        y = mp.PROBE_SPEC.regression_target
        for metric, v in mr.baseline_scores(p, y).drop("rows").first().asDict().items():
            rows.append(("baseline_mean", metric, float(v)))
        for model in mr.MODELS:
            sc = mr.model_scores(p, y, model).drop("model", "rows").first().asDict()
            rows += [(model, m, float(v)) for m, v in sc.items()]
        lr = mc.fit_logistic(p, "is_congested")
        test = mc.score(lr, p.data.filter(F.col("is_test"))).withColumnRenamed(
            "is_congested", "is_congested_actual")
        cls = mc.classification_scores(test).first().asDict()
        cls["roc_auc"] = mc.roc_auc(test)
        rows += [("logistic_regression", m, None if v is None else float(v))
                 for m, v in cls.items()]
    out = spark.createDataFrame(rows, "model string, metric string, value double")
    return out.select("model", "metric", _r("value").alias("value"))


LATE_SPLIT = "2024-01-15"


@register("stream_late_data")
def q_stream_late_data(spark, sf_dir):
    """T4: Bronze arrives in two uploads to one landing folder — first every
    envelope ingested from 2024-01-15 on, then the earlier ones. The same
    streaming Silver query (one checkpoint) processes each upload as it lands;
    by the second run the watermark (newest event - 1 hour) is past all of
    the earlier envelopes, so they are dropped as late. What remains is the
    first upload's events that the watermark has closed."""
    import uuid
    from ..session import scratch_path
    run = uuid.uuid4().hex[:12]
    landing_dir = scratch_path(spark, "late", run, "landing")
    bronze = landing.bronze_weather(spark, sf_dir).drop("_corrupt_record")
    stream = silver_stream(
        spark.readStream.schema(landing.BRONZE_WEATHER_SCHEMA).json(f"{landing_dir}/*/"),
        producer=fx.FIXTURE_AUTHOR, delay=STREAM_DELAY, order_by=("src_id",), carry=("src_id",))
    out = None
    for wave, cond in (("wave=1", F.col("ingest_ts") >= LATE_SPLIT),
                       ("wave=2", F.col("ingest_ts") < LATE_SPLIT)):
        bronze.filter(cond).write.mode("overwrite").options(**landing.LINES).json(f"{landing_dir}/{wave}")
        q, out = sr.start(stream, "stream_late_data", spark, run=run)
        q.awaitTermination()
        if wave == "wave=2":
            dropped = sr.rows_dropped_by_watermark(q)
            assert dropped > 0 or bronze.filter(cond).isEmpty(), "late rows were not dropped"
    return _silver_out(spark.read.parquet(out))


# ---- Bronze from response bodies --------------------------------------------------

from ..sources.bronze import read_bronze  # noqa: E402
from ..streaming import capture as cap  # noqa: E402

#: Captures up to here land first; it is within an hour, so a static domain's
#: stream starts again in an hour that it has captured already.
CAPTURE_SPLIT = "2024-01-15T10:30:00Z"


def collected(spark, sf_dir, domain: str) -> DataFrame:
    """Bronze of a domain, collected from its landed bodies in two runs of one
    stream: the second goes on from the first's checkpoint."""
    import uuid
    from ..session import scratch_path
    base = scratch_path(spark, "collect", uuid.uuid4().hex[:12])
    log = fx.capture_log(spark, sf_dir, domain)
    early = F.col("captured_at") < CAPTURE_SPLIT
    for wave in (early, ~early):
        log.filter(wave).write.mode("append").options(**landing.LINES).json(f"{base}/landing/{domain}")
        q = cap.collect_domain(spark, f"{base}/landing/{domain}", f"{base}/bronze", domain, fx.FIXTURE_AUTHOR,
                               interval_seconds=0, layout="log", checkpoint=f"{base}/progress")
        q.awaitTermination()
    spec = cap.COLLECTORS[domain]
    return read_bronze(spark, f"{base}/bronze", domain, spec.source, schemas.envelope(spec.payload))


@register("collect_weather")
def q_collect_weather(spark, sf_dir):
    """B4 + B9 + K1: landed forecast responses streamed to Bronze and read back."""
    return _flat_payload(collected(spark, sf_dir, "weather"), "ingest_ts", "source", "author", "event_id",
                         "ingest_date", "hour")


@register("collect_traffic")
def q_collect_traffic(spark, sf_dir):
    """B5 + B9 + K1: raw captures streamed to Bronze and read back."""
    out = collected(spark, sf_dir, "traffic")
    return out.select("ingest_ts", "event_id", "ingest_date", "hour", *[
        F.col(f"payload.{c}").alias(c) for c in ("endpoint", "content_length", "content_sha256", "payload_b64")])


@register("collect_alerts")
def q_collect_alerts(spark, sf_dir):
    """B6 + B9 + B10 + K1: alert exports streamed to Bronze, one an hour."""
    out = collected(spark, sf_dir, "alerts")
    row = F.col("payload.row")
    return out.select("ingest_ts", "event_id", "ingest_date", "hour",
                      F.col("payload.source_url").alias("source_url"), F.size(row).alias("n_cells"),
                      row["region"].alias("region"), row["oblast"].alias("oblast"), row["notes"].alias("notes"))


@register("collect_roads")
def q_collect_roads(spark, sf_dir):
    """B7 + B9 + B10 + K1: road responses streamed to Bronze, one an hour."""
    out = collected(spark, sf_dir, "roads")
    return out.select("ingest_ts", "event_id", "ingest_date", "hour", *[
        F.col(f"payload.{c}").alias(c) for c in ("way_id", "highway_class", "name", "name_en", "maxspeed", "lanes",
                                                 "center_lat", "center_lon")])


# ---- incremental Silver -----------------------------------------------------------

from ..plans import incremental as inc  # noqa: E402
from ..sinks import write_bronze  # noqa: E402


@register("silver_incremental")
def q_silver_incremental(spark, sf_dir):
    """V9 + V6 + K2 in two incremental runs: the later polls land first, so the
    second run also meets earlier copies of events that the layer holds."""
    import uuid
    from ..session import scratch_path
    base = scratch_path(spark, "incremental", uuid.uuid4().hex[:12])
    bronze = landing.bronze_weather(spark, sf_dir).drop("_corrupt_record", "src_id")
    late = F.col("ingest_ts") >= LATE_SPLIT
    for wave in (late, ~late):
        write_bronze(bronze.filter(wave), f"{base}/bronze", "weather", "open_meteo_current")
        inc.run_silver_incremental(spark, f"{base}/bronze", f"{base}/silver", "open_meteo_current",
                                   producer=fx.FIXTURE_AUTHOR, overlap="0 seconds")
    return _silver_out(inc.current_silver(spark, f"{base}/silver", "open_meteo_current"))


# ---- layers written and read back -------------------------------------------------

def _folder(spark, name: str) -> str:
    import uuid
    return S.scratch_path(spark, name, uuid.uuid4().hex[:12])


#: What a Gold metric's files are checked by: a value of its rows of a day.
GOLD_CHECKS = {
    "temperature_hourly": "max(temperature_max_c)", "precipitation_daily": "max(total_precip_mm)",
    "wind_daily_extremes": "max(wind_speed_max_ms)", "subzero_hours_daily": "min(coldest_hour_temp_c)",
}


@register("gold_job")
def q_gold_job(spark, sf_dir):
    """Bronze files, an incremental Silver run, four Gold
    metrics in one job; each metric's files read back, by day and city."""
    from . import jobs
    base = _folder(spark, "gold_job")
    bronze = landing.bronze_weather(spark, sf_dir).drop("_corrupt_record", "src_id")
    write_bronze(bronze, f"{base}/bronze", "weather", "open_meteo_current")
    inc.run_silver_incremental(spark, f"{base}/bronze", f"{base}/silver", "open_meteo_current",
                               producer=fx.FIXTURE_AUTHOR)
    done = jobs.run_gold(spark, f"{base}/silver", f"{base}/gold", "open_meteo_current", fx.FIXTURE_AUTHOR,
                         metrics=list(GOLD_CHECKS), run_id="run000000001")
    out = None
    for name, path in sorted(done.paths.items()):
        rows = spark.read.parquet(path).groupBy("metric_name", "author", "schema_v", "run_id", "window_date", "city").agg(
            F.count(F.lit(1)).alias("n_rows"), _r(F.expr(GOLD_CHECKS[name])).alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("dataset_files")
def q_dataset_files(spark, sf_dir):
    """K4 + S3: the road dataset written, kept when written again, read back."""
    from ..sinks import write_dataset
    from ..sources.silver import read_silver_recursive
    path = _folder(spark, "dataset") + "/dataset_tomtom"
    road = datasets(spark, sf_dir)[1]
    write_dataset(road, path, fx.FIXTURE_AUTHOR)
    write_dataset(road.limit(0), path, "nobody")  # there already: left alone
    return _round_doubles(read_silver_recursive(spark, path), keep=("lat", "lon"))


@register("prediction_files")
def q_prediction_files(spark, sf_dir):
    """K5 + S7: predictions written and read back; a dataset without is left out."""
    from ..sinks import write_predictions
    from ..sources.silver import read_optional
    base = _folder(spark, "predictions")
    write_predictions(scored_fixture(spark, sf_dir), f"{base}/predictions_tomtom")
    found = read_optional(spark, {n: f"{base}/predictions_{n}" for n in ("tomtom", "kpt")})
    assert set(found) == {"tomtom"}
    return found["tomtom"].select("src_id", _ntz("event_hour").alias("event_hour"), "is_congested_actual",
                                  "is_congested_pred", _r("congestion_proba").alias("congestion_proba"))


@register("center_files")
def q_center_files(spark, sf_dir):
    """K7 + S7: cluster centers written and read back."""
    from ..sinks import write_centers
    from ..sources.silver import read_centers
    path = _folder(spark, "centers")
    df = mp.check_dataset(ml_dataset(spark, sf_dir), mp.ROAD_SPEC)
    points = (df.filter(F.col("is_congested") == 1)
              .select("lat", "lon", F.col("current_travel_time_s").alias("intensity"),
                      (F.col(ML_KEY) % 4).alias("cluster")).dropna())
    write_centers(mk.centers_from_labels(points).withColumn("dataset", F.lit("tomtom")), path)
    out = read_centers(spark, path)
    return out.select("dataset", "cluster_id", *[_r(c).alias(c) for c in ("lat", "lon", "intensity_mean")], "size")


@register("metric_sections")
def q_metric_sections(spark, sf_dir):
    """K6: writing one section again replaces it and leaves the others."""
    from ..sinks import write_metrics
    path = _folder(spark, "metrics") + "/metrics"
    scored = scored_fixture(spark, sf_dir)

    def long(section, model, aggregates):
        wide = scored.agg(*[c.cast("double").alias(n) for n, c in aggregates.items()])
        return wide.select(F.lit(section).alias("section"), F.lit("tomtom").alias("dataset"), F.lit(model).alias("model"),
                           F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in aggregates])).alias("m")
                           ).select("section", "dataset", "model", "m.metric", "m.value")

    write_metrics(long("regression", "old", {"gone": F.lit(0.0)}), path)
    write_metrics(long("classification", "rule", {"rows": F.count(F.lit(1)), "positives": F.sum("is_congested_actual")}), path)
    write_metrics(long("regression", "new", {"proba_mean": F.avg("congestion_proba")}), path)
    out = spark.read.parquet(path)
    return out.select("section", "dataset", "model", "metric", _r("value").alias("value"))


@register("silver_repartition")
def q_silver_repartition(spark, sf_dir):
    """V8: a fixed number of output partitions, rows spread evenly over them."""
    out = silver.rebalance(silver_table(spark, sf_dir), 8).groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    return out.agg(F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("n_rows"),
                   (F.max("n") - F.min("n") <= 64).alias("even"))


@register("lenient_coercion")
def q_lenient_coercion(spark, sf_dir):
    """D13 + D14: measures and times as text, with values that are none."""
    raw = fx.road_text(_events(spark, sf_dir))
    out = fe.coerce_road(raw)
    return out.select("src_id", _ntz("event_ts").alias("event_ts"), *fe.ROAD_NUMERIC)


@register("weather_union_missing")
def q_weather_union_missing(spark, sf_dir):
    """A feed without one of the columns has nulls there."""
    frames = weather_frames(spark, sf_dir)
    return _round_doubles(fe.union_weather([*frames[:2], frames[2].drop("humidity_pct")]))
