"""Gold weather metrics over Silver rows, grouped by city name and window.

Every metric is a hash aggregate with partial (map-side) aggregation, so a hot
city or day costs one partial row per task in the shuffle. Window keys stay
strings (``yyyy-MM-dd``, ``HH``). The ``city IS NOT NULL`` post-filter is on a
grouping key, so Catalyst pushes it below the aggregate into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    KMH_PER_MS,
    RAIN_THRESHOLD_MM,
    SCHEMA_VERSION,
    SUBZERO_C,
    WINDOW_DATE_FORMAT,
    WINDOW_HOUR_FORMAT,
)
from ..functions import apparent_temperature, prevailing_direction_deg, wind_components

WIND_UNITS = ("as_is", "kmh_to_ms")


def _wind(wind_unit: str) -> Column:
    if wind_unit == "as_is":
        return F.col("wind_speed_10m")
    if wind_unit == "kmh_to_ms":
        return F.col("wind_speed_10m") / F.lit(KMH_PER_MS)
    raise ValueError(f"wind_unit must be one of {WIND_UNITS}, got {wind_unit!r}")


def window_date(ts: str = "event_ts") -> Column:
    return F.date_format(F.col(ts), WINDOW_DATE_FORMAT)


def window_hour(ts: str = "event_ts") -> Column:
    return F.date_format(F.col(ts), WINDOW_HOUR_FORMAT)


# ---- metrics as declarations --------------------------------------------------
#
# A metric is a grain, the measures at that grain and, for two-level metrics,
# the values that each hour contributes first. ``aggregate`` builds one plan for
# any metrics of one grain, so a metric alone and several from one shuffle are
# the same declaration.

HOURLY = ("window_date", "window_hour", "city")
DAILY = ("window_date", "city")


@dataclass(frozen=True)
class Options:
    """Parameters of the metrics; the defaults are the fixed values."""
    wind_unit: str = "as_is"
    threshold_mm: float = RAIN_THRESHOLD_MM
    subzero_c: float = SUBZERO_C


Columns = Callable[[Options], dict[str, Column]]


@dataclass(frozen=True)
class MetricDef:
    grain: tuple[str, ...]
    measures: Columns
    columns: tuple[str, ...]                 # Silver columns it reads
    by_hour: Columns | None = None           # first level: values of a city-hour
    derived: Columns | None = None           # from measures, which then aren't output

    @property
    def partition_cols(self) -> tuple[str, ...]:
        return tuple(c for c in self.grain if c.startswith("window_"))

    @property
    def level(self) -> tuple[tuple[str, ...], bool]:
        """Metrics of the same level can share their aggregation."""
        return self.grain, self.by_hour is not None


def _samples() -> dict[str, Column]:
    return {"samples_cnt": F.count(F.lit(1))}


def _temperature(o: Options) -> dict[str, Column]:
    stats = (("avg", F.avg), ("min", F.min), ("max", F.max), ("stddev", F.stddev_pop))
    return _samples() | {f"temperature_{n}_c": f("temperature_2m") for n, f in stats}


def _comfort(o: Options) -> dict[str, Column]:
    wind = _wind(o.wind_unit)
    felt = apparent_temperature("temperature_2m", "relative_humidity_2m", wind)
    means = {"comfort_index_c": felt, "temperature_avg_c": F.col("temperature_2m"),
             "humidity_avg_pct": F.col("relative_humidity_2m"), "wind_speed_avg_ms": wind}
    return _samples() | {n: F.avg(c) for n, c in means.items()}


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def _rain(o: Options) -> dict[str, Column]:
    # Hourly values are sums of samples, so several polls in one hour add up.
    return {"total_precip_mm": F.sum("hour_precip_mm"),
            "hours_observed": F.count(F.lit(1)),
            "rainy_hours": _count_if(F.col("hour_precip_mm") >= o.threshold_mm)}


def _cold(o: Options) -> dict[str, Column]:
    # An hour counts by its minimum, strictly below the limit.
    return {"hours_observed": F.count(F.lit(1)),
            "coldest_hour_temp_c": F.min("hour_min_temp_c"),
            "avg_hourly_min_temp_c": F.avg("hour_min_temp_c"),
            "subzero_hours": _count_if(F.col("hour_min_temp_c") < o.subzero_c)}


def _wind_extremes(o: Options) -> dict[str, Column]:
    # Rows with a null direction still count for speed but not for the vector.
    wind = _wind(o.wind_unit)
    u, v = wind_components(wind, "wind_direction_10m")
    return {"wind_speed_max_ms": F.max(wind), "wind_speed_avg_ms": F.avg(wind),
            "_mean_u": F.avg(u), "_mean_v": F.avg(v)}


def _wind_vector(o: Options) -> dict[str, Column]:
    return {"prevailing_wind_deg": prevailing_direction_deg("_mean_u", "_mean_v"),
            "mean_wind_vector_ms": F.sqrt(F.col("_mean_u") * F.col("_mean_u")
                                          + F.col("_mean_v") * F.col("_mean_v"))}


WEATHER_METRICS: dict[str, MetricDef] = {
    # G1: samples, avg/min/max and population stddev of temperature.
    "temperature_hourly": MetricDef(
        HOURLY, _temperature, ("event_ts", "city", "temperature_2m")),
    # Daily precipitation from hourly sums; rainy hour = sum >= threshold.
    "precipitation_daily": MetricDef(
        DAILY, _rain, ("event_ts", "city", "precipitation"),
        by_hour=lambda o: {"hour_precip_mm": F.sum("precipitation")}),
    # max/avg speed and the vector-mean (prevailing) direction.
    "wind_daily_extremes": MetricDef(
        DAILY, _wind_extremes, ("event_ts", "city", "wind_speed_10m", "wind_direction_10m"),
        derived=_wind_vector),
    # Hours whose minimum temperature is strictly below zero.
    "subzero_hours_daily": MetricDef(
        DAILY, _cold, ("event_ts", "city", "temperature_2m"),
        by_hour=lambda o: {"hour_min_temp_c": F.min("temperature_2m")}),
    # Mean apparent temperature and its inputs per city-hour.
    "comfort_index_hourly": MetricDef(
        HOURLY, _comfort,
        ("event_ts", "city", "temperature_2m", "relative_humidity_2m", "wind_speed_10m")),
}


def aggregate(silver: DataFrame, names: Iterable[str], options: Options = Options()) -> DataFrame:
    """All measures of metrics of one level from one aggregation: a shuffle for
    one-level metrics, two for two-level ones. Rows without a city are left out."""
    metrics = [WEATHER_METRICS[n] for n in names]
    (grain, two_level), = {m.level for m in metrics}
    base = silver.withColumns({c: k for c, k in (
        ("window_date", window_date()), ("window_hour", window_hour())) if c in grain})
    if two_level:
        values: dict[str, Column] = {}
        for m in metrics:
            values |= m.by_hour(options)
        base = (base.withColumn("sample_hour", F.hour("event_ts")).groupBy(*grain, "sample_hour")
                .agg(*[c.alias(n) for n, c in values.items()]))
    measures: dict[str, Column] = {}
    for m in metrics:
        measures |= m.measures(options)
    return (base.groupBy(*grain).agg(*[c.alias(n) for n, c in measures.items()])
            .filter(F.col("city").isNotNull()))


def output(aggregated: DataFrame, name: str, options: Options = Options()) -> DataFrame:
    """One metric's columns of an aggregation that holds its measures."""
    m = WEATHER_METRICS[name]
    derived = m.derived(options) if m.derived else {}
    return aggregated.select(
        *m.grain, *[n for n in m.measures(options) if not n.startswith("_")],
        *[c.alias(n) for n, c in derived.items()])


def metric(silver: DataFrame, name: str, options: Options = Options()) -> DataFrame:
    return output(aggregate(silver, [name], options), name, options)


def shared_levels(names: Iterable[str]) -> list[list[str]]:
    """The metrics grouped so that each group takes one aggregation."""
    groups: dict[tuple, list[str]] = {}
    for n in names:
        groups.setdefault(WEATHER_METRICS[n].level, []).append(n)
    return list(groups.values())


def temperature_hourly(silver: DataFrame) -> DataFrame:
    return metric(silver, "temperature_hourly")


def comfort_index_hourly(silver: DataFrame, wind_unit: str = "as_is") -> DataFrame:
    return metric(silver, "comfort_index_hourly", Options(wind_unit=wind_unit))


def precipitation_daily(silver: DataFrame, threshold_mm: float = RAIN_THRESHOLD_MM) -> DataFrame:
    return metric(silver, "precipitation_daily", Options(threshold_mm=threshold_mm))


def subzero_hours_daily(silver: DataFrame, subzero_c: float = SUBZERO_C) -> DataFrame:
    return metric(silver, "subzero_hours_daily", Options(subzero_c=subzero_c))


def wind_daily_extremes(silver: DataFrame, wind_unit: str = "as_is") -> DataFrame:
    return metric(silver, "wind_daily_extremes", Options(wind_unit=wind_unit))


# ---- G7 lineage, G6 registry -------------------------------------------------

def finalize_metric(df: DataFrame, producer: str, run_id: str, metric_name: str) -> DataFrame:
    """Lineage columns on every Gold row."""
    return df.withColumns({
        "author": F.lit(producer),
        "schema_v": F.lit(SCHEMA_VERSION),
        "run_id": F.lit(run_id),
        "metric_name": F.lit(metric_name),
    })


METRIC_DOMAINS: dict[str, dict[str, MetricDef]] = {"weather": WEATHER_METRICS}


def select_metrics(domain: str, requested: Iterable[str] | None = None) -> dict[str, MetricDef]:
    """The domain's metrics, or the requested subset; unknown names raise."""
    known = METRIC_DOMAINS.get(domain, {})
    wanted = list(dict.fromkeys(requested or known))
    if not known or not known.keys() >= set(wanted):
        strange = sorted(set(wanted) - known.keys()) or "any"
        raise ValueError(f"domain {domain!r} has no Gold metrics {strange}; known: {sorted(known)}")
    return {n: known[n] for n in wanted}


def needed_columns(metrics: dict[str, MetricDef]) -> list[str]:
    """Union of the Silver columns the selected metrics read (for pruning
    before a cache)."""
    return list(dict.fromkeys(c for m in metrics.values() for c in m.columns))
