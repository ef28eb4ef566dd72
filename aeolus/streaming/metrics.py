"""Gold metrics over a Silver stream with event-time windows.

Append mode: a window is emitted once the watermark passes its end, so the
newest ``delay`` of data stays open until later events arrive. Daily metrics
are chained: hourly windows first, then a day window over each hour's
``window_time``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import RAIN_THRESHOLD_MM, SUBZERO_C, WINDOW_DATE_FORMAT, WINDOW_HOUR_FORMAT
from ..functions import apparent_temperature


def _watermarked(df: DataFrame, delay: str | None) -> DataFrame:
    """``delay=None`` keeps an upstream watermark (e.g. Silver's dedup one)."""
    return df if delay is None else df.withWatermark("event_ts", delay)


def hourly_stream(silver: DataFrame, delay: str | None = "1 hour") -> DataFrame:
    """G1 + G5 per (hour window, city)."""
    at = apparent_temperature("temperature_2m", "relative_humidity_2m", "wind_speed_10m")
    agg = (_watermarked(silver, delay)
           .groupBy(F.window("event_ts", "1 hour").alias("w"), "city")
           .agg(F.count(F.lit(1)).alias("samples_cnt"),
                F.avg("temperature_2m").alias("temperature_avg_c"),
                F.min("temperature_2m").alias("temperature_min_c"),
                F.max("temperature_2m").alias("temperature_max_c"),
                F.stddev_pop("temperature_2m").alias("temperature_stddev_c"),
                F.avg(at).alias("comfort_index_c"),
                F.avg("relative_humidity_2m").alias("humidity_avg_pct"),
                F.avg("wind_speed_10m").alias("wind_speed_avg_ms")))
    return agg.filter(F.col("city").isNotNull()).select(
        F.date_format("w.start", WINDOW_DATE_FORMAT).alias("window_date"),
        F.date_format("w.start", WINDOW_HOUR_FORMAT).alias("window_hour"),
        "city", "samples_cnt", "temperature_avg_c", "temperature_min_c", "temperature_max_c",
        "temperature_stddev_c", "comfort_index_c", "humidity_avg_pct", "wind_speed_avg_ms")


def daily_stream(silver: DataFrame, delay: str | None = "1 hour",
                 threshold_mm: float = RAIN_THRESHOLD_MM, subzero_c: float = SUBZERO_C) -> DataFrame:
    """G2 + G4 as a chained aggregation (hour windows -> day windows)."""
    hourly = (_watermarked(silver, delay)
              .groupBy(F.window("event_ts", "1 hour").alias("h"), "city")
              .agg(F.sum("precipitation").alias("hour_precip_mm"),
                   F.min("temperature_2m").alias("hour_min_temp_c")))
    daily = (hourly.groupBy(F.window(F.window_time("h"), "1 day").alias("d"), "city")
             .agg(F.sum("hour_precip_mm").alias("total_precip_mm"),
                  F.count(F.lit(1)).alias("hours_observed"),
                  F.sum(F.when(F.col("hour_precip_mm") >= threshold_mm, 1).otherwise(0))
                   .alias("rainy_hours"),
                  F.min("hour_min_temp_c").alias("coldest_hour_temp_c"),
                  F.avg("hour_min_temp_c").alias("avg_hourly_min_temp_c"),
                  F.count(F.when(F.col("hour_min_temp_c") < subzero_c, True)).alias("subzero_hours")))
    return daily.filter(F.col("city").isNotNull()).select(
        F.date_format("d.start", WINDOW_DATE_FORMAT).alias("window_date"), "city",
        "total_precip_mm", "hours_observed", "rainy_hours", "coldest_hour_temp_c",
        "avg_hourly_min_temp_c", "subzero_hours")
