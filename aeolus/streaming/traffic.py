"""T5: road readings stream enriched with the static hourly weather table.

A stream-static inner join is stateless: every micro-batch joins against the
current weather table. The weather side is bounded by the hours of its range
(see ``features.join_weather``)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import features as fe


def road_weather_stream(roads: DataFrame, hourly_weather: DataFrame,
                        time_from: str | None = None, time_to: str | None = None,
                        keep: tuple[str, ...] = ()) -> DataFrame:
    readings = fe.road_readings(roads, time_from=time_from, time_to=time_to, keep=keep)
    return fe.join_weather(readings, hourly_weather, time_from, time_to)
