"""Weather formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    COMFORT_OFFSET,
    COMFORT_RH_WEIGHT,
    COMFORT_VAPOUR_FACTOR,
    COMFORT_WIND_WEIGHT,
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def apparent_temperature(temp: str | Column, rh: str | Column, wind: str | Column) -> Column:
    """Comfort index: T + 0.33 * (RH/100) * 6.105 - 0.7 * wind - 4.0."""
    return (_c(temp)
            + F.lit(COMFORT_RH_WEIGHT) * (_c(rh) / F.lit(100.0)) * F.lit(COMFORT_VAPOUR_FACTOR)
            - F.lit(COMFORT_WIND_WEIGHT) * _c(wind)
            - F.lit(COMFORT_OFFSET))


def wind_components(speed: str | Column, direction_deg: str | Column) -> tuple[Column, Column]:
    """(u, v) of the wind vector; direction is where the wind comes FROM."""
    rad = F.radians(_c(direction_deg))
    return -_c(speed) * F.sin(rad), -_c(speed) * F.cos(rad)


def prevailing_direction_deg(mean_u: str | Column, mean_v: str | Column) -> Column:
    """Direction the mean wind comes from, in [0, 360)."""
    raw = F.degrees(F.atan2(-_c(mean_u), -_c(mean_v)))
    return F.when(raw < 0, raw + F.lit(360.0)).otherwise(raw)
