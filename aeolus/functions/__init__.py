"""Column-expression helpers: pure ``Column -> Column`` builders that stay in
whole-stage codegen (no Python UDFs)."""

from .ids import random_event_id, stable_event_id
from .geo import bbox_filter, circular_mean_deg, direction_bucket, grid_cell
from .timecols import (
    calendar_features,
    hour_bucket,
    partition_keys,
    time_range_filter,
    try_parse_ts,
)
from .coerce import lenient_double, nan_to_null
from .weather import apparent_temperature, prevailing_direction_deg, wind_components

__all__ = [
    "random_event_id", "stable_event_id",
    "bbox_filter", "circular_mean_deg", "direction_bucket", "grid_cell",
    "calendar_features", "hour_bucket", "partition_keys", "time_range_filter",
    "try_parse_ts", "lenient_double", "nan_to_null",
    "apparent_temperature", "prevailing_direction_deg", "wind_components",
]
