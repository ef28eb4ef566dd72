"""Writers for every layer: partitioned, idempotent where the layer needs it."""

from .writers import (  # noqa: F401
    write_bronze,
    write_centers,
    write_dataset,
    write_gold,
    write_hourly,
    write_metrics,
    write_predictions,
    write_silver,
)
