"""Heat-map point tables (bounded: pre-aggregated to grid cells)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAP_DIGITS = 3


def heatmap_real(preds: DataFrame, digits: int = MAP_DIGITS,
                 actual: str = "is_congested_actual") -> DataFrame:
    """Actual congestion as weighted cells (lat, lon, weight)."""
    return (preds.filter(F.col(actual) == 1).dropna(subset=["lat", "lon"])
            .groupBy(F.round("lat", digits).alias("lat"), F.round("lon", digits).alias("lon"))
            .agg(F.count(F.lit(1)).alias("weight")))


def heatmap_predicted(preds: DataFrame, digits: int = MAP_DIGITS,
                      proba: str = "congestion_proba") -> DataFrame:
    """Mean predicted probability per cell, with its support."""
    return (preds.dropna(subset=["lat", "lon", proba])
            .groupBy(F.round("lat", digits).alias("lat"), F.round("lon", digits).alias("lon"))
            .agg(F.avg(proba).alias("congestion_proba"), F.count(F.lit(1)).alias("points")))


def center_labels(centers: dict[str, DataFrame]) -> DataFrame:
    """Centers of every clustered dataset, tagged with its name
    (skipped datasets are simply absent)."""
    frames = [df.withColumn("dataset", F.lit(name)) for name, df in centers.items()]
    if not frames:
        raise ValueError("no cluster centers to label")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
