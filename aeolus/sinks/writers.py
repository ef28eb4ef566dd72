"""Writers for every layer (K1-K7).

Output files are sized by a ``REBALANCE`` hint under AQE rather than a fixed
``repartition(n)``: a fixed count writes tiny files at small scale and huge
ones at large scale, and a hash repartition on a skewed partition key puts a
third of the data in one task. Gold and model tables are overwritten per
partition (dynamic partition overwrite), so a rerun replaces its own
partitions instead of appending duplicates.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SCHEMA_VERSION
from ..operators.bronze import with_partition_keys
from ..sources.bronze import bronze_root
from ..sources.silver import silver_root
from .manifest import commit

FORMATS = ("parquet", "json")


def _fmt(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {fmt!r}")
    return fmt


def _rebalance(df: DataFrame, cols: Sequence[str] = ()) -> DataFrame:
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")


def write_bronze(envelopes: DataFrame, root: str, domain: str, source: str) -> None:
    """K1: append JSON Lines under
    ``domain=/source=/schema_v=/ingest_date=/hour=`` (keys from ``ingest_ts``)."""
    keyed = with_partition_keys(envelopes).drop("part_stamp")
    (_rebalance(keyed, ("ingest_date", "hour"))
     .write.mode("append").partitionBy("ingest_date", "hour")
     .json(bronze_root(root, domain, source)))


def write_silver(df: DataFrame, root: str, domain: str, source: str, run_id: str,
                 fmt: str = "parquet", partitions: int | None = None) -> str:
    """K2: one ``run_id=`` directory per run; ``partitions`` forces a fixed
    file count (the source pipeline used 8)."""
    path = f"{silver_root(root, domain, source)}/run_id={run_id}"
    out = df.repartition(partitions) if partitions else _rebalance(df)
    out.write.mode("append").format(_fmt(fmt)).save(path)
    return path


def gold_path(root: str, domain: str, metric: str, schema_v: int = SCHEMA_VERSION) -> str:
    return f"{root.rstrip('/')}/domain={domain}/metric={metric}/schema_v={schema_v}"


def write_gold(df: DataFrame, root: str, domain: str, metric: str, run_id: str,
               partition_cols: Sequence[str], fmt: str = "parquet") -> str:
    """K3: partitioned by the metric's window columns; dynamic partition
    overwrite makes a rerun of the same ``run_id`` idempotent."""
    path = f"{gold_path(root, domain, metric)}/run_id={run_id}"
    (_rebalance(df, partition_cols).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(_fmt(fmt)).save(path))
    return path


def write_dataset(df: DataFrame, path: str, author: str, force: bool = False) -> str:
    """K4: distributed Parquet (never collected); kept if present unless
    ``force``."""
    (_rebalance(df.withColumn("author", F.lit(author)))
     .write.mode("overwrite" if force else "ignore").parquet(path))
    return path


def write_hourly(hourly: DataFrame, root: str, version: str) -> str:
    """A version of the hourly weather table; visible once its record is written."""
    path = f"{root.rstrip('/')}/hourly/run_id={version}"
    hourly.coalesce(1).write.mode("overwrite").parquet(path)  # a row an hour
    commit(hourly.sparkSession, root, "weather", "hourly", version, None, 0, 0, 0)
    return path


def write_predictions(df: DataFrame, path: str) -> str:
    """K5."""
    _rebalance(df).write.mode("overwrite").parquet(path)
    return path


def write_metrics(long_metrics: DataFrame, path: str) -> str:
    """K6: long table (section, dataset, model, metric, value) partitioned by
    section and dataset; writing one section of one dataset replaces only
    that partition and keeps every other section."""
    (long_metrics.coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("section", "dataset").parquet(path))
    return path


def write_centers(centers: DataFrame, path: str) -> str:
    """K7: cluster centers (at most ten rows per dataset) as JSON."""
    centers.coalesce(1).write.mode("overwrite").json(path)
    return path
