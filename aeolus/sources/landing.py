"""Landed inputs: the fixture derivations written once per session to the
shared folder (``spark.checkpoint.dir``), then scanned like real layers.

The pipeline's Silver job reads Bronze *files*, not a live projection, so the
registered queries do the same: Bronze weather envelopes land as JSON Lines
(gzip) and are read back with the explicit envelope schema (``read_bronze``);
traffic and weather feeds land as Parquet tables (``read_layer``). Besides
matching the production shape, this keeps Catalyst from pushing Silver's
filters through the derivation and re-evaluating it once per predicate.
Writes are idempotent (``overwrite``) and the paths are per application, so
reruns and lost executors never see partial data from another run.
"""

from __future__ import annotations

import hashlib
import os
import threading
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas
from ..session import ensure_checkpoint_dir, scratch_path
from . import fixtures as fx

_LOCK = threading.Lock()
_LANDED: dict[tuple[str, str, str], str] = {}
_KEY_LOCKS: dict[tuple[str, str, str], threading.Lock] = {}

_BUILDERS = {
    "probe_traffic": fx.probe_traffic,
    "road_traffic": fx.road_traffic,
    "weather_api": fx.weather_api_feed,
    "owm": fx.owm_feed,
    "weather_polls": fx.weather_polls,
}

#: How lines (JSON, text) land: compressed, in files that one task reads whole.
LINES = {"compression": "gzip", "maxRecordsPerFile": 25_000}

BRONZE_WEATHER_SCHEMA = T.StructType(
    [*schemas.WEATHER_ENVELOPE.fields, T.StructField("src_id", T.LongType())])


def land(spark: SparkSession, sf_dir: str, name: str, fmt: str,
          build: Callable[[DataFrame], DataFrame]) -> str:
    ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    key = (app, os.path.abspath(sf_dir), name)
    with _LOCK:
        lock = _KEY_LOCKS.setdefault(key, threading.Lock())
    with lock:  # one writer per input; different inputs land concurrently
        path = _LANDED.get(key)
        if path is None:
            tag = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:12]
            path = scratch_path(spark, "landing", app, tag, name)
            # Rows go from the scan's tasks straight to files: evening out the
            # tasks would shuffle, sort and spill every row once more.
            df = build(fx.read_table(spark, sf_dir, "events"))
            writer = df.write.mode("overwrite").format(fmt)
            (writer if fmt == "parquet" else writer.options(**LINES)).save(path)
            _LANDED[key] = path
    return path


def bronze_weather_path(spark: SparkSession, sf_dir: str) -> str:
    return land(spark, sf_dir, "bronze_weather", "json", fx.weather_bronze)


def layer_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    return land(spark, sf_dir, name, "parquet", _BUILDERS[name])


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze weather envelopes, landed as JSON Lines and scanned back."""
    path = land(spark, sf_dir, "bronze_weather", "json", fx.weather_bronze)
    from .bronze import read_bronze_json
    return read_bronze_json(spark, path, BRONZE_WEATHER_SCHEMA)


def read_layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A landed Parquet input table (``probe_traffic``, ``road_traffic``,
    ``weather_api``, ``owm``, raw ``weather_polls`` response bodies)."""
    path = layer_path(spark, sf_dir, name)
    from .silver import read_silver_recursive
    return read_silver_recursive(spark, path)


def bronze_text_path(spark: SparkSession, sf_dir: str) -> str:
    """Bronze weather lines with some malformed ones, landed as plain text."""
    return land(spark, sf_dir, "bronze_text", "text", fx.bronze_lines_with_corruption)


def land_all(spark: SparkSession, sf_dir: str, threads: int = 6) -> dict[str, str]:
    """Land every input at once: the writes are independent jobs, so they are
    submitted concurrently and Spark interleaves their tasks."""
    from concurrent.futures import ThreadPoolExecutor

    jobs = {"bronze_weather": lambda: bronze_weather_path(spark, sf_dir)}
    jobs.update({n: (lambda n=n: layer_path(spark, sf_dir, n)) for n in _BUILDERS})
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = {n: pool.submit(fn) for n, fn in jobs.items()}
        return {n: f.result() for n, f in futures.items()}
