"""Incremental Silver (V9, V6): every run reads only the Bronze files that are new.

A run's mark is the modification time of the newest Bronze file it read; the
next run's scan lists only files after it, less an overlap for files that
became visible late. New rows meet only what the layer holds of the same event
days: rows of events that are there already fall away, unless the new copy
comes first in the dedup's order (a late upload of an earlier poll); then both
stay and readers take the first. So the layer always equals a full run.

Runs become visible by their commit record (``sinks.manifest``); one that was
killed leaves nothing that a reader sees.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import silver
from ..session import configure, scratch_path
from ..sinks import manifest
from ..sinks import writers as W
from ..sources.bronze import read_bronze
from ..sources.silver import read_silver
from .jobs import SilverResult, new_run_id

log = logging.getLogger("aeolus.incremental")

#: The dedup's order: the first poll of an event, by ingest time, then by its values.
ORDER = ("ingest_ts", *(f.name for f in schemas.SILVER_WEATHER.fields
                        if f.name not in ("event_id", "author", "source", "schema_v", "ingest_ts")))
#: Ranges of days that a filter spells out; more become one range.
MOST_RANGES = 64


def _place(order=ORDER) -> Column:
    """A row's place among copies of its event: comparable, nulls last."""
    return F.struct(*[c for name in order for c in (F.col(name).isNull().alias(f"no_{name}"), F.col(name))])


def day_ranges(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Stretches of consecutive days as (first, day after the last)."""
    out: list[tuple[dt.date, dt.date]] = []
    for day in sorted(set(days)):
        if out and out[-1][1] == day:
            out[-1] = (out[-1][0], day + dt.timedelta(days=1))
        else:
            out.append((day, day + dt.timedelta(days=1)))
    return out if len(out) <= MOST_RANGES else [(out[0][0], out[-1][1])]


def on_days(days: list[dt.date]) -> Column:
    """Plain comparisons, so that they reach the Parquet scan."""
    ts, out = F.col("event_ts"), F.lit(False)
    for first, after in day_ranges(days):
        out = out | ((ts >= F.lit(first).cast("timestamp")) & (ts < F.lit(after).cast("timestamp")))
    return out


def committed_silver(spark: SparkSession, silver_root: str, source: str) -> DataFrame | None:
    """Rows of the committed runs; None before the first one that wrote any."""
    runs = manifest.committed(spark, silver_root, "weather", source).where("written_rows > 0")
    try:
        rows = read_silver(spark, silver_root, "weather", source)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return rows.join(runs.select("run_id"), "run_id", "left_semi")


def current_silver(spark: SparkSession, silver_root: str, source: str) -> DataFrame | None:
    """The layer as a full run would have it: of each event the first copy."""
    rows = committed_silver(spark, silver_root, source)
    if rows is None:
        return None
    placed = rows.withColumn("_place", _place())
    return silver.dedup_events(placed, order_by=("_place", "run_id")).drop("_place")


def run_silver_incremental(spark: SparkSession, bronze_root: str, silver_root: str, source: str,
                           producer: str | None = None, restamp: bool = False, as_of: str | None = None,
                           run_id: str | None = None, overlap: str = "1 hour") -> SilverResult:
    """One incremental run. ``overlap`` is how long before the mark files are
    read again; it has to cover the time from a file's last byte to its listing."""
    run_id = run_id or new_run_id()
    spark = configure(spark.newSession())  # see jobs.run_silver
    mark = manifest.last_mark(spark, silver_root, "weather", source)
    since = None
    if mark is not None:
        since = spark.range(1).select(
            (F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {overlap}")).cast("string")).first()[0]
    seen = Observation("seen")
    bronze = read_bronze(spark, bronze_root, "weather", source, schemas.WEATHER_ENVELOPE,
                         newer_than=since, file_time=True)
    bronze = bronze.observe(seen, F.count(F.lit(1)).alias("rows"),
                            F.max("_file_time").cast("string").alias("mark"))
    valid = silver.valid_weather(bronze, producer, restamp, as_of).withColumn("_place", _place())
    # Written once: the scan is not repeated for the days, the join and the counts.
    staged_path = scratch_path(spark, "silver", run_id)
    silver.dedup_events(valid, order_by=("_place",)).write.mode("overwrite").parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    raw, newest = seen.get["rows"], seen.get["mark"]
    if raw == 0:
        log.info("silver run %s: no new Bronze rows", run_id)
        return SilverResult(run_id, None, 0, 0)

    days = [r[0] for r in staged.select(F.to_date("event_ts")).distinct().collect()]
    fresh, there = staged, committed_silver(spark, silver_root, source)
    if days and there is not None:
        known = (there.where(on_days(days)).withColumn("_place", _place())
                 .groupBy("event_id").agg(F.min("_place").alias("_known")))
        fresh = (staged.join(known, "event_id", "left")
                 .where(F.col("_known").isNull() | (F.col("_place") < F.col("_known"))).drop("_known"))
    written = Observation("written")
    path = W.write_silver(fresh.select(*[f.name for f in schemas.SILVER_WEATHER.fields])
                          .observe(written, F.count(F.lit(1)).alias("rows")),
                          silver_root, "weather", source, run_id)
    rows = written.get["rows"]
    manifest.commit(spark, silver_root, "weather", source, run_id, max(filter(None, (mark, newest))),
                    raw, staged.count(), rows)
    log.info("silver run %s: raw=%d new=%d", run_id, raw, rows)
    return SilverResult(run_id, path if rows else None, raw, rows)
