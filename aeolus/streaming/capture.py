"""Response bodies to Bronze: one stream for each domain (B4-B7 inside B9 and B10).

Collectors drop response bodies into a landing folder, in either of two forms:

* ``files``: every body is a file (read as ``binaryFile``). Its capture time is
  the stamp ``yyyyMMddTHHmmssZ`` in its path, else the time it was modified.
* ``log``: many captures as JSON Lines with ``captured_at``, ``endpoint`` and
  ``body`` (text) or ``body_b64``. Small bodies polled often land so, not as a
  file each.

The stream expands each body into envelopes and appends them to the hour
partitions. A body that is no JSON where JSON is due is skipped, as a failed
poll is. A static domain is captured once per clock hour: keyed state lets the
first usable capture of an hour through, and it outlives a restart. A capture
without any record counts as the hour's capture too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import schemas
from ..constants import (
    ALERTS_SOURCE,
    INGEST_TS_FORMAT,
    PART_STAMP_FORMAT,
    POLL_INTERVAL_SECONDS,
    ROADS_SOURCE,
    STATIC_DOMAINS,
    TRAFFIC_CAPTURE_SOURCE,
    WEATHER_SOURCE,
)
from ..operators import bronze as br
from ..session import configure
from ..sources.bronze import capture_root
from .ingest import append_bronze, checkpoint_root, start_each
from .runner import use_rocksdb_state

CAPTURE_LOG = "captured_at string, endpoint string, body string, body_b64 string"
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
LAYOUTS = ("files", "log")
#: State partitions of a static domain's stream.
STATE_PARTITIONS = 8


# ---- captures ---------------------------------------------------------------

def captures(spark: SparkSession, landing_dir: str, layout: str = "files",
             max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of (captured_at, endpoint, content) over a landing folder."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if layout == "log":
        rows = reader.schema(CAPTURE_LOG).json(landing_dir)
        return rows.select(
            F.try_to_timestamp("captured_at", F.lit(INGEST_TS_FORMAT)).alias("captured_at"), "endpoint",
            F.coalesce(F.unbase64("body_b64"), F.col("body").cast("binary")).alias("content"),
        ).where("captured_at IS NOT NULL AND content IS NOT NULL")
    rows = reader.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", True).load(landing_dir)
    stamp = F.regexp_extract("path", r".*(?<!\d)(\d{8}T\d{6}Z)", 1)
    return rows.select(
        F.coalesce(F.try_to_timestamp(stamp, F.lit(PART_STAMP_FORMAT)), "modificationTime").alias("captured_at"),
        F.col("path").alias("endpoint"), "content",
    )


def first_of_each_hour(rows: DataFrame) -> DataFrame:
    """B10 in a stream: the first capture of every clock hour, by time, then endpoint.

    The state is one flag an hour, kept for good, so that neither a restart nor
    a late upload captures an hour again; 24 flags a day stay small."""

    def first(_key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = None
        for frame in frames:  # each group's frames must be read to their end
            own = frame.sort_values(["captured_at", "endpoint"]).iloc[:1]
            if best is None or tuple(own.iloc[0, :2]) < tuple(best.iloc[0, :2]):
                best = own
        if not state.exists and best is not None:
            state.update((True,))
            yield best[["captured_at", "endpoint", "content"]]

    fields = "captured_at timestamp, endpoint string, content binary"
    ordered = rows.select("captured_at", F.coalesce("endpoint", F.lit("")).alias("endpoint"), "content",
                          F.date_trunc("hour", "captured_at").alias("hour_start"))
    return ordered.groupBy("hour_start").applyInPandasWithState(
        first, fields, "captured boolean", "append", GroupStateTimeout.NoTimeout)


# ---- bodies -----------------------------------------------------------------

def _text(content: Column) -> Column:
    return F.decode(F.encode(content.cast("string"), "UTF-8"), "UTF-8")


def _is_json(text: Column) -> Column:
    return F.get_json_object(text, "$").isNotNull()


def weather_records(rows: DataFrame, source: str) -> DataFrame:
    """B4."""
    polls = rows.withColumn("response", br.parse_weather_response(F.col("text")))
    return br.expand_weather(polls, source=source, keep=("captured_at",))


def road_records(rows: DataFrame, source: str) -> DataFrame:
    """B7."""
    parsed = rows.withColumn("elements", F.from_json("text", br.ROAD_RESPONSE)["elements"])
    return br.expand_road_elements(parsed, source=source, keep=("captured_at",))


def alert_records(rows: DataFrame, source: str) -> DataFrame:
    """Every body has its own header line."""
    out = br.expand_alert_bodies(rows, "text", source=source, keep=("captured_at", "endpoint"))
    return out.withColumn("payload", F.struct(F.col("endpoint").alias("source_url"), "row"))


def capture_records(rows: DataFrame, source: str) -> DataFrame:
    """B5."""
    cols = br.capture_columns(F.col("content"), source, endpoint=F.col("endpoint"))
    names = [f.name for f in schemas.CAPTURE_PAYLOAD.fields]
    return rows.select("captured_at", cols["event_id"].alias("event_id"),
                       F.struct(*[cols[n].alias(n) for n in names]).alias("payload"))


@dataclass(frozen=True)
class Collector:
    """How a domain's bodies become records (captured_at, event_id, payload)."""

    source: str
    payload: object
    records: Callable[[DataFrame, str], DataFrame]
    json_body: bool = True


COLLECTORS = {
    "weather": Collector(WEATHER_SOURCE, schemas.WEATHER_PAYLOAD, weather_records),
    "traffic": Collector(TRAFFIC_CAPTURE_SOURCE, schemas.CAPTURE_PAYLOAD, capture_records, json_body=False),
    "alerts": Collector(ALERTS_SOURCE, schemas.ALERT_PAYLOAD, alert_records, json_body=False),
    "roads": Collector(ROADS_SOURCE, schemas.ROAD_PAYLOAD, road_records),
}


def select_domains(names: Iterable[str] | None = None) -> list[str]:
    """The given domains, all by default; an unknown one is an error."""
    names = list(names or COLLECTORS)
    unknown = [n for n in names if n not in COLLECTORS]
    if unknown:
        raise ValueError(f"unknown domain(s): {', '.join(unknown)}")
    return names


def envelopes(rows: DataFrame, domain: str, author: str) -> DataFrame:
    """B1 over a domain's captures, batch or stream; static domains are gated
    by the caller."""
    spec = COLLECTORS[domain]
    records = spec.records(rows.withColumn("text", _text(F.col("content"))), spec.source)
    return br.build_envelope(records, spec.source, author, F.col("payload"), event_id=F.col("event_id"),
                             ingested_at=F.col("captured_at"))


def usable(rows: DataFrame, domain: str) -> DataFrame:
    """Captures whose body can be read."""
    return rows.where(_is_json(_text(F.col("content")))) if COLLECTORS[domain].json_body else rows


# ---- streams ----------------------------------------------------------------

def collect_domain(spark: SparkSession, landing_dir: str, root: str, domain: str, author: str,
                   interval_seconds: int = POLL_INTERVAL_SECONDS, layout: str = "files",
                   max_files_per_trigger: int | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Start a domain's stream from landed bodies to the Bronze layer."""
    if domain in STATIC_DOMAINS:
        # A key an hour needs few state partitions; the caller's setting stays.
        spark = configure(spark.newSession())
        spark.conf.set("spark.sql.shuffle.partitions", STATE_PARTITIONS)
        use_rocksdb_state(spark)
    rows = usable(captures(spark, landing_dir, layout, max_files_per_trigger), domain)
    if domain in STATIC_DOMAINS:
        rows = first_of_each_hour(rows)
    return append_bronze(envelopes(rows, domain, author), capture_root(root), domain, COLLECTORS[domain].source,
                         f"{checkpoint_root(spark, checkpoint)}/bodies/{domain}", f"collect_{domain}",
                         interval_seconds)


def collect_all(spark: SparkSession, landing_root: str, root: str, author: str,
                domains: Iterable[str] | None = None, interval_seconds: int = POLL_INTERVAL_SECONDS,
                layout: str = "files", checkpoint: str | None = None,
                ) -> tuple[dict[str, StreamingQuery], dict[str, str]]:
    """One independent stream per domain over ``<landing_root>/<domain>``.

    Returns the started queries and, for domains that could not start, the error."""
    names = select_domains(domains)
    checkpoint_root(spark, checkpoint)
    return start_each({
        name: (lambda name=name: collect_domain(
            spark, f"{landing_root.rstrip('/')}/{name}", root, name, author, interval_seconds, layout,
            checkpoint=checkpoint))
        for name in names
    })
