"""Silver operators: Bronze weather envelopes -> typed, valid, unique rows.

Each operator is a pure ``DataFrame -> DataFrame`` function; ``silver_weather``
composes them in the source pipeline's order (stamp, flatten, null reject,
domain filter, time filter, dedup). Filters are plain comparisons, so Catalyst
combines them into one ``Filter`` and pushes what it can into the scan.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (
    EPOCH_LOWER_BOUND,
    OBSERVED_AT_FORMAT,
    WEATHER_RANGES,
    WEATHER_REQUIRED_FIELDS,
)
from ..functions import try_parse_ts

_DOUBLES = (
    ("latitude", "payload.latitude"),
    ("longitude", "payload.longitude"),
    ("elevation_m", "payload.elevation_m"),
    ("temperature_2m", "payload.metrics.temperature_2m"),
    ("relative_humidity_2m", "payload.metrics.relative_humidity_2m"),
    ("precipitation", "payload.metrics.precipitation"),
    ("wind_speed_10m", "payload.metrics.wind_speed_10m"),
    ("wind_direction_10m", "payload.metrics.wind_direction_10m"),
    ("surface_pressure", "payload.metrics.surface_pressure"),
)


def stamp_producer(df: DataFrame, producer: str) -> DataFrame:
    """V1: overwrite the ``author`` (producer/tenant) column with a constant."""
    return df.withColumn("author", F.lit(producer))


def flatten_weather(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """V2: nested payload -> 16 typed columns (+ ``carry`` passthrough columns).

    ANSI-safe: ``try_cast`` and ``try_to_timestamp`` turn bad input into null,
    which the null reject then drops, instead of failing the job."""
    return df.select(
        F.col("event_id"),
        F.col("author"),
        F.col("source"),
        F.col("schema_v").try_cast("int").alias("schema_v"),
        F.col("ingest_ts"),
        try_parse_ts(F.col("payload.observed_at"), OBSERVED_AT_FORMAT).alias("event_ts"),
        F.trim(F.col("payload.city")).alias("city"),
        *[F.col(path).try_cast("double").alias(name) for name, path in _DOUBLES],
        *carry,
    )


def required_present(fields: Iterable[str] = WEATHER_REQUIRED_FIELDS) -> Column:
    return reduce(and_, [F.col(f).isNotNull() for f in fields])


def reject_nulls(df: DataFrame, fields: Iterable[str] = WEATHER_REQUIRED_FIELDS) -> DataFrame:
    """V3: keep rows where every required field is non-null (NaN is kept,
    unlike ``dropna``; the domain filter handles NaN)."""
    return df.filter(required_present(fields))


def domain_condition(producer: str | None = None) -> Column:
    """V4 predicate: inclusive physical ranges; NaN fails explicitly because
    Spark's ``NaN >= 0`` is true."""
    def valid(name: str, low: float, high: float | None) -> Column:
        c = F.col(name)
        return (c >= low) & ~F.isnan(c) if high is None else c.between(low, high)

    cond = reduce(and_, [valid(*r) for r in WEATHER_RANGES])
    if producer is not None:
        cond = (F.col("author") == producer) & cond
    return cond


def domain_filter(df: DataFrame, producer: str | None = None) -> DataFrame:
    """V4."""
    return df.filter(domain_condition(producer))


def time_condition(ts_col: str = "event_ts", as_of: str | None = None) -> Column:
    """V5 predicate: not null, strictly after 1971-01-01, not after ``as_of``
    (default: the query's ``current_timestamp()``; pass ``as_of`` for
    reproducible reruns)."""
    upper = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    ts = F.col(ts_col)
    return ts.isNotNull() & (ts > F.lit(EPOCH_LOWER_BOUND).cast("timestamp")) & (ts <= upper)


def time_filter(df: DataFrame, ts_col: str = "event_ts", as_of: str | None = None) -> DataFrame:
    """V5."""
    return df.filter(time_condition(ts_col, as_of))


def dedup_events(df: DataFrame, key: str = "event_id",
                 order_by: Sequence[str] = ("ingest_ts",)) -> DataFrame:
    """V6: one row per ``key`` — the first by ``order_by`` (deterministic).

    ``row_number() == 1`` plans a map-side ``WindowGroupLimit``: each task
    ships at most one row per key into the shuffle, so a key holding a third
    of all rows costs one row per task, not a third of the data in one task."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def rebalance(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """V8: output partitioning. Default is a ``REBALANCE`` hint, which AQE
    turns into evenly sized output files (and splits skew); an explicit
    ``partitions`` reproduces the fixed round-robin ``repartition(n)``."""
    if partitions is not None:
        return df.repartition(partitions)
    return df.hint("rebalance")


def silver_weather(bronze: DataFrame, producer: str | None = None, restamp: bool = False,
                   as_of: str | None = None, order_by: Sequence[str] = ("ingest_ts",),
                   carry: Sequence[str] = ()) -> DataFrame:
    """V9: stamp? -> flatten -> null reject -> domain -> time -> dedup.

    ``producer`` filters on the recorded author. ``restamp=True`` reproduces
    the source pipeline, which overwrites the author first (so its author
    filter can never reject a row)."""
    return dedup_events(valid_weather(bronze, producer, restamp, as_of, carry), order_by=order_by)


def valid_weather(bronze: DataFrame, producer: str | None = None, restamp: bool = False,
                  as_of: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """The row-wise steps of V9: everything but the dedup, so no shuffle."""
    df = stamp_producer(bronze, producer) if (restamp and producer is not None) else bronze
    return (flatten_weather(df, carry)
            .transform(reject_nulls)
            .transform(lambda d: domain_filter(d, producer))
            .transform(lambda d: time_filter(d, as_of=as_of)))


# ---- V7: reject accounting --------------------------------------------------

REJECT_REASONS = ("null_field", "out_of_range", "bad_timestamp", "duplicate", "valid")


def reject_report(flat: DataFrame, producer: str | None = None, as_of: str | None = None,
                  key: str = "event_id") -> DataFrame:
    """Per-reason row counts: ``null_field``, ``out_of_range``,
    ``bad_timestamp``, ``duplicate``, ``valid`` (summing to the raw count).

    No window: rows are first counted per (reason, id) — partial aggregation
    collapses a hot id to one row per task — then per reason. Among rows
    passing every rule, ``valid`` is the number of distinct ids and
    ``duplicate`` the rest, which is what the dedup removes."""
    present = required_present()
    in_range = F.coalesce(domain_condition(producer), F.lit(False))
    timely = F.coalesce(time_condition(as_of=as_of), F.lit(False))
    reason = (F.when(~present, F.lit("null_field"))
              .when(~in_range, F.lit("out_of_range"))
              .when(~timely, F.lit("bad_timestamp"))
              .otherwise(F.lit("passed")))
    per_id = (flat.select(reason.alias("reason"),
                          F.when(reason == "passed", F.col(key)).alias("_id"))
              .groupBy("reason", "_id").agg(F.count(F.lit(1)).alias("n")))
    per_reason = per_id.groupBy("reason").agg(F.sum("n").alias("rows"),
                                              F.count(F.lit(1)).alias("ids"))
    out = per_reason.select(
        F.explode(F.when(F.col("reason") == "passed",
                         F.array(F.struct(F.lit("valid").alias("r"), F.col("ids").alias("c")),
                                 F.struct(F.lit("duplicate").alias("r"),
                                          (F.col("rows") - F.col("ids")).alias("c"))))
                  .otherwise(F.array(F.struct(F.col("reason").alias("r"),
                                              F.col("rows").alias("c"))))).alias("x"))
    return (out.select(F.col("x.r").alias("reject_reason"), F.col("x.c").alias("rows"))
               .filter(F.col("rows") > 0))


def latest_per_key(df: DataFrame, key: str = "event_id",
                   order_desc: Sequence[str] = ("ingest_ts",)) -> DataFrame:
    """Cross-run dedup on read: keep the newest row per ``key`` when several
    Silver runs hold the same event (a rerun re-reads all of Bronze).

    Same skew-safe shape as ``dedup_events`` (map-side group limit)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order_desc])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))
