"""Time helpers: tolerant parsing, hour buckets, calendar features, ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import INGEST_DATE_FORMAT, INGEST_HOUR_FORMAT, PART_STAMP_FORMAT


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_parse_ts(c: str | Column, fmt: str | None = None) -> Column:
    """Parse to TIMESTAMP; unparsable or empty input gives null (ANSI-safe)."""
    if fmt is None:
        return F.try_to_timestamp(_c(c))
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def hour_bucket(c: str | Column) -> Column:
    return F.date_trunc("hour", _c(c))


def time_range_filter(c: str | Column, time_from: str | None, time_to: str | None) -> Column:
    """Half-open ``time_from <= c < time_to``; a missing bound is open."""
    cond = F.lit(True)
    if time_from is not None:
        cond = cond & (_c(c) >= F.lit(time_from).cast("timestamp"))
    if time_to is not None:
        cond = cond & (_c(c) < F.lit(time_to).cast("timestamp"))
    return cond


def calendar_features(ts: str | Column, week_start: str = "sunday") -> dict[str, Column]:
    """``hour_of_day``, ``day_of_week`` and ``is_weekend`` as ints.

    ``week_start="sunday"``: Sun=0 ... Sat=6 (probe dataset).
    ``week_start="monday"``: Mon=0 ... Sun=6 (road-sensor dataset)."""
    t = _c(ts)
    if week_start == "sunday":
        dow = F.dayofweek(t) - F.lit(1)
        weekend = F.dayofweek(t).isin(1, 7).cast("int")
    elif week_start == "monday":
        dow = F.weekday(t)
        weekend = (F.weekday(t) >= 5).cast("int")
    else:
        raise ValueError(f"week_start must be 'sunday' or 'monday', got {week_start!r}")
    return {"hour_of_day": F.hour(t), "day_of_week": dow, "is_weekend": weekend}


def partition_keys(ts: str | Column) -> dict[str, Column]:
    """Bronze hour-partition keys and file stamp from a UTC instant."""
    t = _c(ts)
    return {
        "ingest_date": F.date_format(t, INGEST_DATE_FORMAT),
        "hour": F.date_format(t, INGEST_HOUR_FORMAT),
        "part_stamp": F.date_format(t, PART_STAMP_FORMAT),
    }
