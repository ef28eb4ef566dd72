"""Event identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def stable_event_id(source: str | Column, natural_key: Column) -> Column:
    """``<source>-<first 16 hex digits of sha1("<source>:<key>")>``.

    Deterministic, so re-ingesting the same observation yields the same id and
    Silver can deduplicate it."""
    src = _lit(source)
    digest = F.sha1(F.concat(src, F.lit(":"), natural_key))
    return F.concat(src, F.lit("-"), F.substring(digest, 1, 16))


def random_event_id(source: str | Column) -> Column:
    """``<source>-<uuid4 hex>`` for records without a natural key.

    Nondeterministic: materialise (write or checkpoint) before using it twice."""
    return F.concat(_lit(source), F.lit("-"), F.regexp_replace(F.expr("uuid()"), "-", ""))
