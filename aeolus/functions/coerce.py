"""Lenient numeric coercion: bad input becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN -> null. Spark orders NaN above every number (``NaN > 0`` is true),
    so NaN must be nulled before range filters."""
    x = _c(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def lenient_double(c: str | Column) -> Column:
    return nan_to_null(_c(c).try_cast("double"))
