"""Commit records: which runs of a layer readers may see.

A run's files are written first; the record is one small file, written last.
So a run that was killed leaves nothing visible, and its retry starts from the
same mark. The records stand beside the layer, below ``<root>/manifest``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "run_id string, mark string, raw_rows long, valid_rows long, written_rows long, committed_at string"


def manifest_path(root: str, domain: str, source: str) -> str:
    return f"{root.rstrip('/')}/manifest/domain={domain}/source={source}"


def commit(spark: SparkSession, root: str, domain: str, source: str, run_id: str, mark: str | None,
           raw_rows: int, valid_rows: int, written_rows: int) -> None:
    """Make a run visible. Committing a run again replaces its record."""
    now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds")
    row = spark.createDataFrame([(run_id, mark, raw_rows, valid_rows, written_rows, now)], RECORD)
    row.coalesce(1).write.mode("overwrite").json(f"{manifest_path(root, domain, source)}/run={run_id}")


def committed(spark: SparkSession, root: str, domain: str, source: str) -> DataFrame:
    """The records of a layer; none before its first committed run."""
    try:
        return spark.read.schema(RECORD).json(manifest_path(root, domain, source)).drop("run")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECORD)


def last_mark(spark: SparkSession, root: str, domain: str, source: str) -> str | None:
    """The newest mark of the committed runs."""
    return committed(spark, root, domain, source).agg(F.max("mark")).first()[0]
