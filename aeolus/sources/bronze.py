"""Bronze scans (S1): JSON Lines envelopes with an explicit schema.

No schema inference (one pass fewer, and required for streams). PERMISSIVE
mode: a malformed line becomes a row with only ``_corrupt_record`` set; the
Silver null reject drops it and ``quarantine`` keeps it for inspection.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import SCHEMA_VERSION
from ..schemas import CORRUPT_COL


def read_bronze_json(spark: SparkSession, path: str | list[str], schema: T.StructType,
                     base_path: str | None = None) -> DataFrame:
    """Scan envelope files. Pass the layer root (or ``base_path``) rather
    than a ``*/*`` glob so ``ingest_date``/``hour`` stay as (string)
    partition columns and hour filters prune directories."""
    reader = (spark.read.schema(schema)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COL))
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.json(path)


def bronze_root(root: str, domain: str, source: str, schema_v: int = SCHEMA_VERSION) -> str:
    """``<root>/domain=<d>/source=<s>/schema_v=<v>`` — the partitioned layer."""
    return f"{root.rstrip('/')}/domain={domain}/source={source}/schema_v={schema_v}"


def stream_root(root: str) -> str:
    """Where streaming ingest keeps its share of a Bronze layer."""
    return f"{root.rstrip('/')}/streamed"


def capture_root(root: str) -> str:
    """Where the streams over response bodies keep their share of a Bronze layer."""
    return f"{root.rstrip('/')}/captured"


def read_bronze(spark: SparkSession, root: str, domain: str, source: str,
                schema: T.StructType, newer_than: str | None = None,
                file_time: bool = False) -> DataFrame:
    """S1 over a Bronze layer: what ``sinks.write_bronze``, streaming ingest and
    the streams over bodies wrote. Each may be missing; all missing is an error.

    ``newer_than`` (a timestamp) keeps only files modified after it; other
    files are left out of the scan by their listing, not read. ``file_time``
    adds the files' modification time as ``_file_time``."""
    modified = F.col("_metadata.file_modification_time")
    found: list[DataFrame] = []
    missing: AnalysisException | None = None
    for base in (root, stream_root(root), capture_root(root)):
        try:
            scan = read_bronze_json(spark, bronze_root(base, domain, source), schema)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = exc
            continue
        if newer_than is not None:
            scan = scan.where(modified > F.lit(newer_than).cast("timestamp"))
        if file_time:
            scan = scan.withColumn("_file_time", modified)
        found.append(scan)
    if not found:
        raise missing
    out = found[0]
    for scan in found[1:]:
        out = out.unionByName(scan, allowMissingColumns=True)
    return out


def quarantine(bronze: DataFrame) -> DataFrame:
    """Malformed lines."""
    if CORRUPT_COL not in bronze.columns:
        return bronze.limit(0)
    # Spark rejects plans over raw JSON that reference only the corrupt
    # column, so the whole row is kept (the other columns are null anyway).
    return bronze.filter(F.col(CORRUPT_COL).isNotNull())
