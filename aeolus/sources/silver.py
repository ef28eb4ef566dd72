"""Silver-layer scans (S2, S3, S4), the weather-source registry (S6) and the
model-output reads (S7)."""

from __future__ import annotations

import logging
from typing import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import SCHEMA_VERSION
from ..functions import lenient_double
from ..schemas import SILVER_WEATHER

log = logging.getLogger("aeolus.sources")


def silver_root(root: str, domain: str, source: str, schema_v: int = SCHEMA_VERSION) -> str:
    return f"{root.rstrip('/')}/domain={domain}/source={source}/schema_v={schema_v}"


def read_silver(spark: SparkSession, root: str, domain: str, source: str,
                fmt: str = "parquet") -> DataFrame:
    """Every ``run_id=`` directory of a Silver table. ``run_id`` stays a
    string column (partition type inference is off in ``session.configure``;
    ``run_id=123e4`` would otherwise become a double)."""
    reader = spark.read.format(fmt)
    if fmt == "json" and domain == "weather":
        reader = reader.schema(SILVER_WEATHER)  # JSON leaves out null fields
    return reader.load(silver_root(root, domain, source))


RUN_COL = "_run"


def _with_run(df: DataFrame, runs: bool) -> DataFrame:
    if not runs:
        return df
    return df.withColumn(RUN_COL, F.regexp_extract("_metadata.file_path", r"/run_id=([^/]+)/", 1))


def read_silver_recursive(spark: SparkSession, path: str, runs: bool = False) -> DataFrame:
    """S3: all Parquet files below ``path``; schemas merged across runs.
    (``recursiveFileLookup`` drops partition columns; ``runs`` adds the run that
    a row's file belongs to as ``_run``.)"""
    return _with_run(spark.read.option("recursiveFileLookup", "true")
                     .option("mergeSchema", "true").parquet(path), runs)


def read_hourly(spark: SparkSession, root: str) -> DataFrame:
    """The latest committed version of the hourly weather table, as a plain
    scan. A stream started on it keeps this version until it is started again."""
    from ..sinks.manifest import committed
    newest = (committed(spark, root, "weather", "hourly")
              .agg(F.max_by("run_id", "committed_at")).first()[0])
    if newest is None:
        raise ValueError(f"no version of the hourly weather table under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/hourly/run_id={newest}")


def read_road_files(spark: SparkSession, path: str,
                    numeric: Sequence[str] = ("current_speed_kmh", "free_flow_speed_kmh",
                                              "current_travel_time_s", "confidence"),
                    runs: bool = False) -> DataFrame:
    """Road-sensor Parquet files whose column types may disagree between
    files (a measure written as string in one run, double in another).

    Tries one merged scan; when Parquet refuses to merge, reads each file's
    group separately and unions by name after coercing the measures."""
    try:
        df = read_silver_recursive(spark, path, runs)
        df.schema  # noqa: B018 - forces footer merge
    except (PySparkException, Py4JJavaError) as exc:
        if "CANNOT_MERGE_SCHEMAS" not in str(exc):
            raise
        log.info("schema merge failed (%s); reading per schema group", str(exc)[:200])
        # File listing only (binaryFile prunes the content column); footers
        # are read once per file to group files by schema, then each group is
        # one scan — the union has one branch per distinct schema, not per file.
        files = [r.path for r in spark.read.format("binaryFile")
                 .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                 .load(path).select("path").collect()]
        groups: dict[str, list[str]] = {}
        for f in files:
            groups.setdefault(spark.read.parquet(f).schema.json(), []).append(f)
        frames = []
        for group in groups.values():
            part = _with_run(spark.read.parquet(*group), runs)
            part = part.withColumns({c: lenient_double(c) for c in numeric if c in part.columns})
            frames.append(part)
        if not frames:
            raise RuntimeError(f"no road-sensor Parquet files under {path}") from exc
        df = frames[0]
        for f in frames[1:]:
            df = df.unionByName(f, allowMissingColumns=True)
    return df.withColumns({c: lenient_double(c) for c in numeric if c in df.columns})


def load_sources(loaders: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Run each loader; a source that cannot be read (missing path,
    unreadable files) is logged and skipped; none at all is an error. Only
    ``AnalysisException`` is caught, so programming errors still surface."""
    out: dict[str, DataFrame] = {}
    for name, load in loaders.items():
        try:
            df = load()
            df.schema  # noqa: B018 - resolves the relation now
            out[name] = df
        except AnalysisException as exc:
            log.warning("skipping source %s: %s", name, str(exc)[:200])
    if not out:
        raise RuntimeError("no sources could be loaded")
    return out


def read_optional(spark: SparkSession, paths: Mapping[str, str],
                  fmt: str = "parquet") -> dict[str, DataFrame]:
    """Model outputs that may be absent (a dataset can be skipped)."""
    out = {}
    for name, path in paths.items():
        try:
            df = spark.read.format(fmt).load(path)
            df.schema  # noqa: B018
            out[name] = df
        except AnalysisException:
            log.warning("missing %s output at %s", name, path)
    return out


def read_centers(spark: SparkSession, path: str) -> DataFrame:
    """Cluster-center table (written by ``sinks.write_centers``) with the
    dataset tag; skipped datasets have no rows."""
    return spark.read.json(path).select(
        "dataset", F.col("cluster_id").cast("int"), "lat", "lon", "intensity_mean",
        F.col("size").cast("long"))
