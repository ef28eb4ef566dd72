"""Composed jobs: the layer runs a scheduler (or a person) invokes.

* ``run_silver``  Bronze files -> Silver run directory, counts via ``observe``
* ``run_gold``    Silver (all runs, deduplicated) -> selected Gold metrics
* ``build_datasets``  Silver traffic + weather -> probe and road datasets
* ``train``       datasets -> metrics table, predictions, cluster centers

Each job is one pass per output: counts are observed during the write
instead of separate ``count()`` actions, and a shared input is projected to
the needed columns before it is persisted.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field
from typing import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .. import schemas
from ..session import configure
from ..constants import KPT_CONGESTION_KMH
from ..operators import features as fe
from ..operators import gold, silver
from ..operators.ml import classification as mc
from ..operators.ml import clustering as mk
from ..operators.ml import prep as mp
from ..operators.ml import regression as mr
from ..sinks import writers as W
from ..sinks.manifest import committed
from ..sources.bronze import read_bronze
from ..sources.silver import RUN_COL, read_silver

log = logging.getLogger("aeolus.jobs")


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


# ---- Silver ---------------------------------------------------------------------

@dataclass
class SilverResult:
    run_id: str
    path: str | None
    raw_rows: int
    valid_rows: int

    @property
    def rejected_rows(self) -> int:
        return self.raw_rows - self.valid_rows


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str, source: str,
               producer: str | None = None, restamp: bool = False, as_of: str | None = None,
               run_id: str | None = None, fmt: str = "parquet",
               partitions: int | None = None) -> SilverResult:
    """V9 + K2 in one job. Raw and valid counts are observed metrics of the
    write itself. Without a valid row nothing is written: the first valid row
    ends that look, so it costs a scan only when there is none."""
    run_id = run_id or new_run_id()
    # Observations run in a child session (same SparkContext and cache): in
    # Spark 4.1, using an ``Observation`` leaves the session holding a
    # non-serializable ObservationManager, after which any fitted
    # ``pyspark.ml`` model's transform in that session fails with "Task not
    # serializable". The caller's session stays clean.
    spark = configure(spark.newSession())
    raw_obs, valid_obs = Observation("raw"), Observation("valid")
    bronze = read_bronze(spark, bronze_root, "weather", source, schemas.WEATHER_ENVELOPE)
    if silver.valid_weather(bronze, producer, restamp, as_of).isEmpty():
        raw = bronze.count()
        log.warning("silver run %s: none of %d rows is valid; nothing written", run_id, raw)
        return SilverResult(run_id, None, raw, 0)
    bronze = bronze.observe(raw_obs, F.count(F.lit(1)).alias("rows"))
    out = silver.silver_weather(bronze, producer=producer, restamp=restamp, as_of=as_of)
    out = out.observe(valid_obs, F.count(F.lit(1)).alias("rows"))
    path = W.write_silver(out, silver_root, "weather", source, run_id, fmt, partitions)
    raw, valid = raw_obs.get["rows"], valid_obs.get["rows"]
    log.info("silver run %s: raw=%d valid=%d rejected=%d", run_id, raw, valid, raw - valid)
    return SilverResult(run_id, path, raw, valid)


# ---- Gold -----------------------------------------------------------------------

@dataclass
class GoldResult:
    run_id: str
    silver_rows: int
    paths: dict[str, str] = field(default_factory=dict)


def silver_for_gold(spark: SparkSession, silver_root: str, source: str,
                    producer: str | None = None, dedup_runs: bool = True,
                    fmt: str = "parquet") -> DataFrame:
    """S2 + P2: all runs, one row per event (the latest run wins: runs are
    ordered by ingest time, then by file modification time). Of a layer kept by
    incremental runs, what they committed, as a full run would have it."""
    if dedup_runs and not committed(spark, silver_root, "weather", source).isEmpty():
        from .incremental import current_silver
        df = current_silver(spark, silver_root, source)
        return df if producer is None else df.filter(F.col("author") == producer)
    df = read_silver(spark, silver_root, "weather", source, fmt)
    if producer is not None:
        df = df.filter(F.col("author") == producer)
    if dedup_runs:
        df = df.withColumn("_file_mtime", F.col("_metadata.file_modification_time"))
        df = silver.latest_per_key(df, "event_id", ("ingest_ts", "_file_mtime")).drop("_file_mtime")
    return df


def run_gold(spark: SparkSession, silver_root: str, gold_root: str, source: str,
             producer: str, metrics: Iterable[str] | None = None, run_id: str | None = None,
             fmt: str = "parquet", dedup_runs: bool = True) -> GoldResult:
    """G6 + G7 + G8 + K3: one pruned, persisted Silver scan feeds every
    selected metric; an empty Silver aborts without writes."""
    plan = gold.select_metrics("weather", metrics)
    run_id = run_id or new_run_id()
    base = silver_for_gold(spark, silver_root, source, producer, dedup_runs, fmt)
    shared = base.select(*gold.needed_columns(plan)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = shared.count()
        result = GoldResult(run_id, rows)
        if rows == 0:
            log.warning("no Silver rows for producer=%s; nothing written", producer)
            return result
        frames: dict[str, DataFrame] = {}
        fused: list[DataFrame] = []
        # Metrics of one level come from one aggregation, kept if several read it.
        for names in gold.shared_levels(plan):
            base = gold.aggregate(shared, names)
            if len(names) > 1:
                fused.append(base.persist(StorageLevel.MEMORY_AND_DISK))
            frames.update({n: gold.output(base, n) for n in names})
        try:
            for name, m in plan.items():
                out = gold.finalize_metric(frames[name], producer, run_id, name)
                result.paths[name] = W.write_gold(out, gold_root, "weather", name, run_id,
                                                  m.partition_cols, fmt)
        finally:
            for base in fused:
                base.unpersist()
        return result
    finally:
        shared.unpersist()


def one_per_event(df: DataFrame) -> DataFrame:
    """P2 for dataset inputs: rerunning a layer adds a run with the same
    events, which must count once. Rows are told apart by ``event_id`` where
    the feed has one (the latest ingest wins). Without one, equal rows of a run
    are readings of their own (two vehicles in one place); a run that repeats
    them adds nothing, so each row counts as often as the run that has it most
    often. ``_run`` (``read_silver_recursive(runs=True)``) names the run."""
    if "event_id" in df.columns:
        order = ("ingest_ts",) if "ingest_ts" in df.columns else ("event_id",)
        return silver.latest_per_key(df.drop(RUN_COL), "event_id", order)
    if RUN_COL not in df.columns:
        return df
    columns = [c for c in df.columns if c != RUN_COL]
    per_run = df.groupBy(*columns, RUN_COL).agg(F.count(F.lit(1)).alias("_n"))
    most = per_run.groupBy(*columns).agg(F.max("_n").alias("_n"))
    return most.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select(*columns)


# ---- datasets ---------------------------------------------------------------------

def build_datasets(probes: DataFrame, roads: DataFrame, weather_frames: list[DataFrame],
                   time_from: str | None, time_to: str | None,
                   kpt_threshold: float = KPT_CONGESTION_KMH, hourly: DataFrame | None = None,
                   **cell_options) -> tuple[DataFrame, DataFrame]:
    """Probe cells and road readings, each joined to the hourly weather
    of the same range. ``hourly`` is that weather where it has been written
    (``sinks.write_hourly``), so that the two datasets don't each compute it."""
    if hourly is None:
        hourly = fe.hourly_weather(fe.union_weather(weather_frames), time_from=time_from,
                                   time_to=time_to)
    cells = fe.probe_cells(probes, time_from=time_from, time_to=time_to,
                           threshold_kmh=kpt_threshold, **cell_options)
    readings = fe.road_readings(roads, time_from=time_from, time_to=time_to)
    return (fe.join_weather(cells, hourly, time_from, time_to),
            fe.join_weather(readings, hourly, time_from, time_to))


# ---- training -------------------------------------------------------------------

def _rows(section: str, dataset: str, model: str, values: dict) -> list[tuple]:
    return [(section, dataset, model, k, None if v is None else float(v)) for k, v in values.items()]


def train(spark: SparkSession, dataset: DataFrame, spec: mp.DatasetSpec, key: str,
          author: str, out_root: str | None = None, ks=mk.K_CANDIDATES,
          restarts_search: int = mk.KMEANS_RESTARTS_SEARCH,
          restarts_final: int = mk.KMEANS_RESTARTS_FINAL) -> DataFrame:
    """M1-M24 for one dataset. Returns the long metrics table; with
    ``out_root`` also writes metrics (K6), predictions (K5), centers (K7)."""
    rows: list[tuple] = []
    with mp.prepare(dataset, spec, key) as p:
        y = spec.regression_target
        counts = p.data.agg(F.count(F.lit(1)).alias("n"),
                            F.count(F.when(~F.col("is_test"), 1)).alias("train"),
                            F.avg(F.when(~F.col("is_test"), F.col(spec.classification_target)))
                            .alias("pos")).first()
        summary = {"rows_total": counts["n"], "rows_train": counts["train"],
                   "rows_test": counts["n"] - counts["train"],
                   "feature_count": len(p.feature_names)}
        rows += _rows("regression", spec.name, "summary", summary)
        rows += _rows("regression", spec.name, "baseline_mean",
                      mr.baseline_scores(p, y).drop("rows").first().asDict())
        for model in mr.MODELS:
            sc = mr.model_scores(p, y, model).drop("model", "rows").first().asDict()
            rows += _rows("regression", spec.name, model, sc)

        label = spec.classification_target
        lr = mc.fit_logistic(p, label)
        test = mc.score(lr, p.data.filter(F.col("is_test"))).withColumnRenamed(
            label, "is_congested_actual")
        cls = mc.classification_scores(test).first().asDict()
        cls["roc_auc"] = mc.roc_auc(test)
        rows += _rows("classification", spec.name, "logistic_regression",
                      {**cls, "positive_rate_train": counts["pos"]})
        preds = mc.predictions_table(lr, p, label, author)
        if out_root:
            W.write_predictions(preds, f"{out_root}/predictions_{spec.name}")

    points = mk.congested_points(dataset, spec)
    res = mk.cluster(points, ks, restarts_search, restarts_final)
    if res.get("skipped"):
        rows += _rows("kmeans", spec.name, "kmeans", {"skipped": 1.0, "rows": res["rows"]})
    else:
        try:
            for e in res["evaluations"]:
                rows += _rows("kmeans", spec.name, f"k={e['k']}",
                              {"inertia": e["inertia"], "silhouette": e["silhouette"]})
            rows += _rows("kmeans", spec.name, "final",
                          {"best_k": res["best_k"], "silhouette": res["silhouette"],
                           "inertia": res["inertia"]})
            if out_root:
                centers = mk.centers_from_labels(res["labelled"]).withColumn(
                    "dataset", F.lit(spec.name))
                W.write_centers(centers, f"{out_root}/kmeans_centers_{spec.name}")
        finally:
            res["data"].unpersist()

    metrics = spark.createDataFrame(rows, schemas.METRICS_LONG)
    if out_root:
        W.write_metrics(metrics, f"{out_root}/metrics")
    return metrics
