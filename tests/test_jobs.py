"""Composed jobs over files: Bronze -> Silver -> Gold, reruns, sinks."""

import os

from pyspark.sql import functions as F

from aeolus.plans import jobs
from aeolus.sinks import write_bronze, write_metrics
from aeolus.sources import fixtures as fx
from aeolus.sources.silver import read_silver
from conftest import SF001


def _bronze(spark, root):
    env = fx.weather_bronze(fx.read_table(spark, SF001, "events")).drop("src_id")
    write_bronze(env, root, "weather", "open_meteo_current")


def test_silver_then_gold_with_rerun(spark, tmp_dir):
    bronze, silver_root, gold_root = (os.path.join(tmp_dir, d) for d in ("b", "s", "g"))
    _bronze(spark, bronze)
    r1 = jobs.run_silver(spark, bronze, silver_root, "open_meteo_current", producer="fixture",
                         run_id="1234e5678901")
    assert (r1.raw_rows, r1.valid_rows, r1.rejected_rows) == (1000, 972, 28)
    r2 = jobs.run_silver(spark, bronze, silver_root, "open_meteo_current", producer="fixture")
    assert r2.valid_rows == 972

    # A numeric-looking run id stays a string on re-read.
    both = read_silver(spark, silver_root, "weather", "open_meteo_current")
    assert dict(both.dtypes)["run_id"] == "string"
    assert "1234e5678901" in {r.run_id for r in both.select("run_id").distinct().collect()}
    assert both.count() == 1944

    # Gold deduplicates across runs by default; without it counts double.
    g = jobs.run_gold(spark, silver_root, gold_root, "open_meteo_current", "fixture",
                      metrics=["temperature_hourly", "precipitation_daily"], run_id="g1")
    assert g.silver_rows == 972
    th = spark.read.parquet(g.paths["temperature_hourly"])
    assert th.agg(F.sum("samples_cnt")).first()[0] == 972
    assert set(th.columns) >= {"window_date", "window_hour", "author", "run_id", "metric_name"}
    assert dict(th.dtypes)["window_hour"] == "string"

    # Rerunning the same Gold run overwrites its partitions (idempotent).
    jobs.run_gold(spark, silver_root, gold_root, "open_meteo_current", "fixture",
                  metrics=["temperature_hourly"], run_id="g1")
    assert spark.read.parquet(g.paths["temperature_hourly"]).agg(
        F.sum("samples_cnt")).first()[0] == 972

    dup = jobs.run_gold(spark, silver_root, gold_root, "open_meteo_current", "fixture",
                        metrics=["temperature_hourly"], run_id="g2", dedup_runs=False)
    assert dup.silver_rows == 1944


def test_gold_aborts_on_empty_silver(spark, tmp_dir):
    bronze, silver_root, gold_root = (os.path.join(tmp_dir, d) for d in ("b", "s", "g"))
    _bronze(spark, bronze)
    jobs.run_silver(spark, bronze, silver_root, "open_meteo_current", producer="fixture")
    g = jobs.run_gold(spark, silver_root, gold_root, "open_meteo_current", "nobody")
    assert g.silver_rows == 0 and g.paths == {}


def test_metrics_sections_upsert(spark, tmp_dir):
    path = os.path.join(tmp_dir, "metrics")
    schema = "section string, dataset string, model string, metric string, value double"
    write_metrics(spark.createDataFrame([("regression", "kpt", "ols", "mae", 1.0),
                                         ("kmeans", "kpt", "final", "best_k", 3.0)], schema), path)
    write_metrics(spark.createDataFrame([("regression", "kpt", "ols", "mae", 2.0)], schema), path)
    rows = {(r.section, r.metric): r.value for r in spark.read.parquet(path).collect()}
    assert rows == {("regression", "mae"): 2.0, ("kmeans", "best_k"): 3.0}


def test_source_registry_skips_unreadable(spark, tmp_dir):
    import pytest
    from aeolus.sources.silver import load_sources
    good = spark.createDataFrame([(1,)], "x int")
    got = load_sources({"missing": lambda: spark.read.parquet(os.path.join(tmp_dir, "nope")),
                        "good": lambda: good})
    assert list(got) == ["good"]
    with pytest.raises(RuntimeError):
        load_sources({"missing": lambda: spark.read.parquet(os.path.join(tmp_dir, "nope"))})


def test_road_files_with_conflicting_types(spark, tmp_dir):
    from aeolus.sources.silver import read_road_files
    a = spark.createDataFrame([("r1", "40.5", 1.0)], "road_id string, current_speed_kmh string, confidence double")
    b = spark.createDataFrame([("r2", 55.0, 0.5)], "road_id string, current_speed_kmh double, confidence double")
    a.write.parquet(os.path.join(tmp_dir, "run1"))
    b.write.parquet(os.path.join(tmp_dir, "run2"))
    out = read_road_files(spark, tmp_dir)
    assert dict(out.dtypes)["current_speed_kmh"] == "double"
    assert sorted(r.current_speed_kmh for r in out.collect()) == [40.5, 55.0]


def test_optional_outputs(spark, tmp_dir):
    from aeolus.sources.silver import read_optional
    spark.createDataFrame([(1,)], "x int").write.parquet(os.path.join(tmp_dir, "kpt"))
    got = read_optional(spark, {"kpt": os.path.join(tmp_dir, "kpt"),
                                "tomtom": os.path.join(tmp_dir, "tomtom")})
    assert list(got) == ["kpt"]


def test_train_writes_all_outputs(spark, tmp_dir):
    from aeolus.operators.ml import prep as mp
    from aeolus.plans.catalog import ML_KEY, ml_dataset
    from aeolus.sources.silver import read_centers, read_optional
    from conftest import SF01
    out = os.path.join(tmp_dir, "reports")
    metrics = jobs.train(spark, ml_dataset(spark, SF01), mp.ROAD_SPEC, ML_KEY, "fixture", out,
                         ks=(2, 3), restarts_search=2, restarts_final=2)
    got = {(r.section, r.model, r.metric) for r in metrics.collect()}
    assert ("regression", "ridge", "r2") in got and ("classification", "logistic_regression", "roc_auc") in got
    assert ("kmeans", "final", "best_k") in got
    stored = spark.read.parquet(os.path.join(out, "metrics"))
    assert stored.select("section").distinct().count() == 3
    preds = read_optional(spark, {"tomtom": os.path.join(out, "predictions_tomtom")})["tomtom"]
    assert set(preds.columns) >= {"event_hour", "is_congested_pred", "congestion_proba", "author"}
    centers = read_centers(spark, os.path.join(out, "kmeans_centers_tomtom"))
    assert centers.count() in (2, 3) and centers.first().dataset == "tomtom"


def test_write_dataset_respects_existing(spark, tmp_dir):
    from aeolus.sinks import write_dataset
    path = os.path.join(tmp_dir, "ds")
    write_dataset(spark.createDataFrame([(1,)], "x int"), path, "me")
    write_dataset(spark.createDataFrame([(2,), (3,)], "x int"), path, "me")
    assert spark.read.parquet(path).count() == 1
    write_dataset(spark.createDataFrame([(2,), (3,)], "x int"), path, "me", force=True)
    assert spark.read.parquet(path).count() == 2


def test_silver_observation_does_not_break_models(spark, tmp_dir):
    """A Silver run (which observes counts) followed by model scoring in the
    same session must work."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    bronze, silver_root = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    _bronze(spark, bronze)
    jobs.run_silver(spark, bronze, silver_root, "open_meteo_current", producer="fixture")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(50).select((F.col("id") / 10.0).alias("x"), (F.col("id") % 2).cast("double").alias("y")))
    model = LogisticRegression(labelCol="y", maxIter=5).fit(data)
    assert len(model.transform(data).select("probability").collect()) == 50


def test_cli_silver_and_gold(spark, tmp_dir):
    """The layer commands run end to end in their own process."""
    import subprocess
    import sys
    bronze, silver_root, gold_root = (os.path.join(tmp_dir, d) for d in ("b", "s", "g"))
    _bronze(spark, bronze)
    base = [sys.executable, "-m", "aeolus.plans.cli", "--master", "local[2]"]
    cwd = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(base + ["silver", "--bronze", bronze, "--silver", silver_root,
                                 "--producer", "fixture"], cwd=cwd, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "raw=1000 valid=972" in out.stdout
    bad = subprocess.run(base + ["gold", "--silver", silver_root, "--gold", gold_root,
                                 "--producer", "fixture", "--metrics", "nope"], cwd=cwd,
                         capture_output=True, text=True, timeout=600)
    assert bad.returncode == 1
    ok = subprocess.run(base + ["gold", "--silver", silver_root, "--gold", gold_root,
                                "--producer", "fixture", "--metrics", "wind_daily_extremes"],
                        cwd=cwd, capture_output=True, text=True, timeout=600)
    assert ok.returncode == 0, ok.stderr[-2000:]
    assert "silver_rows=972" in ok.stdout


def test_build_datasets_matches_registered_joins(spark):
    """The composed build gives the same datasets as the registered
    queries (574 probe cells and 4,848 road readings at sf0.01)."""
    from aeolus.plans.catalog import _probes, _roads, weather_frames
    from conftest import SF01
    kpt, road = jobs.build_datasets(_probes(spark, SF01), _roads(spark, SF01),
                                    weather_frames(spark, SF01), fx.FIXTURE_TIME_FROM,
                                    fx.FIXTURE_TIME_TO)
    assert kpt.count() == 574
    assert road.count() == 4848
    assert {"temp_c", "precip_mm", "wind_mps", "humidity_pct", "direction_bucket"} <= set(kpt.columns)


def test_gold_all_metrics_with_fused_pairs(spark, tmp_dir):
    bronze, silver_root, gold_root = (os.path.join(tmp_dir, d) for d in ("b", "s", "g"))
    _bronze(spark, bronze)
    jobs.run_silver(spark, bronze, silver_root, "open_meteo_current", producer="fixture")
    g = jobs.run_gold(spark, silver_root, gold_root, "open_meteo_current", "fixture", run_id="all")
    counts = {n: spark.read.parquet(p).count() for n, p in g.paths.items()}
    assert counts == {"temperature_hourly": 851, "comfort_index_hourly": 851,
                      "precipitation_daily": 149, "wind_daily_extremes": 149,
                      "subzero_hours_daily": 149}
    th = spark.read.parquet(g.paths["comfort_index_hourly"])
    assert set(th.columns) >= {"comfort_index_c", "humidity_avg_pct", "metric_name"}


def test_cli_datasets_and_train(spark, tmp_dir):
    """Silver layout as the jobs write it -> `datasets` -> `train`."""
    import subprocess
    import sys
    from aeolus.sources.silver import silver_root
    from conftest import SF01
    root, out, reports = (os.path.join(tmp_dir, d) for d in ("silver", "datasets", "reports"))
    ev = fx.read_table(spark, SF01, "events")
    bronze = os.path.join(tmp_dir, "bronze")
    write_bronze(fx.weather_bronze(ev).drop("src_id"), bronze, "weather", "open_meteo_current")
    jobs.run_silver(spark, bronze, root, "open_meteo_current", producer="fixture")
    for domain, source, frame in (("weather", "open_meteo_api", fx.weather_api_feed(ev)),
                                  ("weather", "openweathermap_api", fx.owm_feed(ev)),
                                  ("traffic", "kpt_socketio", fx.probe_traffic(ev)),
                                  ("traffic", "road_sensors", fx.road_traffic(ev))):
        frame.write.parquet(f"{silver_root(root, domain, source)}/run_id=r1")
    base = [sys.executable, "-m", "aeolus.plans.cli", "--master", "local[4]"]
    cwd = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run(base + ["datasets", "--silver", root, "--out", out,
                               "--time-from", fx.FIXTURE_TIME_FROM, "--time-to", fx.FIXTURE_TIME_TO],
                       cwd=cwd, capture_output=True, text=True, timeout=900)
    assert r.returncode == 0, r.stderr[-2000:]
    assert spark.read.parquet(os.path.join(out, "dataset_kpt")).count() == 574
    assert spark.read.parquet(os.path.join(out, "dataset_tomtom")).count() == 4848
    t = subprocess.run(base + ["train", "--datasets", out, "--out", reports, "--dataset", "tomtom"],
                       cwd=cwd, capture_output=True, text=True, timeout=1200)
    assert t.returncode == 0, t.stderr[-2000:]
    metrics = spark.read.parquet(os.path.join(reports, "metrics"))
    assert {r.section for r in metrics.select("section").distinct().collect()} == {
        "regression", "classification", "kmeans"}
