"""Landed inputs: no shuffle on the way to files, lines compressed, every row there."""

import glob
import os

from pyspark.sql import functions as F

from aeolus.sources import fixtures as fx
from aeolus.sources import landing
from aeolus.streaming.ingest import append_bronze

SF_DIR = "/root/testdata/sf0.01"


def test_bronze_lands_compressed_in_the_order_of_its_scan(spark):
    path = landing.bronze_weather_path(spark, SF_DIR)
    path = path.removeprefix("file:")
    files = glob.glob(f"{path}/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    bronze = landing.bronze_weather(spark, SF_DIR).select("src_id", F.input_file_name().alias("file"))
    events = fx.read_table(spark, SF_DIR, "events")
    assert bronze.exceptAll(bronze.dropDuplicates(["src_id"])).isEmpty()
    assert bronze.count() == events.count()
    # A file holds a stretch of the table: rows were not dealt around before.
    spans = bronze.groupBy("file").agg(F.max("src_id") - F.min("src_id") + 1, F.count(F.lit(1)))
    assert all(span == n <= landing.LINES["maxRecordsPerFile"] for _, span, n in spans.collect())
    plain = fx.weather_bronze(events).select(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert sum(os.path.getsize(f) for f in files) < plain / 4


def test_streamed_bronze_is_compressed_and_whole(spark, tmp_dir):
    env = fx.weather_bronze(fx.read_table(spark, SF_DIR, "events")).drop("src_id")
    env.write.options(**landing.LINES).json(f"{tmp_dir}/landing")
    stream = spark.readStream.schema(env.schema).json(f"{tmp_dir}/landing")
    append_bronze(stream, f"{tmp_dir}/bronze", "weather", "s", f"{tmp_dir}/progress", "landing_test", 0).awaitTermination()
    files = glob.glob(f"{tmp_dir}/bronze/**/part-*", recursive=True)
    assert files and all(f.endswith(".json.gz") for f in files)
    back = spark.read.schema(env.schema).json(f"{tmp_dir}/bronze/domain=weather/source=s/schema_v=1").select(env.columns)
    assert back.count() == env.count()
    assert back.select("event_id", "ingest_ts", "payload.city").exceptAll(
        env.select("event_id", "ingest_ts", "payload.city")).isEmpty()
