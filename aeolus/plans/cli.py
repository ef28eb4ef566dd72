"""Command line for the layer jobs.

    python -m aeolus.plans.cli silver  --bronze ROOT --silver ROOT [--source S] [--producer P]
                                       [--incremental]
    python -m aeolus.plans.cli gold    --silver ROOT --gold ROOT --producer P [--metrics m ...]
    python -m aeolus.plans.cli datasets --silver ROOT --out DIR [--time-from D --time-to D] [--force]
    python -m aeolus.plans.cli train   --datasets DIR --out DIR [--dataset kpt|tomtom|all]
    python -m aeolus.plans.cli ingest  --landing ROOT --bronze ROOT [--interval 600] [--checkpoint DIR]
    python -m aeolus.plans.cli collect --landing ROOT --bronze ROOT --producer P [--domains d ...]
                                       [--layout files|log] [--interval 600] [--checkpoint DIR]

``ingest`` takes finished envelopes, ``collect`` response bodies.

The master comes from ``spark-submit`` (or ``--master`` for local runs). Exit
codes: 1 for an unknown domain or metric, 2 for a failed run.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import functions as F

from .. import schemas
from ..constants import (
    DEFAULT_TIME_FROM,
    DEFAULT_TIME_TO,
    OWM_SOURCE,
    POLL_INTERVAL_SECONDS,
    PROBE_SOURCE,
    WEATHER_API_SOURCE,
    WEATHER_SOURCE,
)
from ..operators import gold
from ..operators.ml import prep as mp
from ..session import build_session
from ..sinks import write_dataset, write_hourly
from ..sources.silver import (
    load_sources,
    read_hourly,
    read_road_files,
    read_silver_recursive,
    silver_root,
)
from . import jobs

log = logging.getLogger("aeolus.cli")



def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="aeolus")
    ap.add_argument("--master", default=None, help="only for local runs")
    sub = ap.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--domain", default="weather")
    s.add_argument("--source", default=WEATHER_SOURCE)
    s.add_argument("--producer", default=None)
    s.add_argument("--restamp", action="store_true")
    s.add_argument("--incremental", action="store_true",
                   help="read only Bronze files that are new since the last such run")
    s.add_argument("--output-format", choices=("parquet", "json"), default="parquet")

    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--domain", default="weather")
    g.add_argument("--source", default=WEATHER_SOURCE)
    g.add_argument("--producer", required=True)
    g.add_argument("--metrics", nargs="*")
    g.add_argument("--output-format", choices=("parquet", "json"), default="parquet")
    g.add_argument("--keep-run-duplicates", action="store_true")

    d = sub.add_parser("datasets")
    d.add_argument("--silver", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--time-from", default=DEFAULT_TIME_FROM)
    d.add_argument("--time-to", default=DEFAULT_TIME_TO)
    d.add_argument("--producer", default="aeolus")
    d.add_argument("--road-source", default="road_sensors")
    d.add_argument("--force", action="store_true")

    t = sub.add_parser("train")
    t.add_argument("--datasets", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--dataset", choices=("kpt", "tomtom", "all"), default="all")
    t.add_argument("--producer", default="aeolus")

    i = sub.add_parser("ingest")
    i.add_argument("--landing", required=True)
    i.add_argument("--bronze", required=True)
    i.add_argument("--interval", type=int, default=600)
    i.add_argument("--checkpoint", default=None,
                   help="folder for the streams' progress; default: under spark.checkpoint.dir")

    c = sub.add_parser("collect")
    c.add_argument("--landing", required=True, help="folder with a folder of bodies per domain")
    c.add_argument("--bronze", required=True)
    c.add_argument("--producer", required=True)
    c.add_argument("--domains", nargs="*")
    c.add_argument("--layout", choices=("files", "log"), default="files")
    c.add_argument("--interval", type=int, default=POLL_INTERVAL_SECONDS)
    c.add_argument("--checkpoint", default=None,
                   help="folder for the streams' progress; default: under spark.checkpoint.dir")
    return ap


def run(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if getattr(args, "domain", "weather") != "weather":
        log.error("only the weather domain has Silver/Gold jobs, got %s", args.domain)
        return 1
    if args.cmd == "gold" and args.metrics:
        try:
            gold.select_metrics("weather", args.metrics)
        except ValueError as exc:
            log.error("%s", exc)
            return 1
    if args.cmd == "collect":
        from ..streaming import capture
        try:
            capture.select_domains(args.domains)
        except ValueError as exc:
            log.error("%s", exc)
            return 1
    spark = build_session(f"aeolus-{args.cmd}", master=args.master)
    try:
        if args.cmd == "silver":
            if args.incremental:
                from .incremental import run_silver_incremental
                r = run_silver_incremental(spark, args.bronze, args.silver, args.source, args.producer,
                                           args.restamp)
            else:
                r = jobs.run_silver(spark, args.bronze, args.silver, args.source, args.producer,
                                    args.restamp, fmt=args.output_format)
            print(f"silver run {r.run_id}: raw={r.raw_rows} valid={r.valid_rows} "
                  f"rejected={r.rejected_rows}")
        elif args.cmd == "gold":
            r = jobs.run_gold(spark, args.silver, args.gold, args.source, args.producer,
                              args.metrics, fmt=args.output_format,
                              dedup_runs=not args.keep_run_duplicates)
            print(f"gold run {r.run_id}: silver_rows={r.silver_rows} metrics={sorted(r.paths)}")
        elif args.cmd == "datasets":
            from ..operators import features as fe

            def src(source):
                return lambda: jobs.one_per_event(
                    read_silver_recursive(spark, silver_root(args.silver, "weather", source), runs=True))
            feeds = load_sources({
                WEATHER_SOURCE: lambda: fe.normalize_current(src(WEATHER_SOURCE)()),
                WEATHER_API_SOURCE: lambda: fe.normalize_api(src(WEATHER_API_SOURCE)()),
                OWM_SOURCE: lambda: fe.normalize_owm(src(OWM_SOURCE)()),
            })
            probes = jobs.one_per_event(
                read_silver_recursive(spark, silver_root(args.silver, "traffic", PROBE_SOURCE), runs=True))
            roads = jobs.one_per_event(
                read_road_files(spark, silver_root(args.silver, "traffic", args.road_source), runs=True))
            write_hourly(fe.hourly_weather(fe.union_weather(list(feeds.values())), time_from=args.time_from,
                                           time_to=args.time_to), args.out, jobs.new_run_id())
            kpt, road = jobs.build_datasets(probes, roads, [], args.time_from, args.time_to,
                                            hourly=read_hourly(spark, args.out))
            write_dataset(kpt, f"{args.out}/dataset_kpt", args.producer, args.force)
            write_dataset(road, f"{args.out}/dataset_tomtom", args.producer, args.force)
        elif args.cmd == "train":
            names = ("kpt", "tomtom") if args.dataset == "all" else (args.dataset,)
            for name in names:
                ds = spark.read.parquet(f"{args.datasets}/dataset_{name}")
                key = "_row_key"
                ds = ds.withColumn(key, F.xxhash64(*[F.col(c) for c in ds.columns]))
                jobs.train(spark, ds, mp.SPECS[name], key, args.producer, args.out)
        elif args.cmd == "ingest":
            from ..streaming.ingest import ingest_all, wait_all
            running, failed = ingest_all(spark, args.landing, args.bronze, {
                "weather": (WEATHER_SOURCE, schemas.WEATHER_ENVELOPE),
                "traffic": ("lviv_gtfs_rt", schemas.envelope(schemas.CAPTURE_PAYLOAD)),
                "alerts": ("vadimkin_air_raid", schemas.envelope(schemas.ALERT_PAYLOAD)),
                "roads": ("overpass_kyiv_highways", schemas.envelope(schemas.ROAD_PAYLOAD)),
            }, interval_seconds=args.interval, checkpoint=args.checkpoint)
            failed |= wait_all(running)
            if failed:
                log.error("ingest failed for %s", ", ".join(sorted(failed)))
                return 2
        elif args.cmd == "collect":
            from ..streaming.ingest import wait_all
            running, failed = capture.collect_all(
                spark, args.landing, args.bronze, args.producer, args.domains, args.interval,
                args.layout, args.checkpoint)
            failed |= wait_all(running)
            if failed:
                log.error("collect failed for %s", ", ".join(sorted(failed)))
                return 2
        return 0
    except Exception:  # noqa: BLE001 - reported as exit code 2
        log.exception("%s run failed", args.cmd)
        return 2
    finally:
        spark.stop()


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(run())
