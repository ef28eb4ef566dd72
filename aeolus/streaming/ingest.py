"""Continuous Bronze ingest as one Structured Streaming query per domain.

Collectors (outside the engine) drop raw envelopes into a landing folder;
each domain's query appends them to the hour-partitioned Bronze layer. A
failing domain stops only its own query. ``interval_seconds=0`` processes the
available files once (``availableNow``), like a single collection round.

Progress lives under an explicit checkpoint folder, one stable path for each
domain and source, so a restarted ingest goes on where the last one stopped.
The stream writes a root of its own beside the batch writer's: a file sink
keeps a log of its files, and readers of its root see only those in the log.
``read_bronze`` reads both.
"""

from __future__ import annotations

import logging
import time
from typing import Callable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..constants import POLL_INTERVAL_SECONDS
from ..operators.bronze import with_partition_keys
from ..schemas import CORRUPT_COL
from ..session import CHECKPOINT_CONF
from ..sources.bronze import bronze_root, stream_root

log = logging.getLogger("aeolus.ingest")


def checkpoint_root(spark: SparkSession, checkpoint: str | None = None) -> str:
    """The given folder, or ``ingest`` under the configured checkpoint folder.

    The configured value itself is used: the folder that the SparkContext
    derives from it is another one in every application. Without either there
    is no place that outlives this run, in local mode too, so it is an error."""
    root = checkpoint or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not root:
        raise ValueError(f"ingest needs a checkpoint folder: pass one or set {CHECKPOINT_CONF}")
    return root.rstrip("/") if checkpoint else f"{root.rstrip('/')}/ingest"


def ingest_domain(spark: SparkSession, landing_dir: str, root: str, domain: str, source: str,
                  schema: T.StructType, interval_seconds: int = POLL_INTERVAL_SECONDS,
                  max_files_per_trigger: int | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    reader = (spark.readStream.schema(schema).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COL))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return append_bronze(reader.json(landing_dir), stream_root(root), domain, source,
                         f"{checkpoint_root(spark, checkpoint)}/{domain}/{source}", f"ingest_{domain}",
                         interval_seconds)


def append_bronze(envelopes: DataFrame, root: str, domain: str, source: str, checkpoint: str,
                  name: str, interval_seconds: int) -> StreamingQuery:
    """Append a stream of envelopes to the hour partitions below ``root``, as
    gzip JSON Lines. ``interval_seconds=0`` takes what is there and ends."""
    keyed = with_partition_keys(envelopes).drop("part_stamp")
    w = (keyed.writeStream.format("json").outputMode("append")
         .partitionBy("ingest_date", "hour")
         .option("checkpointLocation", checkpoint)
         .option("compression", "gzip")
         .queryName(name))
    w = (w.trigger(availableNow=True) if interval_seconds == 0
         else w.trigger(processingTime=f"{interval_seconds} seconds"))
    return w.start(bronze_root(root, domain, source))


def start_each(starters: Mapping[str, Callable[[], StreamingQuery]],
               ) -> tuple[dict[str, StreamingQuery], dict[str, str]]:
    """Start every query; one that can't start is logged and the others go on."""
    running: dict[str, StreamingQuery] = {}
    failed: dict[str, str] = {}
    for domain, start in starters.items():
        try:
            running[domain] = start()
        except PySparkException as exc:
            log.error("ingest of %s did not start: %s", domain, str(exc)[:300])
            failed[domain] = str(exc)
    return running, failed


def ingest_all(spark: SparkSession, landing_root: str, root: str,
               domains: Mapping[str, tuple[str, T.StructType]],
               interval_seconds: int = POLL_INTERVAL_SECONDS,
               checkpoint: str | None = None) -> tuple[dict[str, StreamingQuery], dict[str, str]]:
    """One independent query per domain: ``{domain: (source, schema)}``.

    Returns the started queries and, for domains that could not start (no
    landing folder, unreadable files), the error; the others go on."""
    checkpoint_root(spark, checkpoint)
    return start_each({
        domain: (lambda domain=domain, source=source, schema=schema: ingest_domain(
            spark, f"{landing_root.rstrip('/')}/{domain}", root, domain, source, schema,
            interval_seconds, checkpoint=checkpoint))
        for domain, (source, schema) in domains.items()
    })


def wait_all(running: Mapping[str, StreamingQuery], poll_seconds: float = 1.0) -> dict[str, str]:
    """Wait until every query has ended; the errors of those that failed.

    A query that fails is logged at once and leaves the others running."""
    failed: dict[str, str] = {}
    open_ = dict(running)
    while open_:
        for domain, query in list(open_.items()):
            if query.isActive:
                continue
            del open_[domain]
            exc = query.exception()
            if exc is not None:
                log.error("ingest of %s stopped: %s", domain, str(exc)[:300])
                failed[domain] = str(exc)
        if open_:
            time.sleep(poll_seconds)
    return failed
