"""Run a streaming query to completion over the files available now.

Checkpoints and sink tables live under the shared folder
(``spark.checkpoint.dir``). A run that is given a name can be resumed under
it: the folder is that of the configured value, which stays the same over
applications, and windows left open are emitted once later events arrive. A
run without a name gets a fresh folder and is not resumed.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import CHECKPOINT_CONF, scratch_path


def stream_paths(spark: SparkSession, name: str, run: str | None = None) -> tuple[str, str]:
    configured = spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if run and configured:
        base = f"{configured.rstrip('/')}/aeolus/streams/{name}/{run}"
    else:
        base = scratch_path(spark, "streams", name, run or uuid.uuid4().hex[:12])
    return f"{base}/_checkpoint", f"{base}/table"


STATE_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Dedup and window state grows with keys in flight; RocksDB keeps it off
    the JVM heap and on local disk with incremental checkpoints. A provider
    the user configured is left alone; it only applies to new checkpoints."""
    current = spark.conf.get(STATE_PROVIDER_CONF, None)
    if not current or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_PROVIDER_CONF, ROCKSDB_PROVIDER)


def start(df: DataFrame, name: str, spark: SparkSession, fmt: str = "parquet",
          output_mode: str = "append", partition_by: tuple[str, ...] = (),
          processing_time: str | None = None, run: str | None = None) -> tuple[StreamingQuery, str]:
    """Start a file-sink query. ``processing_time=None`` means
    ``availableNow`` (process what has landed, then stop)."""
    use_rocksdb_state(spark)
    ckpt, out = stream_paths(spark, name, run)
    w = (df.writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", ckpt).queryName(f"{name}_{uuid.uuid4().hex[:6]}"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if processing_time is None else w.trigger(
        processingTime=processing_time)
    return w.start(out), out


def run_available_now(df: DataFrame, name: str, spark: SparkSession, fmt: str = "parquet",
                      run: str | None = None) -> tuple[DataFrame, StreamingQuery]:
    """Process everything available, wait, and return the sink as a table.

    With ``run``, a later call under the same name and run goes on from here,
    with the windows that this one leaves open."""
    q, out = start(df, name, spark, fmt, run=run)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.format(fmt).load(out), q


def _dropped(progress) -> int:
    return sum(int(op.get("numRowsDroppedByWatermark", 0) or 0) for op in progress.get("stateOperators", []) or [])


def rows_dropped_by_watermark(q: StreamingQuery) -> int:
    """T4: late rows discarded by the stateful operators, over the batches that
    the query still remembers; ``ProgressLog`` counts all."""
    return sum(map(_dropped, q.recentProgress))


class ProgressLog:
    """T4: what every micro-batch of a query read and dropped as late.

    A query remembers its last batches only. The log looks at them again and
    again while the query runs, and once more at its end, and keeps each
    batch's figures. It raises if a batch was missed.

        with ProgressLog(q) as log:
            q.awaitTermination()
        log.rows_dropped
    """

    def __init__(self, query: StreamingQuery, poll_seconds: float = 0.2):
        self.query, self.poll_seconds = query, poll_seconds
        self.batches: dict[int, tuple[int, int]] = {}
        self._ended = threading.Event()
        self._thread = threading.Thread(target=self._follow, daemon=True)

    def _look(self) -> None:
        for p in self.query.recentProgress:
            rows, dropped = int(p["numInputRows"] or 0), _dropped(p)
            # Idle triggers report their batch again, without rows.
            old = self.batches.get(p["batchId"], (0, 0))
            self.batches[p["batchId"]] = max(old[0], rows), max(old[1], dropped)

    def _follow(self) -> None:
        while not self._ended.wait(self.poll_seconds):
            self._look()

    def __enter__(self) -> "ProgressLog":
        self._thread.start()
        return self

    def __exit__(self, kind, *_rest) -> None:
        self._ended.set()
        self._thread.join()
        self._look()
        missed = set(range(min(self.batches), max(self.batches) + 1)) - set(self.batches) if self.batches else set()
        if missed and kind is None:
            raise RuntimeError(f"progress of batches {sorted(missed)} was missed; poll more often")

    @property
    def rows_dropped(self) -> int:
        return sum(dropped for _, dropped in self.batches.values())

    def table(self, spark: SparkSession) -> DataFrame:
        """(batch_id, input_rows, late_rows), one row a batch."""
        rows = [(k, *v) for k, v in sorted(self.batches.items())]
        return spark.createDataFrame(rows, "batch_id long, input_rows long, late_rows long")
