"""Session settings the engine relies on.

Library code never sets a master; callers (tests, bench, the cluster launcher)
do. ``configure`` only sets runtime SQL confs, so it is safe on a shared session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime confs every job needs.
#  * UTC session zone: all event times are UTC instants.
#  * no partition-column type inference: ``run_id=123e4`` must stay a string.
#  * AQE with skew handling: a hot key may hold a third of all rows.
RUNTIME_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONFS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "aeolus", master: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and scripts; on a cluster pass ``master=None``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    confs = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **RUNTIME_CONFS,
        **(extra or {}),
    }
    for key, value in confs.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir`` (or the SparkContext). Raises when unset:
    a machine-local folder is never a valid substitute on a cluster.
    """
    path = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; the cluster must name a shared folder")
    return path.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured shared folder. Only a local-mode session (tests,
    single-machine runs) may fall back to a private temporary folder; on a
    cluster a machine-local folder is invisible to the other executors, so an
    unset ``spark.checkpoint.dir`` is an error there."""
    path = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; the cluster must name a shared folder")
        path = tempfile.mkdtemp(prefix="aeolus-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return shared_dir(spark)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder for written intermediate tables."""
    return "/".join([shared_dir(spark), "aeolus", *parts])
