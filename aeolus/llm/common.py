"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Temporary folders of local sessions, by application.
_OWN: dict[str, str] = {}
_SHIPPED: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see.

    ``spark.checkpoint.dir`` names it. Only a local-mode session (tests) may
    leave it unset and gets a temporary folder.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _OWN:
        _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="llm-shared-")
    return _OWN[sc.applicationId]


#: Bytes of an Arrow batch between the JVM and Python, unless the session sets
#: its own; a longer row is a batch of its own.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once an application, and
    bound the batches of whole texts that they are sent."""
    sc = spark.sparkContext
    if spark.conf.get(_BATCH_CONF).rstrip("bB") == str(2**31 - 1):  # the default: no bound
        spark.conf.set(_BATCH_CONF, f"{BATCH_BYTES}b")
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='llm-package-')}/{package.name}", "zip", package.parent, package.name
        )
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage with files that outlive any executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_size(texts: Iterable[str], chars: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in order, in lists of so many characters or one longer text."""
    out: list[str] = []
    held = 0
    for text in texts:
        if out and held + len(text) > chars:
            yield out
            out, held = [], 0
        out.append(text)
        held += len(text)
    if out:
        yield out


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as distinct (src, dst) pairs.

    Returns (node, component), component being the smallest node reachable.
    Alternating large-star and small-star steps: every step is a grouped
    minimum, which aggregates before the shuffle, so a hub with a third of all
    edges is no hot task. The number of rounds grows with the logarithm of the
    component size. Each round's edges are written to the shared folder.
    """
    pairs = materialise(
        edges.select(
            F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
        ).where("src <> dst").distinct(),
        "edges",
    )
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
        # Large star: larger neighbours move to the smallest one.
        large = (
            both.join(low, "src").where("dst > src")
            .select(F.col("dst").alias("src"), F.col("low").alias("dst"))
            .where("src <> dst").distinct()
        )
        # Small star: smaller neighbours move, with the node, to the smallest.
        small_low = large.groupBy("src").agg(F.min("dst").alias("low"))
        small = (
            large.join(small_low, "src")
            .select(F.explode(F.array("src", "dst")).alias("src"), F.col("low").alias("dst"))
            .where("src <> dst").distinct()
        )
        pairs = materialise(small, "edges")
        # Done when every node hangs on one root and no root hangs on another.
        seen = pairs.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("mark"),
        ).first()
        if before == seen:
            break
        before = seen
    stars = pairs.groupBy("src").agg(F.min("dst").alias("component"))
    roots = pairs.select(F.col("dst").alias("node")).distinct()
    return (
        stars.select(F.col("src").alias("node"), "component")
        .unionByName(roots.select("node", F.col("node").alias("component")))
        .groupBy("node").agg(F.min("component").alias("component"))
    )
