"""Mixing sources to target weights by entropy balancing.

Every document has a rate, how often the mix takes it on average. Of all rates
that give each source its target of words, entropy balancing takes those
nearest to 1 in relative entropy, none above the most that is allowed. They
tilt exponentially with the document's words,

    rate = min(most, exp(tilt[source] * words / mean words)),

and the tilts solve the convex dual, whose gradient is the words taken less the
target. Newton's method solves it on the histogram of sources and sizes: a step
is one grouped sum of gradient and curvature, kept inside a bracket that each
step narrows. Sums are decimals, so that no order of summing changes a result.

Rates are rounded into copies along the order of sizes within a source, the
longest first: a document is taken as often as the running sum of rates passes
a whole number. Neighbours have nearly equal sizes, so a source's words miss its
target by half of its longest document at most. Running sums are taken inside
range partitions and shifted by the sums of the partitions before.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeolus.llm.common import materialise

#: Weights of the sources in order, repeating; words of the mix against all
#: words; how often a document may be taken.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Newton steps end where every source is this near its target, as a share.
TOLERANCE, STEPS = 1e-13, 200
#: Rates count in units of this share.
UNIT = 1 << 20
#: Parts into which the documents of one source are dealt to meet its numbers.
SALTS = 32

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Targets of (source, source_size): adds ``weight`` and ``target``.

    Sources by code point, null last, have the weights in turn and share so
    much of all words. In order of size to weight, a source is full, at
    ``most`` times its size, if even what the fuller ones leave gives it more.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    everything = Window.partitionBy()
    fullest = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    after = fullest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = sources.withColumn(
        "weight",
        F.element_at(listed, F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1,
                                    F.lit(len(weights))).cast("int") + 1),
    )
    levels = ranked.withColumn(
        "level",
        (F.sum("source_size").over(everything) * share
         - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most) / F.sum("weight").over(after),
    ).withColumn("full", F.col("level") * F.col("weight") > F.col("source_size") * most)
    open_level = F.min_by("level", F.struct(F.col("full"), F.col("source_size") / F.col("weight"),
                                            F.col("source").isNull(), F.col("source"))).over(everything)
    return levels.select(
        "source", "source_size", "weight",
        F.when(F.col("full"), F.col("source_size").cast("double") * most)
        .otherwise(open_level * F.col("weight")).alias("target"),
    )


def _rate(tilt: Column, size: Column, mean: Column, most: int) -> Column:
    """A document's rate; ``tilt`` null: the most."""
    return F.when(tilt.isNull(), F.lit(float(most))).otherwise(
        F.least(F.lit(float(most)), F.exp(F.least(tilt * size / mean, F.lit(1.0 + math.log(most)))))
    )


def solve_tilts(histogram: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """Tilts of the sources by Newton's method on the dual.

    ``histogram``: (source, size, n); ``targets``: (source, source_size,
    target). Returns source, source_size, target, mean (words of a document
    with words) and tilt. A source at ``most`` times its size has no tilt: all
    its documents are taken so often. One without words has tilt 0.
    """
    counted = histogram.where("size > 0").groupBy("source").agg(F.sum("n").alias("n_worded"))
    state = targets.join(counted, targets["source"].eqNullSafe(counted["source"]), "left").select(
        targets["source"], "source_size", "target",
        F.coalesce(F.col("source_size") / F.col("n_worded"), F.lit(1.0)).alias("mean"),
    )
    ratio = F.try_divide("target", "source_size")
    solvable = (F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * most)
    # At these tilts even the shortest documents are taken at the most, or less
    # often than the target asks.
    state = state.select(
        "*",
        F.when(solvable, F.ln(ratio)).when(F.col("source_size") == 0, F.lit(0.0)).alias("tilt"),
        F.when(solvable, F.least(F.lit(0.0), F.ln(ratio)) * F.col("mean") - 1).alias("low"),
        F.when(solvable, F.lit(math.log(most)) * F.col("mean") + 1).alias("high"),
        (~solvable).alias("done"),
    )
    state = materialise(state, "tilts")
    for _ in range(STEPS):
        if state.where("not done").isEmpty():
            break
        x, p = F.col("size") / F.col("mean"), _rate(F.col("tilt"), F.col("size"), F.col("mean"), most)
        own = histogram.withColumnRenamed("source", "_source")
        sums = (
            own.join(state.where("not done"), F.col("_source").eqNullSafe(F.col("source")))
            .groupBy(F.col("source").alias("_source"))
            .agg(
                F.sum((F.col("n") * x * p).cast("decimal(38,12)")).cast("double").alias("taken"),
                F.sum(F.when(p < most, F.col("n") * x * x * p).otherwise(0.0).cast("decimal(38,12)"))
                .cast("double").alias("curve"),
            )
        )
        gap = F.col("taken") - F.col("target") / F.col("mean")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - gap / F.when(F.col("curve") > 0, F.col("curve"))
        step = (
            state.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumn("gap", gap).withColumn("newton", newton)
            .withColumn("low", low).withColumn("high", high)
            .withColumn("next", F.when((F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")), F.col("newton"))
                        .otherwise((F.col("low") + F.col("high")) / 2))
        )
        # Met, or no number lies between.
        met = (F.abs("gap") * F.col("mean") <= F.col("target") * TOLERANCE) | (F.col("next") == F.col("tilt"))
        state = materialise(
            step.select(
                "source", "source_size", "target", "mean",
                F.when(F.col("done") | met, F.col("tilt")).otherwise(F.col("next")).alias("tilt"),
                "low", "high", (F.col("done") | F.coalesce(met, F.lit(False))).alias("done"),
            ),
            "tilts",
        )
    return state.select("source", "source_size", "target", "mean", "tilt")


def _copies(rated: DataFrame) -> DataFrame:
    """Adds ``copies``: whole numbers that the running sum of ``units`` passes."""
    order = [F.desc("size"), F.asc("mark"), F.asc("_row")]
    ranged = materialise(
        rated.repartitionByRange("source", *order).withColumn("part", F.spark_partition_id()), "ranged"
    )
    # A source's units in the range partitions before; one row a partition and source.
    sums = ranged.groupBy("source", "part").agg(F.sum("units").alias("units"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(
        F.col("source").alias("_source"), F.col("part").alias("_part"),
        F.coalesce(F.sum("units").over(ahead), F.lit(0)).alias("shift"),
    )
    running = Window.partitionBy("part", "source").orderBy(*order)
    upto = F.col("shift") + F.sum("units").over(running) + UNIT // 2
    return (
        ranged.join(shifts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part")))
        .withColumn("upto", upto)
        .withColumn("copies", F.expr(f"upto div {UNIT}") - F.expr(f"(upto - units) div {UNIT}"))
    )


def mix_documents(
    documents: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """How many words of every document a mix of the sources takes.

    Size: words of the text, runs of anything but ASCII white space (null: 0).
    A null source is a source. Documents without words are taken with 0 words;
    repeated rows are documents each. No document is taken more than ``most``
    times. Columns: doc_id, size, source_size, target (the source's words),
    taken; and copies, how often the document is taken.
    """
    rows = materialise(
        documents.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
            # Decides between documents of one size.
            F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))).alias("mark"),
        ),
        "rows",
    )
    histogram = materialise(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    sources = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    tilts = solve_tilts(histogram, source_targets(sources, weights, share, most), most)
    salted = tilts.withColumnRenamed("source", "_source").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    rated = (
        rows.withColumn("salt", F.pmod(F.col("_row"), F.lit(SALTS)).cast("int"))
        .join(salted, F.col("source").eqNullSafe(F.col("_source")) & (F.col("salt") == F.col("_salt")))
        .withColumn("units", F.round(_rate(F.col("tilt"), F.col("size"), F.col("mean"), most) * UNIT).cast("long"))
        .select("_row", "doc_id", "source", "size", "mark", "source_size", "target", "units")
    )
    return _copies(rated).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )
