"""Sharding by sampled splitters.

Size-weighted key samples give quantile boundaries; records are partitioned
into key ranges and overfull ranges are subdivided by further samples. Within
the bounded ranges a running size places every record, so the shards' sizes
differ by no more than one record, whatever the sample was.

Everything on the main path is a DataFrame expression. Only the samples and
one row of statistics a range reach the driver; both are bounded by the number
of ranges.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeolus.llm.common import materialise

#: Sampled keys for each range.
OVERSAMPLE = 24
#: A range over this many times its share of the bytes is subdivided.
OVERFULL = 2.0
#: Ranges for each shard at least, and rows for each range at most on average.
RANGES_PER_SHARD = 128
ROWS_PER_RANGE = 1_000_000

_KEY = "struct<_k:bigint,_id:bigint,_tie:bigint>"


def _sample(keys: DataFrame, total: int, expected: int, seed: int) -> list[tuple[tuple, float]]:
    """Keys drawn with probability in proportion to their size, and weights.

    A record larger than the sampling step is always drawn, with its size in
    steps as weight. The draw is a hash of the key: a retried task repeats it.
    """
    step = max(total / expected, 1e-9)
    draw = F.xxhash64("_k", "_id", "_tie", F.lit(seed)).bitwiseAND(2**53 - 1) / float(2**53)
    rows = keys.where(draw < F.col("_size") / step).select("_k", "_id", "_tie", "_size").collect()
    return sorted(
        ((_plain(r), max(1.0, r["_size"] / step)) for r in rows), key=lambda x: _ordered(x[0])
    )


def _plain(row) -> tuple:
    return row["_k"], row["_id"], row["_tie"]


def _ordered(key: tuple) -> tuple:
    """Spark's order: null first."""
    return tuple((v is not None, v or 0) for v in key)


def _quantiles(sample: list[tuple[tuple, float]], pieces: int) -> list[tuple]:
    """Boundaries that cut the sample into pieces of equal weight."""
    whole = sum(w for _, w in sample)
    cuts: list[tuple] = []
    passed, wanted = 0.0, 1
    for key, weight in sample:
        if wanted < pieces and passed >= whole * wanted / pieces:
            if not cuts or cuts[-1] != key:
                cuts.append(key)
            while wanted < pieces and passed >= whole * wanted / pieces:
                wanted += 1
        passed += weight
    return cuts


def _literal(values: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def _range_of(splitters: list[tuple]) -> Column:
    """Number of splitters up to the key: a search in two steps of the root."""
    if not splitters:
        return F.lit(0)
    step = max(1, int(len(splitters) ** 0.5))
    rows = [dict(zip(("_k", "_id", "_tie"), s)) for s in splitters]
    blocks = [rows[i : i + step] for i in range(0, len(rows), step)]
    key = F.struct("_k", "_id", "_tie")
    # Firsts of the blocks but for the first: so many blocks lie wholly below.
    heads = _literal([b[0] for b in blocks[1:]], _KEY)
    block = F.size(F.filter(heads, lambda s: s <= key))
    inside = F.element_at(_literal(blocks, f"array<{_KEY}>"), block + 1)
    return block * step + F.size(F.filter(inside, lambda s: s <= key))


def shard_records(
    records: DataFrame,
    key: Column,
    id_col: str,
    size: Column,
    n_shards: int = 16,
    *,
    carry: list[str] | None = None,
    oversample: int = OVERSAMPLE,
    ranges: int | None = None,
) -> DataFrame:
    """Deal records out to shards of equal size in key order.

    ``key``: long by which records are ordered (equal keys stay together as far
    as equal sizes allow); ``id_col`` breaks ties; ``size``: long above zero.
    Returns the id, the ``carry`` columns, and ``_size``, ``shard`` (int from
    0) and ``slot`` (long, gapless from 0 in each shard).

    Null keys and ids come first in order; repeated rows each get a place of
    their own; an empty input gives an empty result.
    """
    carry = carry or []
    keys = materialise(
        records.select(
            key.cast("long").alias("_k"),
            F.col(id_col).cast("long").alias("_id"),
            F.monotonically_increasing_id().alias("_tie"),
            size.cast("long").alias("_size"),
            *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
        ),
        "keys",
    )
    total, rows = keys.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.count("*")).first()
    ranges = ranges or max(RANGES_PER_SHARD * n_shards, rows // ROWS_PER_RANGE)
    splitters = _quantiles(_sample(keys, total, ranges * oversample, 0), ranges) if rows else []
    seed, limit, stats = 0, OVERFULL * total / ranges, {}
    while rows:
        ranged = keys.withColumn("_range", _range_of(splitters))
        stats = {
            r["_range"]: r
            for r in ranged.groupBy("_range").agg(
                F.sum("_size").alias("bytes"), F.count("*").alias("rows"),
                F.min(F.struct("_k", "_id", "_tie")).alias("low"),
            ).collect()
        }
        over = [r for r in stats.values() if r["bytes"] > limit and r["rows"] > 1]
        if not over:
            break
        # Subdivide: sample again inside the overfull ranges only, more densely
        # each time so that a range of more than one record is cut in the end.
        seed += 1
        inside = ranged.where(F.col("_range").isin([r["_range"] for r in over]))
        weight = sum(r["bytes"] for r in over)
        pieces = {r["_range"]: int(r["bytes"] * 2 // limit) + 1 for r in over}
        dense = oversample * 2**seed * sum(pieces.values())
        drawn: dict[int, list] = {}
        bounds = [_ordered(s) for s in splitters]
        for k, w in _sample(inside, weight, dense, seed):
            drawn.setdefault(_place(bounds, _ordered(k)), []).append((k, w))
        fresh = {
            cut
            for at, sample in drawn.items()
            for cut in _quantiles(sample, pieces.get(at, 1))
            if cut != _plain(stats[at]["low"])
        } - set(splitters)
        if not fresh and not any(r["rows"] <= 2**seed for r in over):
            continue
        if not fresh:
            break  # single large records beside small ones: nothing to cut
        splitters = sorted({*splitters, *fresh}, key=_ordered)
    if not rows:
        ranged = keys.withColumn("_range", F.lit(0))
    bytes_before, rows_before, n, b = [], [], 0, 0
    for i in range(len(splitters) + 1):
        bytes_before.append(b)
        rows_before.append(n)
        if i in stats:
            b, n = b + stats[i]["bytes"], n + stats[i]["rows"]
    by_key = Window.partitionBy("_range").orderBy("_k", "_id", "_tie")
    before = F.element_at(_literal(bytes_before, "bigint"), F.col("_range") + 1) + F.coalesce(
        F.sum("_size").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rank = F.element_at(_literal(rows_before, "bigint"), F.col("_range") + 1) + F.row_number().over(by_key) - 1
    # The shard in which a record's middle byte falls, in whole numbers.
    middle, whole = (F.col("_before") * 2 + F.col("_size")) * n_shards, F.lit(max(1, 2 * total))
    placed = (
        ranged.withColumn("_before", before).withColumn("_rank", rank)
        .withColumn("shard", ((middle - middle % whole) / whole).cast("int"))
    )
    # One row a shard; the shuffle of the window is shared.
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("_id").alias(id_col),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
        F.col("_size"), "shard", (F.col("_rank") - F.col("_first")).alias("slot"),
    )


def _place(bounds: list[tuple], key: tuple) -> int:
    from bisect import bisect_right

    return bisect_right(bounds, key)


def shard_documents(documents: DataFrame, n_shards: int = 16, **options) -> DataFrame:
    """Shard documents by size, copies of a text next to each other.

    Size: UTF-8 bytes of the text plus 1; a null text has no bytes and the
    checksum 0. Law ``bytes``: shard sizes differ by less than the largest
    document. Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        (F.octet_length(text) + 1).cast("long").alias("bytes"),
    )
    out = shard_records(
        slim, F.col("text_crc32"), "doc_id", F.col("bytes"), n_shards, carry=["text_crc32"], **options
    )
    return out.select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
