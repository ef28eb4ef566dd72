"""Token counts by overlap resynchronisation.

A huge document is cut into overlapping chunks that different tasks encode
with offsets. Neighbouring chunks are spliced at a position inside their
overlap where both encodings have a token boundary that is proven stable; a
document whose chunks share no such boundary is encoded again with wider
overlaps, at last in one piece.

Proof of a stable boundary: the tokenizer drops white space and none of its
pre-tokens, added tokens or normal forms reach across U+0020 or U+000A, so what
stands on one side of such a character never changes the tokens on the other.
By the same proof a document that is not huge is counted as the sum over its
pieces between those characters, and a piece that comes again is not encoded
again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeolus.llm.common import by_size, materialise

TOKENIZER = "word_bpe_49k.json"
#: Documents with more UTF-8 bytes are cut into chunks of so many characters,
#: with so many more of the next chunk.
HUGE_BYTES = 65_536
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
#: Documents of more tokens than this are marked.
TOKEN_LIMIT = 2_048
#: Pieces whose counts a Python worker keeps; beyond that it starts afresh.
KEPT_PIECES = 1_000_000

_ROW = "_row long, doc_id long, n_bytes long"


@lru_cache(maxsize=4)
def tokenizer(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


@lru_cache(maxsize=4)
def _kept(name: str) -> dict[str, int]:
    return {"": 0}


def count_tokens(texts: list[str], name: str = TOKENIZER) -> list[int]:
    """Tokens of each text, summed over its pieces.

    Pieces not yet known are encoded in one go, a space between them: a stable
    boundary on either side of each.
    """
    kept = _kept(name)
    if len(kept) > KEPT_PIECES:
        kept.clear()
        kept[""] = 0
    pieces = [t.replace("\n", " ").split(" ") for t in texts]
    fresh = list({p for own in pieces for p in own if p not in kept})
    if fresh:
        starts = np.cumsum([0] + [len(p) + 1 for p in fresh[:-1]])
        offsets = tokenizer(name).encode(" ".join(fresh), add_special_tokens=False).offsets
        at = np.searchsorted(starts, np.fromiter((o[0] for o in offsets), int), "right") - 1
        kept.update(zip(fresh, np.bincount(at, minlength=len(fresh)).tolist()))
    return [sum(map(kept.__getitem__, own)) for own in pieces]


def _stable(text: str, begin: int, end: int) -> list[int]:
    """Positions in [begin, end) of a space or line feed after something else."""
    return [
        p for p in range(max(begin, 1), min(end, len(text)))
        if text[p] in " \n" and text[p - 1] not in " \n"
    ]


def encode_chunk(text: str, start: int, head: int, tail: int, name: str = TOKENIZER):
    """Tokens of a chunk, and what may be spliced.

    ``start``: the chunk's place in its document; ``head``: characters that it
    shares with the chunk before; ``tail``: its first character that the next
    chunk has too. Returns the number of tokens and, for head and tail, the
    stable boundaries (places in the document) with the tokens before each.
    """
    offsets = tokenizer(name).encode(text, add_special_tokens=False).offsets
    out = []
    for begin, end in ((0, head), (tail, len(text))):
        places, before, at = [], [], 0
        for p in _stable(text, begin, end):
            while at < len(offsets) and offsets[at][0] < p:
                at += 1
            if at == 0 or offsets[at - 1][1] <= p:  # both sides have a token boundary here
                places.append(start + p)
                before.append(at)
        out += [places, before]
    return len(offsets), *out


def _split(chunk: int, overlap: int):
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, doc_id, n_bytes, text in zip(
                batch["_row"], batch["doc_id"].astype("Int64"), batch["n_bytes"], batch["text"]
            ):
                last = max(0, -(-(len(text) - overlap) // chunk) - 1)
                for i in range(last + 1):
                    end = len(text) if i == last else (i + 1) * chunk + overlap
                    yield pd.DataFrame({
                        "_row": [row], "doc_id": pd.array([doc_id], "Int64"), "n_bytes": [n_bytes],
                        "chunk": [i], "last": [i == last], "part": [text[i * chunk : end]],
                    })

    return split


def _encode(chunk: int, overlap: int, name: str):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                encode_chunk(part, i * chunk, overlap if i else 0, len(part) if last else chunk, name)
                for i, last, part in zip(batch["chunk"], batch["last"], batch["part"])
            ]
            out = batch.drop(columns="part")
            out["doc_id"] = out["doc_id"].astype("Int64")
            for k, c in enumerate(("n", "head", "head_n", "tail", "tail_n")):
                out[c] = [r[k] for r in rows]
            yield out

    return encode


def _splice(huge: DataFrame, chunk: int, overlap: int, name: str) -> DataFrame:
    """Counts of huge documents; ``n_tokens`` is null where chunks don't align."""
    chunks = huge.mapInPandas(
        _split(chunk, overlap), f"{_ROW}, chunk long, last boolean, part string"
    ).repartition("_row", "chunk")
    encoded = chunks.mapInPandas(
        _encode(chunk, overlap, name),
        f"{_ROW}, chunk long, last boolean, n long,"
        " head array<long>, head_n array<long>, tail array<long>, tail_n array<long>",
    )
    order = Window.partitionBy("_row").orderBy("chunk")
    at = F.array_min(F.array_intersect("tail", "next"))
    return (
        encoded.withColumn("next", F.lead("head").over(order))
        .withColumn("next_n", F.lead("head_n").over(order))
        .withColumn("at", at)
        .withColumn(
            "own",
            F.when(F.col("last"), F.col("n")).otherwise(
                F.element_at("tail_n", F.array_position("tail", F.col("at")).cast("int"))
                - F.element_at("next_n", F.array_position("next", F.col("at")).cast("int"))
            ),
        )
        .groupBy("_row")
        .agg(
            F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"),
            F.when(F.count("own") == F.count("*"), F.sum("own")).alias("n_tokens"),
        )
    )


def token_counts(
    documents: DataFrame,
    name: str = TOKENIZER,
    limit: int = TOKEN_LIMIT,
    *,
    huge_bytes: int = HUGE_BYTES,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Tokens of every whole text, as the tokenizer's library gives them.

    Null text: empty, 0 bytes and tokens. Repeated rows are each counted. No
    special tokens are added; their strings inside texts are the library's
    special tokens. Columns: doc_id, n_bytes, n_tokens, over_limit.
    """
    texts = documents.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: list[int] = []
            for texts in by_size(batch["text"]):
                counts += count_tokens(texts, name)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "n_bytes": batch["n_bytes"],
                "n_tokens": pd.array(counts, "int64"),
            })

    counted = "doc_id long, n_bytes long, n_tokens long"
    parts = [
        texts.where(F.col("n_bytes") <= huge_bytes)
        .select("doc_id", "n_bytes", "text").mapInPandas(count, counted)
    ]
    huge = texts.where(F.col("n_bytes") > huge_bytes)
    # A chunk and its overlap grow until every document's chunks align; a
    # document no longer than one chunk is encoded whole and always does.
    while True:
        done = materialise(_splice(huge, chunk, overlap, name), "spliced")
        parts.append(done.where("n_tokens IS NOT NULL").select("doc_id", "n_bytes", "n_tokens"))
        failed = done.where("n_tokens IS NULL").select("_row")
        if failed.isEmpty():
            break
        huge = huge.join(failed, "_row", "left_semi")
        chunk, overlap = chunk * 4, overlap * 8
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
