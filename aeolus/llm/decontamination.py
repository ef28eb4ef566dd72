"""Benchmark decontamination by q-gram lemma filtering.

An occurrence of a benchmark item within the edit budget k shares at least
m + 1 - q - k*q of the item's m + 1 - q character q-grams with the text, on
diagonals (place in the text minus place in the item) that lie within k of
each other. Shared q-grams are counted in overlapping bands of diagonals;
bands that meet the bound are aligned by a banded dynamic programme, which
gives the exact edit distance of the best occurrence.

The benchmark is the stated query set. It is dealt into blocks of bounded size
and every block passes over all documents; nothing else is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeolus.llm.shingles import powers

#: Longest character q-grams, and edits allowed for each character.
Q = 8
EDITS = 0.1
#: Characters of benchmark items in a block.
BLOCK_CHARS = 2_000_000
#: Characters of a text in which q-grams are looked up at a time.
SEGMENT = 1 << 20

_SPACES = re.compile(r"\s+")


def normalise(text: str) -> tuple[str, np.ndarray | None]:
    """Lower case, white space runs as one space; and where each character was.

    None instead of places where the text keeps its length.
    """
    low = text.lower()
    if len(low) != len(text):  # a few capitals have a longer lower case; they stay
        low = "".join(c if len(c) == 1 else o for o, c in ((o, o.lower()) for o in text))
    out = _SPACES.sub(" ", low)
    if len(out) == len(low):
        return out, None
    places = np.ones(len(low), bool)
    for m in _SPACES.finditer(low):
        places[m.start() + 1 : m.end()] = False
    return out, np.flatnonzero(places)


def gram_length(m: int) -> int:
    """q for items of m characters: shorter ones have shorter q-grams, so that
    the lemma always asks for at least one; within no edit, the item itself."""
    return max(1, min(Q, m // (int(m * EDITS) + 1)))


def _grams(code: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of all q-grams, from running sums."""
    if len(code) < q:
        return np.zeros(0, np.uint64)
    up, down = powers(len(code) + 1)
    value = code * np.uint64(0xFF51AFD7ED558CCD)
    value ^= value >> np.uint64(31)
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(value * up[: len(code)], out=total[1:])
    h = (total[q:] - total[:-q]) * down[: len(code) - q + 1]
    return h ^ (h >> np.uint64(32))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


@dataclass
class Items:
    """A block of the benchmark's items of one q, with their q-grams sorted by hash."""

    q: int
    ids: list[int]
    texts: list[str]
    budget: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    slots: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]], q: int) -> Items:
        texts = [t for _, t in rows]
        grams = [_grams(_codes(t), q) for t in texts]
        h = np.concatenate([*grams, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, int)])
        order = np.argsort(h, kind="stable")
        slots = np.zeros(1 << max(16, (16 * len(h)).bit_length()), bool)  # few false hits
        slots[h & np.uint64(len(slots) - 1)] = True
        budget = np.array([int(len(t) * EDITS) for t in texts], int)
        return cls(q, [i for i, _ in rows], texts, budget, h[order], item[order], place[order], slots)


def regions(text: str, items: Items) -> list[tuple[int, int, int]]:
    """(item, low, high) of bands of diagonals that meet an item's q-gram bound."""
    code, q = _codes(text), items.q
    item_all, diagonal_all = [], []
    for start in range(0, max(1, len(code) - q + 1), SEGMENT):
        h = _grams(code[start : start + SEGMENT + q - 1], q)
        hit = np.flatnonzero(items.slots[h & np.uint64(len(items.slots) - 1)])
        lo, hi = (np.searchsorted(items.hashes, h[hit], side) for side in ("left", "right"))
        n = hi - lo
        hit, lo, n = hit[n > 0], lo[n > 0], n[n > 0]
        if not len(hit):
            continue
        k = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item_all.append(items.item[k])
        diagonal_all.append(np.repeat(hit + start, n) - items.place[k])
    if not item_all:
        return []
    item, diagonal = np.concatenate(item_all), np.concatenate(diagonal_all)
    out = []
    # Items of fewer shared q-grams than the bound are gone before any sorting.
    length = np.array([len(t) for t in items.texts])
    bound = length + 1 - q - items.budget * q
    enough = np.bincount(item, minlength=len(length))[item] >= bound[item]
    if not enough.any():
        return []
    item, diagonal = item[enough], diagonal[enough]
    order = np.lexsort((diagonal, item))
    item, diagonal = item[order], diagonal[order]
    for i in np.unique(item):
        a, b = np.searchsorted(item, (i, i + 1))
        d, k = diagonal[a:b], int(items.budget[i])
        # Bands of 2k+1 diagonals, one from every diagonal that has a q-gram:
        # any set of diagonals within k of each other lies in one of them.
        width = np.searchsorted(d, d + 2 * k, "right") - np.arange(len(d))
        found: list[list[int]] = []
        for f in np.flatnonzero(width >= bound[i]).tolist():
            low, high = int(d[f]) - k, int(d[f]) + 3 * k
            if found and low <= found[-1][1] and high - found[-1][0] <= 8 * k + 8:
                found[-1][1] = high
            else:
                found.append([low, high])
        out += [(int(i), low, high) for low, high in found]
    return out


def align(item: str, text: str, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """Least edit distance, at most k, of ``item`` to any substring of ``text``
    on the diagonals from low to high: (edits, begin, end).

    One step a character of the item over the band of diagonals. Of equal
    distances the first diagonal at the end counts.
    """
    at = text.find(item, max(0, low), max(0, high) + len(item))
    if at >= 0:
        return 0, at, at + len(item)
    pattern, far = _codes(item), 1 << 40
    diagonal = np.arange(low, high + 1)
    # The text under the band, with a code that no character has around it.
    under = np.full(high - low + len(item), 1 << 32, np.uint64)
    a, b = max(0, low), min(len(text), high + len(item))
    if b <= a:
        return None
    under[a - low : b - low] = _codes(text[a:b])
    width, steps = len(diagonal), np.arange(high - low + 1)
    # A start before the text or behind its end is none.
    cost = np.where((diagonal >= 0) & (diagonal <= len(text)), 0, far)
    begin = diagonal.copy()
    for i, c in enumerate(pattern):
        new = cost + (under[i : i + width] != c)
        gap = cost[1:] + 1  # the item's character has no counterpart
        shift = gap < new[:-1]
        source = begin.copy()
        new[:-1][shift] = gap[shift]
        source[:-1][shift] = begin[1:][shift]
        # Extra characters of the text run along the band: a running minimum.
        slope = new - steps
        least = np.minimum.accumulate(slope)
        origin = np.maximum.accumulate(np.where(slope == least, steps, 0))
        cost, begin = least + steps, source[origin]
        if cost.min() > k:
            return None
    cost = np.where(diagonal + len(item) <= len(text), cost, far)
    best = int(cost.argmin())
    if cost[best] > k:
        return None
    return int(cost[best]), int(begin[best]), int(diagonal[best]) + len(item)


def matches(text: str, items: Items) -> list[tuple[int, int, int, int]]:
    """(item_id, begin, end, edits) of the best occurrence of each item."""
    plain, places = normalise(text)
    best: dict[int, tuple[int, int, int]] = {}
    for i, low, high in regions(plain, items):
        got = align(items.texts[i], plain, low, high, int(items.budget[i]))
        if got:
            best[i] = min(best.get(i, got), got)
    out = []
    for i, (edits, a, b) in sorted(best.items()):
        if places is not None:
            a, b = int(places[a]), int(places[b - 1]) + 1
        out.append((items.ids[i], a, b, edits))
    return out


def benchmark_blocks(benchmark: DataFrame) -> list[Items]:
    """The items in blocks of bounded size and one q; null and blank texts are none."""
    blocks: list[Items] = []
    held: dict[int, list[tuple[int, str]]] = {}
    size: dict[int, int] = {}
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").distinct().toLocalIterator():
        text = normalise(row["text"])[0].strip()
        if not text:
            continue
        q = gram_length(len(text))
        if q in held and size[q] + len(text) > BLOCK_CHARS:
            blocks.append(Items.of(sorted(held.pop(q)), q))
        if q not in held:
            held[q], size[q] = [], 0
        held[q].append((row["item_id"], text))
        size[q] += len(text)
    return blocks + [Items.of(sorted(own), q) for q, own in sorted(held.items())]


_FOUND = "id long, mark long, item_id long, begin long, finish long, edits int"


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items in documents, each at its best occurrence.

    Texts are compared in lower case with white space runs as one space. Items
    of any length count, short ones within fewer edits (under ten characters:
    none). Null and empty texts hold nothing; an empty benchmark gives no rows; repeated
    rows give repeated results. Columns: id (doc_id), mark (hash of the text),
    item_id, begin and finish (characters of the text as it is), edits.
    """
    texts = documents.where("text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("mark"), "text"
    )
    spark = documents.sparkSession
    out = spark.createDataFrame([], _FOUND)
    for block in benchmark_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)  # bounded by BLOCK_CHARS

        def find(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            items = shared.value
            for batch in batches:
                rows = [
                    (doc, mark, *m)
                    for doc, mark, text in zip(batch["id"].astype("Int64"), batch["mark"], batch["text"])
                    for m in matches(text, items)
                ]
                frame = pd.DataFrame(rows, columns=["id", "mark", "item_id", "begin", "finish", "edits"])
                frame["id"] = frame["id"].astype("Int64")
                yield frame

        out = out.unionByName(texts.mapInPandas(find, _FOUND))
    return out
