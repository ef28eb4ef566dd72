"""Periodic runs of words, found by difference-cover LCE on a harmonic grid.

A run of period p covers two neighbouring multiples of p. So for every period
the pairs of neighbouring grid places are tested, n/1 + n/2 + ... in all, and a
pair of a run is extended both ways by longest common extensions (LCE).

An LCE index sorts only the suffixes that start at places whose remainder is in
a difference cover: any two places reach sampled ones after the same few words.
A query compares those few words, and the rest is a range minimum over the
common prefixes of neighbouring sorted samples, from a sparse table. The same
index over the reversed words extends backwards. Documents are taken in blocks
of bounded size, each document whole; those without a pair worth extending
need no index.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeolus.llm.shingles import mix

#: Least length of a run in words, and in periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Difference cover: the differences of these remainders are all remainders.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Characters of the documents in one block, or one longer document.
BLOCK_CHARS = 2_000_000
#: LCE queries answered at a time.
QUERIES = 1 << 16

_KINDS = [
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
    ("collapsed_sha256", pa.string()),
]
_SCHEMA = ", ".join(f"{name} {'string' if kind == pa.string() else 'long'}" for name, kind in _KINDS)


def _meeting_steps() -> np.ndarray:
    """For two remainders the least step after which both are in the cover."""
    steps = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    cover = np.isin(np.arange(MODULUS), COVER)
    for step in range(MODULUS - 1, -1, -1):
        there = np.roll(cover, -step)
        steps[np.ix_(there, there)] = step
    return steps


_STEPS = _meeting_steps()


class LCE:
    """Longest common extensions of places in the same document.

    ``words``: ids of the words of all documents in a row; ``ends``: for each
    word, where its document ends.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        self.words, self.ends, self.n = words, ends, len(words)
        # Beyond the end no word is equal to another one.
        self.padded = np.concatenate([words, np.full(MODULUS, -1, words.dtype)])
        places = np.arange(self.n)
        self.samples = places[np.isin(places % MODULUS, COVER)]
        self._sort()

    def _sort(self) -> None:
        """Order of the sampled suffixes, and common prefixes of neighbours."""
        m = len(self.samples)
        number = np.full(self.n + 1, m, np.int64)  # of the sample at a place
        number[self.samples] = np.arange(m)
        left = self.ends[self.samples] - self.samples
        at = self.samples[:, None] + np.arange(MODULUS)
        block = (self.padded[at] + 1).astype(">u4")
        block[np.arange(MODULUS) >= left[:, None]] = 0  # sorts before every word
        rows = np.ascontiguousarray(np.concatenate([self.ends[self.samples, None].astype(">u4"), block], 1))
        rank = np.unique(rows.view(f"V{rows.shape[1] * 4}").ravel(), return_inverse=True)[1].astype(np.int64)
        # A sample's place plus the modulus is sampled too, so ranks of twice
        # the length come from pairs of ranks until all differ.
        levels, width = [rank], MODULUS
        while m and rank.max() + 1 < m:
            after = np.where(left > width, number[np.minimum(self.samples + width, self.n)], m)
            second = np.append(rank, -1)[after] + 1
            rank = np.unique(rank * (m + 1) + second, return_inverse=True)[1].astype(np.int64)
            levels.append(rank)
            width *= 2
        order = np.argsort(rank)
        self.place = np.full(self.n + 1, -1, np.int64)  # in the order, of each sampled place
        self.place[self.samples[order]] = np.arange(m)
        # Common prefixes of neighbours: whole blocks by ranks, then words.
        a, b = order[:-1], order[1:]
        common = np.zeros(max(0, m - 1), np.int64)
        alive = self.ends[self.samples[a]] == self.ends[self.samples[b]]
        for k in range(len(levels) - 1, -1, -1):
            padded = np.append(levels[k], -1)
            x, y = (np.where(alive & (self.samples[s] + common < self.ends[self.samples[s]]),
                             number[np.minimum(self.samples[s] + common, self.n)], m) for s in (a, b))
            same = (x < m) & (y < m) & (padded[x] == padded[y])
            common[same] += MODULUS << k
        common += self._direct(self.samples[a] + common, self.samples[b] + common, alive, MODULUS)
        common[~alive] = 0
        self.table = [common]
        while 2 << len(self.table) - 1 <= len(common):
            half, last = 1 << len(self.table) - 1, self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _direct(self, i: np.ndarray, j: np.ndarray, alive: np.ndarray, steps) -> np.ndarray:
        """Equal words from two places on, of at most so many."""
        out = np.zeros(len(i), np.int64)
        steps = np.broadcast_to(steps, len(i))
        live = np.flatnonzero(alive & (steps > 0))
        while len(live):
            x, y = i[live] + out[live], j[live] + out[live]
            # The document's end by the later place's last word.
            inside = np.maximum(x, y) < np.minimum(
                self.ends[np.minimum(i[live], self.n - 1)], self.ends[np.minimum(j[live], self.n - 1)]
            )
            live, x, y = live[inside], x[inside], y[inside]
            live = live[self.words[x] == self.words[y]]
            out[live] += 1
            live = live[out[live] < steps[live]]
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from i and from j on, i < j in the same document."""
        out = np.zeros(len(i), np.int64)
        for at in range(0, len(i), QUERIES):
            a, b = i[at : at + QUERIES], j[at : at + QUERIES]
            step = _STEPS[a % MODULUS, b % MODULUS]
            own = self._direct(a, b, np.ones(len(a), bool), step)
            far = np.flatnonzero((own == step) & (b + step < self.ends[b]))
            x, y = (self.place[s[far] + step[far]] for s in (a, b))
            low, high = np.minimum(x, y), np.maximum(x, y)
            size = np.frexp(high - low)[1].astype(np.int64) - 1  # of two ranges that cover it
            rest = np.zeros(len(far), np.int64)
            for k in np.unique(size):
                here = size == k
                t = self.table[k]
                rest[here] = np.minimum(t[low[here]], t[high[here] - (1 << k)])
            own[far] += rest
            out[at : at + QUERIES] = own
        return out


def find_runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs (document, start, length, period) of documents in a row.

    ``words``: ids of all words; ``sizes``: words of each document. Starts are
    counted within the document; rows are in order of document, start, period.
    """
    n = len(words)
    none = np.zeros((0, 4), np.int64)
    if not n or sizes.max() < LEAST_WORDS:
        return none
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # A run's first grid place and the next one have this many words in common
    # at least; hashes of so many words and the document sort out other pairs.
    gram = min(
        max(LEAST_WORDS, LEAST_PERIODS * p) - 2 * p + 1 for p in range(1, LEAST_WORDS + 1)
    )
    weights = np.random.default_rng(13).integers(1, 2**63, gram, dtype=np.uint64) | np.uint64(1)
    base = mix(words.astype(np.uint64) + np.uint64(1))
    hashed = owner[: max(0, n - gram + 1)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(gram):
        hashed = hashed + base[k : k + len(hashed)] * weights[k]
    found = []
    for p in range(1, int(sizes.max()) // LEAST_PERIODS + 1):
        grid = hashed[::p]
        k = np.flatnonzero(grid[1:] == grid[:-1])
        if len(k):
            found.append(np.stack([k * p, np.full(len(k), p)]))
    if not found:
        return none
    i, p = np.concatenate(found, 1)
    same = owner[i] == owner[i + p]
    i, p = i[same], p[same]
    # Only documents with such a pair are indexed.
    wanted = np.unique(owner[i])
    if not len(wanted):
        return none
    inside = np.isin(owner, wanted)
    own_sizes = sizes[wanted]
    starts = np.concatenate([[0], np.cumsum(own_sizes)])
    shift = (starts[:-1] - cuts[wanted])[np.searchsorted(wanted, owner[i])]
    kept, i = words[inside], i + shift
    doc = np.repeat(np.arange(len(wanted)), own_sizes)
    j = i + p
    forward = LCE(kept, starts[1:][doc])(i, j)
    least = np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
    long = forward >= least - 2 * p + 1
    i, j, p, forward, least = i[long], j[long], p[long], forward[long], least[long]
    if not len(i):
        return none
    # Backwards: the same on the reversed words, from the places before.
    m = len(kept)
    back = np.zeros(len(i), np.int64)
    open_ = np.flatnonzero(i > starts[doc[i]])
    back[open_] = LCE(kept[::-1].copy(), (m - starts[:-1][doc])[::-1].copy())(m - j[open_], m - i[open_])
    start, length = i - back, back + p + forward
    good = (back < p) & (length >= least)  # the run's first grid place
    runs = np.stack([wanted[doc[i]], start - starts[doc[i]], length, p], 1)[good]
    # A stretch found by several periods counts with the smallest.
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :3] != runs[:-1, :3]).any(1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def planted(n: int, doc_id: int | None) -> np.ndarray:
    """Which of its n words a document has at each place.

    Every tenth document, by the CRC-32 of its id in decimal digits (null: no
    digits), repeats a stretch of its words to the end.
    """
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    at = np.arange(n)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


def _describe(doc_id, words: list[bytes], runs: np.ndarray) -> tuple:
    """A result row: runs are rows of start, length, period."""
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(edges)[:-1] > 0
    kept = [w for w, gone in zip(words, dropped.tolist()) if not gone] if len(runs) else words
    listed = runs.tolist()
    best = min(listed, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id, len(listed), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in listed).encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def describe_documents(ids: list, texts: list[str | None], plant: bool = True) -> list[tuple]:
    """Result rows of a block of documents."""
    table: dict[bytes, int] = {}
    known = table.setdefault
    words, numbers, sizes = [], [], []
    for doc_id, text in zip(ids, texts):
        own = (text or "").encode().split()  # bytes are split at ASCII white space alone
        if plant:
            at = planted(len(own), doc_id)
            own = [own[k] for k in at.tolist()]
        words.append(own)
        numbers += [known(w, len(table)) for w in own]
        sizes.append(len(own))
    runs = find_runs(np.array(numbers, np.int32), np.array(sizes, np.int64))
    cuts = np.searchsorted(runs[:, 0], np.arange(len(ids) + 1))
    return [
        _describe(doc_id, own, runs[a:b, 1:]) for doc_id, own, a, b in zip(ids, words, cuts, cuts[1:])
    ]


def periodic_runs(documents: DataFrame, *, plant: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The periodic runs of words in every whole text.

    Words are runs of anything but ASCII white space. A run has its smallest
    period q, at least 24 words and 3 periods, and no neighbouring word extends
    it. Null, empty and blank texts have no words and no runs: four nulls and
    the checksums of empty strings. Repeated rows are each described. With
    ``plant`` every tenth document first gets a repeated stretch (``planted``).

    Columns: doc_id, n_runs; of the run of most periods start, length, period,
    exponent_milli; runs_sha256 of all runs; collapsed_sha256 of the text
    without what runs repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
            block = np.cumsum(sizes) // block_chars
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                rows = describe_documents(ids[a:b], texts.slice(a, b - a).to_pylist(), plant)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, (_, k) in zip(zip(*rows), _KINDS)], [name for name, _ in _KINDS]
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)
