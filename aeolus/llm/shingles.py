"""Word shingles of whole texts as 64-bit hashes, computed on Arrow's bytes.

Words are runs of anything but ASCII white space, compared after lower-casing
A-Z. A word's hash is a polynomial over its bytes, taken from running sums, so
that all words of a batch are hashed in a few numpy steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time.
SEGMENT = 1 << 18

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base modulo 2**64, and of its inverse."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, SEGMENT + 1)
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def _words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words; ``breaks`` are places where a word ends too."""
    letter = ~_SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, letter
    starts = letter & ~before[:-1]
    starts[breaks] |= letter[breaks]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:-1] = letter[:-1] & ~letter[1:]
    ends[-1] = letter[-1]
    ends[breaks] |= before[breaks]
    a, b = np.flatnonzero(starts), np.flatnonzero(ends)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return a, mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))


def _long_words(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one long text, in pieces cut at white space."""
    out, at = [], 0
    spaces = np.flatnonzero(_SPACE[data])
    while at < len(data):
        k = np.searchsorted(spaces, at + SEGMENT)
        end = int(spaces[k]) + 1 if k < len(spaces) else len(data)
        out.append(_words(data[at:end], np.zeros(0, int))[1])
        at = end
    return np.concatenate(out)


def _combine(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles; fewer words: of the whole sequence as one."""
    k = min(n, len(words))
    rows = len(words) - k + 1
    h = np.full(rows, k, np.uint64)
    for i in range(k):
        h = h + words[i : i + rows] * _PLACE[i]
    return mix(h)


def word_sequences(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its words in order; null: none."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SEGMENT, "right")) - 1)
        a, b = int(offsets[first]), int(offsets[last])
        if b - a > SEGMENT:
            yield _long_words(data[a:b])
        elif a == b:
            yield from (np.zeros(0, np.uint64) for _ in range(first, last))
        else:
            own = offsets[first : last + 1] - a
            starts, hashes = _words(data[a:b], own[(own > 0) & (own < b - a)])
            cuts = np.searchsorted(starts, own)
            yield from (hashes[i:j] for i, j in zip(cuts, cuts[1:]))
        first = last


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as ascending 64-bit hashes; null: none."""
    for words in word_sequences(texts):
        yield np.unique(_combine(words, n)) if len(words) else words
