"""Best-fit packing by a grouping genetic algorithm.

Documents become token pieces of at most one sequence's length. Full pieces
are a sequence each; the others are dealt by hash into blocks of bounded size,
each a packing problem of its own. On every block several islands evolve
packings: crossover injects whole well-filled sequences of one parent into the
other, removes the sequences that hold the same pieces again, and best-fits
the displaced pieces. After each epoch the islands' elites migrate by a
shuffle. A block stops early once a packing meets the lower bound.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeolus.llm.common import materialise
from aeolus.llm.shingles import mix, powers
from aeolus.llm.token_counts import tokenizer

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SEQUENCE = 1_024
#: Pieces in a block on average; a block's loss is below one sequence.
BLOCK = 4_096
ISLANDS, MEMBERS, EPOCHS, GENERATIONS = 2, 4, 2, 6
#: Sequences filled less than this, and each block's emptiest, are packed again,
#: in so many rounds at most; every round leaves a fraction of the pieces.
LOOSE, LEVELS = 0.9, 7
#: Pieces whose ids a Python worker keeps, some 50 MB; beyond that it starts afresh.
KEPT_PIECES = 1_000_000
#: Bytes encoded at a time, or one longer text; of texts above the second bound
#: the pieces are encoded one by one.
SEGMENT, LONG = 1 << 18, 1 << 23

# White space as the tokenizer's patterns have it: without U+001C to U+001F.
_WHITE = r"[^\S\x1c-\x1f]"
_PIECE = re.compile(rf"{_WHITE}*[\S\x1c-\x1f]+|{_WHITE}+")
_BOUNDARY = re.compile(rf"(?<=[\S\x1c-\x1f])(?={_WHITE})")

_PIECES = "_row long, doc_id long, piece int, start long, length long, ids_crc32 long"


# A word of Latin letters, with at most a space before it, is one pre-token.
_WORD = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


_PRE_TOKENS = regex.compile(public_tokenizers.PATTERN).findall


# -- tokens ---------------------------------------------------------------


def byte_letters() -> dict[int, int]:
    """The letter by which byte-level models write each byte: itself if it is
    visible, else the next one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(0x100) if b not in visible]
    return {b: b for b in visible} | {b: 0x100 + k for k, b in enumerate(other)}


_LETTERS = byte_letters()

_BYTES = np.random.default_rng(3).integers(1, 2**63, 256, dtype=np.uint64)
#: 1 white space, 2 comma and full stop, 3 letters.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 1
_KIND[[0x2C, 0x2E]] = 2
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 3
#: First two bytes of other white space, and of some other characters.
_WHITE_NEXT = np.zeros((256, 256), bool)
for _pair in {c.encode()[:2] for c in "\x85\xa0\u1680\u2000\u2028\u202f\u205f\u3000"}:
    _WHITE_NEXT[_pair[0], _pair[1]] = True
_WHITE_LEAD = _WHITE_NEXT.any(1)


def encode_piece(piece: str, name: str = TOKENIZER) -> np.ndarray:
    """Ids of a piece of text that begins and ends at stable boundaries.

    Its pre-tokens are told by the pattern of byte-level models; strings that
    may be special tokens are left to the library as a whole."""
    if _WORD.fullmatch(piece) or "<|" not in piece:  # no special token
        tokenize = tokenizer(name).model.tokenize
        parts = (w.encode().decode("latin-1").translate(_LETTERS) for w in _PRE_TOKENS(piece))
        return np.array([t.id for w in parts for t in tokenize(w)], "<u4")
    return np.array(tokenizer(name).encode(piece, add_special_tokens=False).ids, "<u4")


class PieceTable:
    """Ids of the pieces seen so far, found by 64-bit hashes."""

    def __init__(self, name: str):
        self.name = name
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, "<u4"), 0

    def place(self, hashes: np.ndarray, piece_of) -> np.ndarray:
        """Rows of the ascending hashes; new ones are encoded, ``piece_of`` gives them."""
        if len(self.hashes) > KEPT_PIECES or self.used > 8 * KEPT_PIECES:
            self.clear()
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        fresh = np.flatnonzero(new)
        if len(fresh):
            ids = [encode_piece(piece_of(k), self.name) for k in fresh.tolist()]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            end = self.used + int(sizes.sum())
            if end > len(self.flat):
                self.flat = np.concatenate([self.flat[: self.used], np.zeros(end, "<u4")])
            self.flat[self.used : end] = np.concatenate(ids)
            starts = self.used + np.cumsum(sizes) - sizes
            self.used = end
            self.hashes = np.insert(self.hashes, at[fresh], hashes[fresh])
            self.starts = np.insert(self.starts, at[fresh], starts)
            self.sizes = np.insert(self.sizes, at[fresh], sizes)
            at = np.searchsorted(self.hashes, hashes)
        return at


@lru_cache(maxsize=1)
def _table(name: str) -> PieceTable:
    return PieceTable(name)


def encode_bytes(data: np.ndarray, breaks: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of UTF-8 texts in a row, and how many ids stand before each of ``breaks``.

    ``breaks``: where texts begin, and the end. No pre-token reaches from
    something other than white space into white space, or from a letter into a
    comma or full stop, and none looks back, so the ids of a text are those of
    its pieces between such places. Texts here hold no white space but ASCII's.
    """
    kind = _KIND[data]
    first = np.zeros(len(data) + 1, bool)
    first[1:-1] = ((kind[1:] == 1) & (kind[:-1] != 1)) | ((kind[1:] == 2) & (kind[:-1] == 3))
    first[breaks] = True
    starts = np.flatnonzero(first[:-1])
    ends = np.append(starts[1:], len(data))
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    own, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    table = _table(name)
    row = table.place(own, lambda k: data[starts[at[k]] : ends[at[k]]].tobytes().decode())[which]
    sizes = table.sizes[row]
    before = np.concatenate(([0], np.cumsum(sizes)))
    ids = table.flat[np.repeat(table.starts[row] - before[:-1], sizes) + np.arange(before[-1])]
    return ids, before[np.searchsorted(starts, breaks)]


def encode_texts(texts: pa.Array, name: str = TOKENIZER) -> Iterator[np.ndarray]:
    """For each text its ids, as the tokenizer's library gives them; null: none."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SEGMENT, "right")) - 1)
        a, b = int(offsets[first]), int(offsets[last])
        if b - a > LONG or _other_white(data[a:b]):
            for text in texts.slice(first, last - first).to_pylist():
                parts = [encode_piece(p, name) for s in _segments(text) for p in _PIECE.findall(s)]
                yield np.concatenate([*parts, np.zeros(0, "<u4")])
        elif a == b:
            yield from (np.zeros(0, "<u4") for _ in range(first, last))
        else:
            ids, cuts = encode_bytes(data[a:b], offsets[first : last + 1] - a, name)
            yield from (ids[i:j] for i, j in zip(cuts, cuts[1:]))
        first = last


def _other_white(data: np.ndarray) -> bool:
    """Whether UTF-8 bytes may hold white space other than ASCII's."""
    lead = np.flatnonzero(_WHITE_LEAD[data])
    lead = lead[lead + 1 < len(data)]
    return bool((_WHITE_NEXT[data[lead], data[lead + 1]]).any())


def _segments(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > SEGMENT:
        cut = _BOUNDARY.search(text, at + SEGMENT)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def cut_points(n: int, most: int) -> list[int]:
    """Starts of the pieces of n ids; only the first may be shorter than ``most``."""
    first = n % most or most
    return [0, *range(first, n, most)]


def token_pieces(
    documents: DataFrame, name: str = TOKENIZER, end_id: int = END_ID, most: int = SEQUENCE
) -> DataFrame:
    """One row a piece of every document's ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield cut_batch(batch)

    def cut_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        for k, ids in enumerate(encode_texts(batch.column("text"), name)):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            starts = cut_points(len(ids), most)
            rows += [
                (k, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))
            ]
        k, *rest = (pa.array(x, t) for x, t in zip(
            zip(*rows) if rows else [()] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        ))
        return pa.RecordBatch.from_arrays(
            [batch.column("_row").take(k), batch.column("doc_id").take(k), *rest],
            ["_row", "doc_id", "piece", "start", "length", "ids_crc32"],
        )

    return documents.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).mapInArrow(cut, _PIECES)


# -- the genetic algorithm on one block -----------------------------------


def best_fit(lengths: list[int], order, most: int, bins: list[list[int]], free: list[int]) -> None:
    """Put each piece of ``order`` where the least room remains, in place."""
    by_free: dict[int, list[int]] = {}
    mask = 0
    for b, room in enumerate(free):
        if room:
            by_free.setdefault(room, []).append(b)
            mask |= 1 << room
    for item in order:
        n = lengths[item]
        fits = mask >> n
        if fits:
            room = n + ((fits & -fits).bit_length() - 1)
            own = by_free[room]
            b = own.pop()
            if not own:
                mask &= ~(1 << room)
        else:
            room, b = most, len(bins)
            bins.append([])
            free.append(most)
        bins[b].append(item)
        free[b] = room = room - n
        if room:
            by_free.setdefault(room, []).append(b)
            mask |= 1 << room


def lower_bound(lengths: list[int], most: int) -> int:
    """Sequences that any packing needs, by Martello and Toth's second bound.

    For each a: pieces over most - a stand alone as far as pieces of a or more
    go, pieces over the half need one sequence each, and what the middle ones
    leave must hold the pieces from a to the half.
    """
    n = np.bincount(np.asarray(lengths, int), minlength=most + 1)
    count, total = np.cumsum(n), np.cumsum(n * np.arange(most + 1))
    a, half = np.arange(1, most // 2 + 1), most // 2
    over_half = count[-1] - count[half]
    middle = count[most - a] - count[half]
    left = middle * most - (total[most - a] - total[half])
    small = total[half] - total[a - 1]
    return int(max(-(-total[-1] // most), over_half + np.max(np.maximum(0, -(-(small - left) // most)), initial=0)))


def _fitness(bins: list[list[int]], free: list[int], most: int) -> tuple:
    """Few sequences first, then unequal filling, which leaves more to improve."""
    return -len(bins), sum(((most - r) / most) ** 2 for r in free) / max(1, len(bins))


def replace_by_larger(lengths: list[int], bins: list[list[int]], free: list[int], displaced: list[int]) -> None:
    """Fill sequences better with displaced pieces, in place.

    One or two pieces of a sequence give way to a larger displaced one that
    still fits, or one to two: smaller pieces are easier to place afterwards.
    """
    if not displaced:
        return
    out = sorted(displaced, key=lengths.__getitem__)
    sizes = [lengths[i] for i in out]

    def fitting(low: int, high: int) -> int | None:
        """Place of the largest displaced length above ``low`` and up to ``high``."""
        k = bisect_right(sizes, high) - 1
        return k if k >= 0 and sizes[k] > low else None

    def swap(b: int, leave: list[int], take: list[int]) -> None:
        bins[b] = [i for i in bins[b] if i not in leave] + [out[k] for k in take]
        free[b] += sum(lengths[i] for i in leave) - sum(sizes[k] for k in take)
        for k in sorted(take, reverse=True):
            del out[k], sizes[k]
        for i in leave:
            k = bisect_right(sizes, lengths[i])
            out.insert(k, i)
            sizes.insert(k, lengths[i])

    for b in range(len(bins)):
        while free[b] and out:
            best: tuple[int, list[int], list[int]] | None = None
            own = sorted({lengths[i]: i for i in bins[b]}.values(), key=lengths.__getitem__)
            groups = [[i] for i in own] + [[i, j] for x, i in enumerate(own) for j in own[x + 1 :]]
            for leave in groups:
                given = sum(lengths[i] for i in leave)
                k = fitting(given, given + free[b])
                if k is not None and (best is None or sizes[k] - given > best[0]):
                    best = (sizes[k] - given, leave, [k])
                if len(leave) == 1 and len(out) > 1:
                    # Two for one: the largest that leaves room for another.
                    first = bisect_right(sizes, given + free[b] - sizes[0]) - 1
                    if first > 0:
                        second = min(bisect_right(sizes, given + free[b] - sizes[first]) - 1, first - 1)
                        gain = sizes[first] + sizes[second] - given if second >= 0 else 0
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, leave, [first, second])
            if best is None:
                break
            swap(b, best[1], best[2])
    displaced[:] = out


def crossover(
    lengths: list[int], most: int, one: list[list[int]], other: list[list[int]], rng: np.random.Generator
) -> tuple[list[list[int]], list[int]]:
    """Well-filled sequences of ``other`` in ``one``; displaced pieces best-fitted."""
    room = [most - sum(map(lengths.__getitem__, b)) for b in other]
    full = sorted(range(len(other)), key=room.__getitem__)[: max(1, len(other) // 2)]
    a, b = sorted(rng.integers(0, len(full) + 1, 2).tolist())
    inject = [other[k] for k in full[a : max(b, a + 1)]]
    taken = {i for own in inject for i in own}
    bins, displaced = [list(x) for x in inject], []
    for own in one:
        if taken.isdisjoint(own):
            bins.append(list(own))
        else:
            displaced += [i for i in own if i not in taken]
    free = [most - sum(map(lengths.__getitem__, x)) for x in bins]
    # Mutation: the emptiest sequences give up their pieces too.
    for k in sorted(sorted(range(len(bins)), key=lambda k: -free[k])[: 1 + len(bins) // 50], reverse=True):
        if free[k]:
            displaced += bins.pop(k)
            free.pop(k)
    replace_by_larger(lengths, bins, free, displaced)
    displaced.sort(key=lambda i: -lengths[i])
    best_fit(lengths, displaced, most, bins, free)
    return bins, free


def evolve(
    lengths: list[int], most: int, population: list[list[list[int]]], rng: np.random.Generator,
    members: int = MEMBERS, generations: int = GENERATIONS,
) -> list[list[list[int]]]:
    """The best packings after some generations, the best first."""
    scored = []
    for bins in population:
        free = [most - sum(map(lengths.__getitem__, b)) for b in bins]
        scored.append((_fitness(bins, free, most), bins))
    while len(scored) < members:
        bins, free = [], []
        noise = rng.normal(0, most / 50 if scored else 0, len(lengths))
        best_fit(lengths, np.argsort(-(np.array(lengths) + noise), kind="stable").tolist(), most, bins, free)
        scored.append((_fitness(bins, free, most), bins))
        if not scored[-1][0][0] + lower_bound(lengths, most):
            break  # optimal
    scored.sort(key=lambda x: x[0], reverse=True)
    least = lower_bound(lengths, most)
    for _ in range(generations):
        if -scored[0][0][0] <= least or len(scored) < 2:
            break
        one, other = rng.choice(len(scored), 2, replace=False)
        bins, free = crossover(lengths, most, scored[one][1], scored[other][1], rng)
        scored.append((_fitness(bins, free, most), bins))
        scored = sorted(scored, key=lambda x: x[0], reverse=True)[:members]
    return [bins for _, bins in scored]


def _to_bytes(bins: list[list[int]], n: int) -> bytes:
    out = np.empty(n, "<i4")
    for k, own in enumerate(bins):
        out[own] = k
    return out.tobytes()


def _from_bytes(packed: bytes) -> list[list[int]]:
    of = np.frombuffer(packed, "<i4")
    order = np.argsort(of, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)]


# -- Spark ----------------------------------------------------------------

_STATE = "block long, island int, home boolean, n_bins int, lengths binary, packed binary"


def pack_blocks(
    items: DataFrame, most: int, islands: int = ISLANDS, epochs: int = EPOCHS,
    members: int = MEMBERS, generations: int = GENERATIONS, tasks: int = 1,
) -> DataFrame:
    """Pack (block, _row, piece, length, ...); adds sequence_id and offset.

    The state of a block is small and its evolution is not, so the number of
    ``tasks`` is given, not told from the bytes."""
    kept = [c for c in items.columns if c != "block"]
    order = ["doc_id", "_row", "piece"]

    def start(key, group: pd.DataFrame) -> pd.DataFrame:
        lengths = group.sort_values(order)["length"].to_numpy("<i4").tobytes()
        return pd.DataFrame({
            "block": key[0], "island": range(islands), "home": True, "n_bins": 0,
            "lengths": lengths, "packed": [None] * islands,
        })

    def epoch(number: int):
        def run(key, group: pd.DataFrame) -> pd.DataFrame:
            block, island = int(key[0]), int(key[1])
            rng = np.random.default_rng([block, island, number])
            lengths = np.frombuffer(group["lengths"].iloc[0], "<i4").tolist()
            before = [_from_bytes(p) for p in sorted({p for p in group["packed"] if p is not None})]
            found = evolve(lengths, most, before, rng, members, generations)
            rows = [(block, island, True, b) for b in found]
            if islands > 1 and number + 1 < epochs:
                rows.append((block, (island + 1) % islands, False, found[0]))
            return pd.DataFrame({
                "block": [r[0] for r in rows], "island": [r[1] for r in rows],
                "home": [r[2] for r in rows], "n_bins": [len(r[3]) for r in rows],
                "lengths": group["lengths"].iloc[0],
                "packed": [_to_bytes(r[3], len(lengths)) for r in rows],
            })

        return run

    state = items.groupBy("block").applyInPandas(start, _STATE)
    for number in range(epochs):
        state = state.repartition(tasks, "block", "island").groupBy("block", "island").applyInPandas(
            epoch(number), _STATE
        )
    best = state.groupBy("block").agg(
        F.min_by("packed", F.struct("n_bins", "island", "packed")).alias("packed")
    )

    def place(key, group: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = group.sort_values(order)[kept].copy()
        bins = np.frombuffer(found["packed"].iloc[0], "<i4")
        out["sequence_id"] = bins.astype("int64") + (int(key[0]) << 32)
        out["offset"] = out.groupby("sequence_id")["length"].cumsum() - out["length"]
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return items.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(
        place, f"{_PIECES}, sequence_id long, offset long"
    )


def pack_documents(
    documents: DataFrame, name: str = TOKENIZER, end_id: int = END_ID, most: int = SEQUENCE,
    *, block: int = BLOCK, **evolution,
) -> DataFrame:
    """Pack the ids of all documents into few sequences of at most ``most`` ids.

    Null text: empty, so the end id alone. Repeated rows are packed each. Only
    documents longer than a sequence are cut; their first piece is the shorter
    one. Sequences that a block leaves loosely filled are packed again with
    those of other blocks. Columns: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.
    """
    pieces = materialise(token_pieces(documents, name, end_id, most), "pieces")
    out = pieces.where(F.col("length") >= most).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    columns = pieces.columns
    items = pieces.where(F.col("length") < most)
    parallel = 4 * documents.sparkSession.sparkContext.defaultParallelism
    islands = evolution.get("islands", ISLANDS)
    for level in range(LEVELS):
        blocks = max(1, -(-items.count() // block))
        dealt = items.withColumn("block", F.pmod(F.xxhash64("_row", "piece", F.lit(level)), F.lit(blocks)))
        packed = pack_blocks(dealt, most, tasks=min(blocks * islands, parallel), **evolution).withColumn(
            "sequence_id", F.col("sequence_id") + F.lit(level << 60)
        )
        if blocks == 1 or level + 1 == LEVELS:
            out = out.unionByName(packed)
            break
        packed = materialise(packed, "packed")
        filled = packed.groupBy("sequence_id").agg(F.sum("length").alias("filled"))
        emptiest = Window.partitionBy(F.shiftright("sequence_id", 32)).orderBy("filled", "sequence_id")
        filled = filled.withColumn("place", F.row_number().over(emptiest)).withColumn(
            "loose", (F.col("place") == 1) | (F.col("filled") < LOOSE * most)
        )
        filled = materialise(filled.select("sequence_id", "filled", "loose"), "filled")
        seen = filled.agg(
            F.count("*").alias("all"), F.count_if("loose").alias("loose"),
            F.sum(F.when(F.col("loose"), F.col("filled"))).alias("held"),
        ).first()
        # Nothing to gain, or pieces that only fit so loosely.
        if -(-seen["held"] // most) >= seen["loose"] or 2 * seen["loose"] > seen["all"]:
            out = out.unionByName(packed)
            break
        loose = filled.where("loose").select("sequence_id")
        out = out.unionByName(packed.join(loose, "sequence_id", "left_anti"))
        items = packed.join(loose, "sequence_id", "left_semi").select(*columns)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
