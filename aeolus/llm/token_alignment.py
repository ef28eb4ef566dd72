"""Alignment of two tokenizers' tokens over the same bytes, by as-of joins.

Both tokenizers encode a text; a token's place is its range of bytes. In a
block of documents ``pandas.merge_asof``, keyed by document, finds for each
token start the other side's covering token, and the union of both directions
is every overlap. Where both sides have a token end, a group ends.

How many documents of the corpus hold an id pair linked is a grouped sum over
the blocks' own counts. A block is one row: its id pairs, and per document
which of them it holds how often. So only a block's distinct pairs are
shuffled, and the corpus-wide counts come back to the block the same way.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeolus.llm.common import by_size, materialise
from aeolus.llm.packing import byte_letters
from aeolus.llm.shingles import mix, powers

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of the documents in one block, or one longer document.
BLOCK_CHARS = 2_000_000
#: Pieces of text whose ids a Python worker keeps, in some 50 MB; beyond that it
#: starts afresh.
KEPT_PIECES = 1_000_000
#: Parts into which the blocks that hold one id pair are dealt.
SALTS = 16
_B_BITS = 24

_BYTES = np.random.default_rng(12).integers(1, 2**63, 256, dtype=np.uint64)


# -- the two tokenizers ---------------------------------------------------


class Tokenizer:
    """Ids of a text, and the bytes of each id.

    ``cuts(data, first)`` marks the places of UTF-8 bytes at which the ids on
    one side never depend on the other side; what stands between them is
    encoded once and kept, up to a bound. Whether its ids spell it is kept too.
    """

    def __init__(self, pieces: list[bytes], encode: Callable[[list[bytes]], list[list[int]]], cuts: Callable):
        self.pieces, self.encode, self.cuts = pieces, encode, cuts
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.at, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.spelled = np.zeros(0, bool)
        self.ids = np.zeros(0, np.int32)

    def _rows(self, hashes: np.ndarray, piece: Callable[[int], bytes]) -> np.ndarray:
        """Rows of the distinct hashes; pieces not known yet are encoded."""
        if len(self.hashes) > KEPT_PIECES or len(self.ids) > 6 * KEPT_PIECES:
            self.clear()
        row = np.searchsorted(self.hashes, hashes)
        fresh = np.flatnonzero((row == len(self.hashes)) | (np.append(self.hashes, 0)[row] != hashes))
        if len(fresh):
            fresh = fresh[np.argsort(hashes[fresh])]
            parts = [piece(k) for k in fresh.tolist()]
            ids = self.encode(parts)
            spell = self.pieces.__getitem__
            spelled = [b"".join(map(spell, i)) == part for i, part in zip(ids, parts)]
            counts = np.fromiter(map(len, ids), np.int32, len(ids))
            at = (len(self.ids) + np.cumsum(counts) - counts).astype(np.int32)
            self.ids = np.concatenate([self.ids, np.fromiter((x for i in ids for x in i), np.int32, int(counts.sum()))])
            for name, new in (("at", at), ("counts", counts), ("spelled", spelled), ("hashes", hashes[fresh])):
                setattr(self, name, np.insert(getattr(self, name), row[fresh], new))
            row = np.searchsorted(self.hashes, hashes)
        return row

    def __call__(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts in a row; how many stand before each edge; which texts they spell."""
        first = np.zeros(len(data) + 1, bool)
        self.cuts(data, first)
        first[edges] = True
        starts = np.flatnonzero(first[:-1])
        ends = np.append(starts[1:], len(data))
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * up[: len(data)], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        which, own = pd.factorize(hashes)
        at = np.empty(len(own), np.int64)
        at[which] = np.arange(len(which))
        row = self._rows(own, lambda k: data[starts[at[k]] : ends[at[k]]].tobytes())[which]
        counts = self.counts[row]
        before = np.zeros(len(row) + 1, np.int64)
        np.cumsum(counts, out=before[1:])
        ids = self.ids[np.repeat(self.at[row] - before[:-1], counts) + np.arange(before[-1])]
        # A piece whose ids lose something is shorter, so nothing makes up for it.
        spelled = np.ones(len(edges) - 1, bool)
        spelled[np.searchsorted(edges, starts[~self.spelled[row]], "right") - 1] = False
        return ids, before[np.searchsorted(starts, edges)], spelled


#: Last two bytes of white space beyond ASCII, as regular expressions have it.
_WHITE_END = np.zeros((256, 256), bool)
for _c in "\x85\xa0                　":
    _WHITE_END[_c.encode()[-2], _c.encode()[-1]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def _byte_level_cuts(data: np.ndarray, first: np.ndarray) -> None:
    """Before a space after something else; between a letter and , or full stop.

    The pre-tokens are a space at most with letters, with digits or with other
    visible characters, or white space; no pattern looks back.
    """
    before = data[:-1]
    visible = (before > 0x20) & (before != 0x7F)
    visible[1:] &= ~_WHITE_END[before[:-1], before[1:]]
    after_letter = _LETTER[before] & ((data[1:] == 0x2C) | (data[1:] == 0x2E))
    first[1:-1] = ((data[1:] == 0x20) & visible) | after_letter


@lru_cache(maxsize=2)
def byte_level(name: str = TOKENIZER_A) -> Tokenizer:
    """A byte-level model; strings of special tokens are plain text."""
    import tokenizers

    model = tokenizers.Tokenizer.from_file(public_tokenizers.path(name))
    model.encode_special_tokens = True
    if model.normalizer is not None or '"ByteLevel"' not in model.to_str() or "add_prefix_space=False" not in str(model.pre_tokenizer):
        raise ValueError(f"{name} is no plain byte-level model")
    letters = byte_letters()
    of_letter = {chr(v): k for k, v in letters.items()}
    words, tokenize = regex.compile(public_tokenizers.PATTERN).findall, model.model.tokenize
    pieces = []
    for k in range(model.get_vocab_size()):
        token = model.id_to_token(k)
        plain = all(c in of_letter for c in token)
        pieces.append(bytes(of_letter[c] for c in token) if plain else token.encode())

    def encode(parts: list[bytes]) -> list[list[int]]:
        return [
            [t.id for w in words(p.decode()) for t in tokenize(w.encode().decode("latin-1").translate(letters))]
            for p in parts
        ]

    return Tokenizer(pieces, encode, _byte_level_cuts)


def _space_cuts(data: np.ndarray, first: np.ndarray) -> None:
    first[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)


@lru_cache(maxsize=2)
def space_pieces(name: str = TOKENIZER_B) -> Tokenizer:
    """A model whose pieces write a space as U+2581 and that adds one in front.

    No piece may have such a space after something else, so that nothing is
    merged across it; that is checked here.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    space = "▁"
    names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    if any(re.search(f"[^{space}]{space}", p) for p in names) or model.encode("a  b ") != (
        model.encode("a") + [model.piece_to_id(space)] + model.encode("b") + [model.piece_to_id(space)]
    ):
        raise ValueError(f"{name} merges across spaces")
    pieces = [
        bytes([int(p[3:-1], 16)]) if model.is_byte(k) else p.replace(space, " ").encode()
        for k, p in enumerate(names)
    ]
    alone = [model.piece_to_id(space)]

    def encode(parts: list[bytes]) -> list[list[int]]:
        # Each part begins with the space that the model adds.
        return [ids or alone for ids in model.encode([p[1:].decode() for p in parts], num_threads=1)]

    return Tokenizer(pieces, encode, _space_cuts)


# -- overlaps -------------------------------------------------------------


def overlaps(start_a: np.ndarray, doc_a: np.ndarray, start_b: np.ndarray, doc_b: np.ndarray):
    """Pairs (i, j) of tokens whose bytes overlap; both sides cover every byte.

    Starts ascend over all documents of the block.
    """
    def covering(start, doc, other_start, other_doc):
        found = pd.merge_asof(
            pd.DataFrame({"at": start, "doc": doc}),
            pd.DataFrame({"at": other_start, "doc": other_doc, "token": np.arange(len(other_start))}),
            on="at", by="doc",
        )
        return found["token"].to_numpy(np.int64)

    of_a = covering(start_a, doc_a, start_b, doc_b)
    of_b = covering(start_b, doc_b, start_a, doc_a)
    inner = np.flatnonzero(start_a[of_b] < start_b)  # equal starts are found from the other side
    return np.concatenate([np.arange(len(start_a)), of_b[inner]]), np.concatenate([of_a, inner])


@lru_cache(maxsize=2)
def _digit_table(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to ``most`` as bytes in one number, and how many each has."""
    text = np.arange(most + 1).astype("S7")
    return np.frombuffer(text.astype("S8").tobytes(), "<u8"), np.char.str_len(text).astype(np.int64)


def spell_groups(ids_a, ids_b, group_a, group_b, doc_b, n_docs: int) -> tuple[bytes, np.ndarray]:
    """All documents' groups as ``a1,a2|b1;a3|b2,b3`` in a row, and each one's place.

    ``group_a``, ``group_b``: ascending group numbers over the whole block, from 0.
    """
    n_groups = int(group_a[-1]) + 1
    in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    at_a = np.arange(len(ids_a)) + (np.cumsum(in_b) - in_b)[group_a]
    at_b = np.arange(len(ids_b)) + np.cumsum(in_a)[group_b]
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    ids[at_a], ids[at_b] = ids_a, ids_b
    after = np.full(len(ids), ord(","), np.uint64)
    after[at_a[np.cumsum(in_a) - 1]] = ord("|")
    after[at_b[np.cumsum(in_b) - 1]] = ord(";")
    last = at_b[np.flatnonzero(np.diff(doc_b, append=n_docs))]
    after[last] = 0  # nothing after a document's last id
    digits, counts = _digit_table(int(max(ids_a.max(), ids_b.max())) | 0xFFFF)
    size = counts[ids]
    text = digits[ids] | (after << (size * 8).astype(np.uint64))
    size += after > 0
    return text.tobytes().translate(None, b"\0"), np.concatenate([[0], np.cumsum(size)[last]])


# -- blocks ---------------------------------------------------------------

_BLOCK = [
    ("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())),
    ("n_b", pa.list_(pa.int64())), ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())),
    ("groups_sha256", pa.list_(pa.string())), ("held", pa.list_(pa.int32())), ("which", pa.binary()),
    ("times", pa.binary()), ("pair", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())),
]
_BLOCK_SCHEMA = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>,"
    " groups_sha256 array<string>, held array<int>, which binary, times binary, pair array<long>, docs array<long>"
)


def _narrow(x: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest needs; that number comes first."""
    most = int(x.max()) if len(x) else 0
    size = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([size]) + x.astype(f"<u{size}").tobytes()


def _widen(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def align(texts: list[str | None], a: Tokenizer, b: Tokenizer) -> dict:
    """Tokens, links and groups of the documents of a block.

    Numbers of the documents without tokens are 0 and their checksum is ''.
    Also, per document, which of the block's id pairs it holds linked
    (``held`` of them each, ``which`` and how many ``times``), and per pair the
    ``docs`` that hold it.
    """
    n = len(texts)
    out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links", "held")}
    out |= {"groups_sha256": [""] * n, "which": np.zeros(0, np.int64), "times": np.zeros(0, np.int64),
            "pair": np.zeros(0, np.int64), "docs": np.zeros(0, np.int64)}
    own = [k for k, t in enumerate(texts) if t]
    raw = [b" " + texts[k].encode() for k in own]
    if not raw:
        return out
    data = np.frombuffer(b"".join(raw), np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    sides = [model(data, edges) for model in (a, b)]
    good = sides[0][2] & sides[1][2]
    keep = np.array(own)[good]
    if not len(keep):
        return out
    m, number = len(keep), np.cumsum(good) - 1
    kept = []
    for model, (ids, cuts, _) in zip((a, b), sides):
        doc = np.repeat(number, np.diff(cuts))
        if m < len(own):
            there = np.repeat(good, np.diff(cuts))
            ids, doc = ids[there], doc[there]
        kept.append((ids.astype(np.int64), doc, np.cumsum(model.sizes[ids])))
    (ids_a, doc_a, end_a), (ids_b, doc_b, end_b) = kept
    start_a, start_b = end_a - a.sizes[ids_a], end_b - b.sizes[ids_b]
    i, j = overlaps(start_a, doc_a, start_b, doc_b)

    ends = np.zeros(int(end_a[-1]) + 1, np.int8)
    ends[end_a] += 1
    ends[end_b] += 1
    both = np.cumsum(ends == 2, dtype=np.int32)  # groups that end up to each byte
    group_a, group_b = both[start_a], both[start_b]
    flat, at = spell_groups(ids_a, ids_b, group_a, group_b, doc_b, m)
    for k, x, y in zip(keep.tolist(), at[:-1].tolist(), at[1:].tolist()):
        out["groups_sha256"][k] = hashlib.sha256(flat[x:y]).hexdigest()
    last_b = np.flatnonzero(np.diff(doc_b, append=m))
    out["n_a"][keep] = np.bincount(doc_a, minlength=m)
    out["n_b"][keep] = np.bincount(doc_b, minlength=m)
    out["n_groups"][keep] = np.diff(group_b[last_b], prepend=-1)
    out["n_links"][keep] = np.bincount(doc_a[i], minlength=m)

    order = np.argsort(doc_a[i], kind="stable")
    i, j = i[order], j[order]
    which, pairs = pd.factorize((ids_a[i] << _B_BITS) | ids_b[j])
    times, held = pd.factorize(doc_a[i] * len(pairs) + which)  # in order of documents
    out["held"][keep] = np.bincount(held // len(pairs), minlength=m)
    out["which"], out["times"] = held % len(pairs), np.bincount(times)
    out["pair"], out["docs"] = pairs, np.bincount(out["which"], minlength=len(pairs))
    return out


def _blocks(name_a: str, name_b: str, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(name_a), space_pieces(name_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            at, ids = 0, batch.column("doc_id").to_pylist()
            for texts in by_size((t or "" for t in batch.column("text").to_pylist()), block_chars):
                found = align(texts, a, b)
                found |= {"block": number, "doc_id": ids[at : at + len(texts)],
                          "which": _narrow(found["which"]), "times": _narrow(found["times"])}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([found[c]], kind) for c, kind in _BLOCK], [c for c, _ in _BLOCK]
                )
                number, at = number + 1, at + len(texts)

    return run


_RESULT = [
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string()),
]
_RESULT_SCHEMA = ", ".join(f"{name} {'string' if kind == pa.string() else 'long'}" for name, kind in _RESULT)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the counts of its links, from the block's pairs with their counts."""
    for batch in batches:
        for row in batch.to_pylist():
            known = row["known"] or []
            count = np.zeros(len(known), np.int64)
            best = np.zeros(len(known), np.int64)
            at = np.array([k["at"] for k in known], np.int64)
            count[at] = [k["count"] for k in known]
            best[at] = [k["best"] for k in known]
            which, times = _widen(row["which"]), _widen(row["times"])
            edges = np.concatenate([[0], np.cumsum(row["held"])]).astype(np.int64)
            sums = [
                np.diff(np.concatenate([[0], np.cumsum(x[which] * times)])[edges]) for x in (best, count)
            ]
            columns = row | {"n_best": sums[0], "count_sum": sums[1]}
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[c], kind) for c, kind in _RESULT], [c for c, _ in _RESULT]
            )


def align_tokens(
    documents: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B, *, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Links and groups between two tokenizers' tokens of every whole text.

    Null and empty texts, and texts that either side doesn't spell byte for byte
    (white space or U+2581 lost), have no tokens: zeros and ''. Repeated rows
    are each a document, in the counts too. Columns: doc_id, n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = materialise(texts.mapInArrow(_blocks(name_a, name_b, block_chars), _BLOCK_SCHEMA), "blocks")
    entries = blocks.select("block", F.posexplode(F.arrays_zip("pair", "docs")).alias("at", "e")).select(
        "block", "at", F.col("e.pair").alias("pair"), F.col("e.docs").alias("docs")
    )
    counts = entries.groupBy("pair").agg(F.sum("docs").alias("count"))
    of_a = Window.partitionBy(F.shiftright("pair", _B_BITS))  # no more rows than ids of the other side
    counts = materialise(
        counts.withColumn("best", (F.col("count") == F.max("count").over(of_a)).cast("int")), "counts"
    )
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = (
        entries.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int"))
        .join(salted, ["pair", "salt"])
        .groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("known"))
    )
    return (
        blocks.drop("pair", "docs").join(known, "block", "left").mapInArrow(_summed, _RESULT_SCHEMA)
    )
