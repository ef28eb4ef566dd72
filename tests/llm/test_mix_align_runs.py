"""Source mixing, cross-tokenizer alignment and periodic runs against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from aeolus.llm import mixing, periodic_runs, token_alignment
from aeolus.llm.packing import byte_letters

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall((text or "").encode())


# -- mixing ---------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by the rule as it is told: stop full sources, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        level = left / sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and level * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


def plain_tilt(sizes, target, most=2):
    mean = sum(sizes) / len(sizes)
    low, high = -60.0 * mean, mean + 1
    for _ in range(200):
        middle = (low + high) / 2
        taken = sum(s * min(most, math.exp(min(1.0, middle * s / mean) if middle * s / mean < 1 else 1.0)) for s in sizes)
        low, high = (middle, high) if taken < target else (low, middle)
    return (low + high) / 2 / mean


def check_mix(documents, got):
    given = documents.select("doc_id", "source", "text").collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r.doc_id, len(words(r.text))) for r in given)
    sizes = Counter()
    for r in given:
        sizes[r.source] += len(words(r.text))
    targets = plain_targets(sizes)
    own = defaultdict(list)
    for r in given:
        own[r.source].append(len(words(r.text)))
    by_target = defaultdict(list)
    for r in got:
        by_target[r.source_size, round(r.target, 6)].append(r)
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r["size"]
    for source, size in sizes.items():
        rows = by_target[size, round(targets[source], 6)]
        assert Counter(r["size"] for r in rows) == Counter(own[source])
        assert abs(sum(r.taken for r in rows) - targets[source]) <= max(own[source]) / 2 + 1
        if not size or targets[source] >= 2 * size:
            assert all(r.taken == 2 * r["size"] for r in rows)
            continue
        # Copies follow the exponential rates: each run of equal sizes gets its share.
        tilt = plain_tilt([s for s in own[source] if s], targets[source])
        for n, group in Counter(own[source]).items():
            rate = min(2, math.exp(min(1.0, tilt * n)))
            assert abs(sum(r.copies for r in rows if r["size"] == n) - rate * group) <= 1.01


def test_mix(documents):
    check_mix(documents, mixing.mix_documents(documents).collect())


def test_mix_of_a_hot_source(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.repeat(F.lit("w "), (F.pmod(F.xxhash64("id"), F.lit(40)) + 1).cast("int")).alias("text"),
    )
    got = mixing.mix_documents(rows).collect()
    check_mix(rows, got)
    # No order of rows or partitions changes it.
    again = mixing.mix_documents(rows.repartition(13, "text")).collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)


def test_mix_of_nothing(spark, nothing):
    assert mixing.mix_documents(nothing).count() == 0
    empty = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix_documents(empty).collect()] == [(0.0, 0)] * 2


def test_targets_stop_and_reshare(spark):
    rng = np.random.default_rng(5)
    for _ in range(5):
        sizes = {f"s{k:02}": int(x) for k, x in enumerate(rng.pareto(0.7, 9) * 100)} | {None: 50, "": 0, "é": 7}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys()
        assert all(got[s] == pytest.approx(want[s], rel=1e-12) for s in want)


# -- alignment ------------------------------------------------------------


class Plain:
    """Both tokenizers, text by text, and every pair of tokens compared."""

    def __init__(self):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        self.letters = {chr(v): k for k, v in byte_letters().items()}

    def b_bytes(self, k):
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        out = []
        for ids, spell in ((a, lambda k: bytes(self.letters[c] for c in self.a.id_to_token(k))), (b, self.b_bytes)):
            at, rows = 0, []
            for k in ids:
                rows.append((k, at, at + len(spell(k))))
                at = rows[-1][2]
            out.append((rows, b"".join(map(spell, ids))))
        return out

    def __call__(self, text):
        """Links and groups, or None without tokens."""
        if not text:
            return None
        (a, a_bytes), (b, b_bytes) = self.tokens(text)
        if not a_bytes == b_bytes == (" " + text).encode():
            return None
        links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [
            ",".join(str(k) for k, s, e in a if low < e <= high) + "|" + ",".join(str(k) for k, s, e in b if low < e <= high)
            for low, high in zip([0, *ends], ends)
        ]
        return len(a), len(b), links, groups


ODD = [
    None, "", " ", "  ", "a", "word.", " lead", "trail ", "a  b   c", "▁x", "x▁ y", "\n\n a\tb ",
    "<s> <0x0A> <|endoftext|> </s>", "a\x00b", "ａ é́ ﬁ 你好 \U0001f600\U0001f600",
    "x　 y  z\u0085 q  r", "don't we'll  I'm 12345 1,000.50", "a.b,c. d,e", "\x1c \x1d a\x7f b",
    "l'été, naïve.", "\r\n x\r\n", "   \n   a", "a \n", "ß.ß,ß x.", "a" * 300, "ab " * 100,
]


@pytest.mark.parametrize("block_chars", [60, 2_000_000])
def test_alignment(spark, block_chars):
    rng = np.random.default_rng(1)
    letters = list(" \n\t.,a'bé 　\x1c1\U0001f600s ")
    texts = ODD + ["".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(80)]
    texts += [r.text[:300] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(15).collect()]
    texts += texts[30:40]
    plain = Plain()
    want = [plain(t) for t in texts]
    count = Counter()
    for w in want:
        if w:
            count.update(set(w[2]))
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    frame = spark.createDataFrame(
        [(k, t, "x", 1.5) for k, t in enumerate(texts)], "doc_id long, text string, pair string, count double"
    ).repartition(3)
    got = {r.doc_id: r for r in token_alignment.align_tokens(frame, block_chars=block_chars).collect()}
    assert sorted(got) == list(range(len(texts)))
    for k, w in enumerate(want):
        row = tuple(got[k])[1:]
        if w is None:
            assert row == (0, 0, 0, 0, 0, 0, ""), repr(texts[k])
        else:
            n_a, n_b, links, groups = w
            assert row == (
                n_a, n_b, len(groups), len(links), sum(count[x, y] == best[x] for x, y in links),
                sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest(),
            ), repr(texts[k])


def test_alignment_of_whole_documents(documents):
    got = token_alignment.align_tokens(documents)
    assert got.count() == documents.count()
    plain = Plain()
    by_id = {r.doc_id: r for r in got.where("doc_id = 9005").collect()}
    (a, _), (b, _) = plain.tokens("word " * 60_000)
    assert (by_id[9005].n_a, by_id[9005].n_b) == (len(a), len(b))


def test_alignment_of_nothing(nothing):
    assert token_alignment.align_tokens(nothing).count() == 0


# -- periodic runs --------------------------------------------------------


def plain_runs(own):
    """Every period by itself: stretches of places equal to the place p further on."""
    known, found = {}, {}
    own = np.array([known.setdefault(w, len(known)) for w in own], int)
    for p in range(1, len(own) // 3 + 1):
        same = np.concatenate([[0], own[:-p] == own[p:], [0]])
        edges = np.flatnonzero(np.diff(same))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j - i + p >= max(24, 3 * p):
                found.setdefault((i, j - i + p), p)
    return sorted((s, n, p) for (s, n), p in found.items())


def sequences(rng):
    """Word sequences with runs in runs, runs to either end, and none."""
    tile = lambda letters, size, times: np.tile(rng.integers(0, letters, rng.integers(1, size)), rng.integers(1, times))
    kind = rng.integers(0, 5)
    if kind == 0:
        return rng.integers(0, 2, rng.integers(0, 200))
    if kind == 1:
        return tile(3, 30, 12)
    if kind == 2:
        ends, inner = rng.integers(0, 50, rng.integers(0, 40)), tile(50, 60, 7)
        return np.concatenate([ends, inner, inner[: rng.integers(0, 5)], ends])
    if kind == 3:
        return np.zeros(rng.integers(0, 300), int)
    return np.tile(np.concatenate([tile(3, 9, 9), rng.integers(0, 3, rng.integers(1, 20))]), rng.integers(2, 5))


def test_runs_against_every_period():
    rng = np.random.default_rng(2)
    for _ in range(150):
        docs = [sequences(rng) for _ in range(rng.integers(1, 6))]
        got = periodic_runs.find_runs(np.concatenate(docs).astype(np.int32), np.array(list(map(len, docs))))
        want = [(d, *r) for d, own in enumerate(docs) for r in plain_runs(own.tolist())]
        assert sorted(map(tuple, got.tolist())) == sorted(want)


def test_common_extensions():
    rng = np.random.default_rng(3)
    docs = [sequences(rng) for _ in range(12)]
    own, sizes = np.concatenate(docs).astype(np.int32), np.array(list(map(len, docs)))
    ends = np.repeat(np.cumsum(sizes), sizes)
    i, j = (rng.integers(0, len(own), 20_000) for _ in range(2))
    i, j = np.minimum(i, j), np.maximum(i, j)
    same = (ends[i] == ends[j]) & (i < j)
    i, j = i[same], j[same]
    for a, b, n in zip(i, j, periodic_runs.LCE(own, ends)(i, j)):
        assert (own[a : a + n] == own[b : b + n]).all() and b + n <= ends[b]
        assert b + n == ends[b] or own[a + n] != own[b + n]


def described(doc_id, text, plant):
    own = words(text)
    if plant:
        h = zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
        if h % 10 == 0 and own:
            g, n = h // 10, len(own)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
    # Of one word again and again the answer is plain.
    runs = plain_runs(own) if len(set(own)) > 1 else [(0, len(own), 1)][: len(own) >= 24]
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return (
        doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(own) if i not in dropped)).hexdigest(),
    )


@pytest.mark.parametrize("plant", [False, True])
def test_runs_of_documents(documents, plant):
    got = periodic_runs.periodic_runs(documents, plant=plant, block_chars=20_000).collect()
    want = [described(r.doc_id, r.text, plant) for r in documents.collect()]
    assert Counter(map(tuple, got)) == Counter(want)
    assert got[0].__fields__ == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    assert any(r.n_runs for r in got)


def test_runs_of_nothing(nothing):
    assert periodic_runs.periodic_runs(nothing, plant=True).count() == 0
