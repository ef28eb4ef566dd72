"""Language-model scores by masked pseudo-likelihood.

A small bidirectional network, trained in numpy, predicts every word from the
words on both sides of it; a document scores as the sum of the conditional
log-probabilities of its words. The vocabulary and the word frequencies are
counted over all documents. Training passes over all documents too: in every
round each task continues from the common parameters on its own documents, and
the tasks' parameters are averaged, weighted by their words. So the parameters,
in their last digits, depend on how the rows fall into tasks.

The softmax has two levels: the context gives a word's class, words of like
frequency, and the word within its class. Every word's vector is trained.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeolus.llm.shingles import word_sequences

#: Words are told apart by a hash with so many values, each an id of its own.
IDS = 1 << 12
PAD = IDS
CLASSES, DIMENSIONS = 64, 8
#: Words seen to each side.
SIDE = 2
#: A round trains on every ROUNDS-th word, so that all rounds cover all words.
ROUNDS, BATCH, RATE = 2, 8_192, 0.1
#: Places scored at a time.
PLACES = 32_768
#: Words scored or trained on at a time.
SEGMENT = 1 << 18
#: Parts into which parameters are cut to be summed, and first sums of each.
SLICES, SUMS = 16, 64

_SHIFTS = [*range(-SIDE, 0), *range(1, SIDE + 1)]


@dataclass
class Vocabulary:
    """Ids by frequency, so that a class is a range of ids.

    ``ids``: of each hash value; ``first``: where each class begins, and the
    end; ``classes``: of each id; ``shares``: of the ids among all words.
    """

    ids: np.ndarray
    first: np.ndarray
    classes: np.ndarray
    shares: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        order = np.argsort(-counts, kind="stable")
        ids = np.empty(IDS, np.int64)
        ids[order] = np.arange(IDS)
        own = counts[order] + 1.0
        # Classes of equal weight, from frequent to rare.
        passed = np.cumsum(own) - own
        classes = np.minimum(CLASSES - 1, passed * CLASSES // own.sum()).astype(np.int64)
        return cls(ids, np.searchsorted(classes, np.arange(CLASSES + 1)), classes, own / own.sum())

    def encode(self, words: np.ndarray) -> np.ndarray:
        return self.ids[(words >> np.uint64(7)) & np.uint64(IDS - 1)]

    def start(self) -> np.ndarray:
        """Parameters of a network that tells the frequencies, whatever the context."""
        network = Network(self)
        within = np.bincount(self.classes, self.shares, minlength=CLASSES)
        network.bias[:] = np.log(np.maximum(within, 1e-12))
        network.word_bias[:] = np.log(self.shares / within[self.classes])
        return network.flat


class Network:
    """Embeddings scaled by place, summed, squashed; a softmax over the classes
    and one over the words of the class."""

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray | None = None):
        self.vocabulary = vocabulary
        rng = np.random.default_rng(5)
        shapes = {
            "embed": (IDS + 1, DIMENSIONS), "place": (len(_SHIFTS), DIMENSIONS), "hidden": (DIMENSIONS,),
            "out": (DIMENSIONS, CLASSES), "bias": (CLASSES,), "word": (IDS, DIMENSIONS), "word_bias": (IDS,),
        }
        if flat is None:
            flat = np.concatenate([
                rng.normal(0, 0.3, int(np.prod(s))) if k == "embed" else np.full(int(np.prod(s)), float(k == "place"))
                for k, s in shapes.items()
            ])
        self.flat = flat.astype(np.float32)
        self.seen = np.full(len(self.flat), 1e-4, np.float32)
        at = 0
        for k, s in shapes.items():
            n = int(np.prod(s))
            setattr(self, k, self.flat[at : at + n].reshape(s))
            setattr(self, f"seen_{k}", self.seen[at : at + n].reshape(s))
            at += n

    def context(self, padded: np.ndarray, places: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        around = [padded[places + s] for s in _SHIFTS]
        return around, np.tanh(self.hidden + sum(self.embed[c] * p for c, p in zip(around, self.place)))

    def _by_class(self, targets: np.ndarray) -> Iterator[tuple[np.ndarray, slice]]:
        """Rows of each class that occurs, and its range of ids."""
        classes = self.vocabulary.classes[targets]
        order = np.argsort(classes, kind="stable")
        cuts = np.searchsorted(classes[order], np.arange(CLASSES + 1))
        for c in np.flatnonzero(np.diff(cuts)):
            yield order[cuts[c] : cuts[c + 1]], slice(*self.vocabulary.first[c : c + 2])

    def logs(self, padded: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Log-probability of the word at each place, given those around it."""
        squashed, targets = self.context(padded, places)[1], padded[places]
        out = _log_probability(squashed @ self.out + self.bias, self.vocabulary.classes[targets])
        for rows, ids in self._by_class(targets):
            logits = squashed[rows] @ self.word[ids].T + self.word_bias[ids]
            out[rows] += _log_probability(logits, targets[rows] - ids.start)
        return out

    def _step(self, name: str, at, g: np.ndarray) -> None:
        seen = getattr(self, f"seen_{name}")
        seen[at] += g * g
        getattr(self, name)[at] -= RATE * g / np.sqrt(seen[at])

    def train(self, padded: np.ndarray, places: np.ndarray) -> None:
        """One adaptive gradient step on the words at some places."""
        around, squashed = self.context(padded, places)
        targets, n = padded[places], np.float32(len(places))
        error = _error(squashed @ self.out + self.bias, self.vocabulary.classes[targets], n)
        back = error @ self.out.T
        self._step("out", slice(None), squashed.T @ error)
        self._step("bias", slice(None), error.sum(0))
        for rows, ids in self._by_class(targets):
            own = squashed[rows]
            inner = _error(own @ self.word[ids].T + self.word_bias[ids], targets[rows] - ids.start, n)
            back[rows] += inner @ self.word[ids]
            self._step("word", ids, inner.T @ own)
            self._step("word_bias", ids, inner.sum(0))
        back *= 1 - squashed**2
        embed, place = np.zeros_like(self.embed), np.empty_like(self.place)
        for k, c in enumerate(around):
            own = back * self.place[k]
            for d in range(DIMENSIONS):
                embed[:, d] += np.bincount(c, own[:, d], minlength=IDS + 1)
            place[k] = (back * self.embed[c]).sum(0)
        self._step("embed", slice(None), embed)
        self._step("place", slice(None), place)
        self._step("hidden", slice(None), back.sum(0))


# Logits are sums of a few bounded products, far from overflow.


def _log_probability(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    own = logits[np.arange(len(target)), target]
    return own - np.log(np.exp(logits, out=logits).sum(1))


def _error(logits: np.ndarray, target: np.ndarray, n: np.float32) -> np.ndarray:
    """Softmax less the target, by ``n``."""
    e = np.exp(logits, out=logits)
    e /= e.sum(1, keepdims=True) * n
    e[np.arange(len(target)), target] -= 1 / n
    return e


def _padded(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents in a row with padding between them, and the words' places."""
    gap = np.full(SIDE, PAD)
    padded = np.concatenate([gap, *(x for own in ids for x in (own, gap))])
    return padded, np.flatnonzero(padded != PAD)


def _groups(batch: pa.RecordBatch, vocabulary: Vocabulary) -> Iterator[list[np.ndarray]]:
    held: list[np.ndarray] = []
    size = 0
    for words in word_sequences(batch.column("text")):
        if held and size + len(words) > SEGMENT:
            yield held
            held, size = [], 0
        held.append(vocabulary.encode(words))
        size += len(words)
    if held:
        yield held


def _count(texts: DataFrame) -> np.ndarray:
    """Words of each hash value over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for batch in batches:
            for words in word_sequences(batch.column("text")):
                np.add.at(total, (words >> np.uint64(7)) & np.uint64(IDS - 1), 1)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bin", "n"])

    rows = texts.mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(IDS, np.int64)
    out[rows["bin"]] = rows["n"]
    return out


_SUM = "slice int, part int, data binary, words long"


def _add_up(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Sum of parameters times words, in the order of the parts."""
    rows = rows.sort_values("part")
    total = np.zeros(len(rows["data"].iloc[0]) // 8)
    for data in rows["data"]:
        total += np.frombuffer(data, "<f8")
    return pd.DataFrame({
        "slice": [int(key[0])], "part": [int(key[1]) if len(key) > 1 else 0],
        "data": [total.astype("<f8").tobytes()], "words": [int(rows["words"].sum())],
    })


def fit(documents: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and network parameters of all documents' texts."""
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text"))
    spark = documents.sparkSession
    vocabulary = Vocabulary.of(_count(texts))
    parameters = vocabulary.start()
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast((vocabulary, parameters))  # fixed size

        def train(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            vocabulary, start = shared.value
            network, words = Network(vocabulary, start.copy()), 0
            for batch in batches:
                for ids in _groups(batch, vocabulary):
                    padded, places = _padded(ids)
                    places = places[number::ROUNDS]
                    places = places[np.random.default_rng(len(places)).permutation(len(places))]
                    for at in range(0, len(places), BATCH):
                        network.train(padded, places[at : at + BATCH])
                    words += len(places)
            if words:
                task = TaskContext.get().partitionId()
                parts = np.array_split(network.flat.astype("<f8") * words, SLICES)
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(SLICES), pa.int32()), pa.array([task] * SLICES, pa.int32()),
                    pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([words] * SLICES, pa.int64()),
                ], ["slice", "part", "data", "words"])

        # A tree of sums: of the tasks' parameters in some groups, then of those.
        summed = (
            texts.mapInArrow(train, _SUM)
            .groupBy("slice", (F.col("part") % SUMS).alias("part")).applyInPandas(_add_up, _SUM)
            .groupBy("slice").applyInPandas(_add_up, _SUM).toPandas().sort_values("slice")
        )
        if len(summed):
            total = np.concatenate([np.frombuffer(d, "<f8") for d in summed["data"]])
            parameters = (total / summed["words"].iloc[0]).astype(np.float32)
        shared.unpersist()
    return vocabulary, parameters


def log_likelihoods(network: Network, ids: list[np.ndarray]) -> np.ndarray:
    """Sum of the conditional log-probabilities of each document's words."""
    padded, places = _padded(ids)
    owner = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    out = np.zeros(len(ids))
    for at in range(0, len(places), PLACES):
        own = network.logs(padded, places[at : at + PLACES])
        out += np.bincount(owner[at : at + PLACES], own, minlength=len(ids))
    return out


def score_documents(documents: DataFrame) -> DataFrame:
    """Pseudo-log-likelihood of every whole text under a model of all of them.

    Null text, no words: 0 words and score 0. Repeated rows are scored each.
    Columns: doc_id, n_words, log_likelihood (sum over the words), mean
    (by word, 0 without words).
    """
    model = documents.sparkSession.sparkContext.broadcast(fit(documents))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(*model.value)
        for batch in batches:
            sizes, sums = [], []
            for ids in _groups(batch, network.vocabulary):
                sizes += [len(x) for x in ids]
                sums += log_likelihoods(network, ids).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())],
                ["doc_id", "n_words", "log_likelihood"],
            )

    return (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .mapInArrow(score, "doc_id long, n_words long, log_likelihood double")
        .withColumn("mean", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).otherwise(0.0))
    )
