"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its hashed character n-grams, so an unseen misspelling
shares vectors with the words it resembles. The embeddings of a few words in a
row are averaged and classified; a document scores as its worst window. Both
layers are trained jointly in numpy: in every epoch each document answers with
the window that scores highest under the present model, since one label covers
a whole document.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from aeolus.llm.common import by_size, materialise
from aeolus.llm.language_id import held_out

BUCKETS = 1 << 17
ORDERS = (3, 4, 5)
DIMENSIONS = 8
#: Words whose vectors are averaged.
WINDOW = 2
#: Labelled documents at most that the model is fitted on, half of each label.
SAMPLE = 6_000
EPOCHS, BATCH, RATE = 12, 64, 0.3
THRESHOLD = 0.7
#: Words whose means a task keeps, some 15 MB; beyond that it starts afresh.
KEPT_WORDS = 100_000
#: Words whose subwords are looked up at a time.
_PART = 50_000

_EDGE = string.punctuation + "«»„“”’…–—¡¿"


def words_of(text: str) -> list[str]:
    return [w.strip(_EDGE) for w in text.lower().split()]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of ``<word>`` and the word that each is from."""
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    ids, owners = [], []
    for n in ORDERS:
        ends = len(code) - n + 1
        if ends <= 0:
            continue
        mixed = np.full(ends, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            mixed = (mixed ^ code[k : k + ends].astype(np.uint32)) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(15)
        inside = owner[:ends] == owner[n - 1 :]
        ids.append((mixed & np.uint32(BUCKETS - 1))[inside])
        owners.append(owner[:ends][inside])
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ids).astype(np.int64), np.concatenate(owners)


def word_means(words: list[str], bucket_logits: np.ndarray) -> np.ndarray:
    """Mean over each word's subwords of their part in the logit; 0 without any."""
    ids, owner = subwords(words)
    n = np.bincount(owner, minlength=len(words))
    return np.bincount(owner, bucket_logits[ids], minlength=len(words)) / np.maximum(n, 1)


def worst_window(values: np.ndarray) -> tuple[int, float]:
    """First word and mean of the window of the largest mean."""
    if len(values) <= WINDOW:
        return 0, float(values.mean()) if len(values) else 0.0
    total = np.concatenate(([0.0], np.cumsum(values)))
    means = (total[WINDOW:] - total[:-WINDOW]) / WINDOW
    at = int(means.argmax())
    return at, float(means[at])


def train(texts: Iterable[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Each bucket's part in the logit of label 1, and the bias. Of the texts
    only the numbers of their words are held."""
    rng = np.random.default_rng(0)
    docs, index = [], {}
    for text in texts:
        docs.append(np.array([index.setdefault(w, len(index)) for w in words_of(text)], np.int32))
    words = list(index)
    # The subwords of all words once, as slices by word.
    parts, counts = [], []
    for at in range(0, len(words), _PART):
        ids, owner = subwords(words[at : at + _PART])
        parts.append(ids[np.argsort(owner, kind="stable")].astype(np.int32))
        counts.append(np.bincount(owner, minlength=len(words[at : at + _PART])).astype(np.int32))
    ids = np.concatenate([*parts, np.zeros(0, np.int32)])
    count = np.concatenate([*counts, np.zeros(0, np.int32)])
    del parts, counts, words, index
    ends = np.cumsum(count, dtype=np.int64)
    first = ends - count

    def means(logit: np.ndarray) -> np.ndarray:
        """Mean logit of each word's subwords."""
        out = np.zeros(len(count))
        for at in range(0, len(count), _PART):
            n = count[at : at + _PART]
            own = logit[ids[first[at] : ends[min(at + _PART, len(count)) - 1]]]
            out[at : at + _PART] = np.bincount(np.repeat(np.arange(len(n)), n), own, minlength=len(n)) / np.maximum(n, 1)
        return out

    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full(BUCKETS, 1e-6, np.float32), np.full(out.shape, 1e-6, np.float32), np.full(2, 1e-6, np.float32)]
    for epoch in range(EPOCHS):
        value = means(embed @ (out[:, 1] - out[:, 0]))
        order = rng.permutation(len(docs))
        for k in range(0, len(order), BATCH):
            batch = order[k : k + BATCH]
            bags, weights, row = [], [], []
            for r, d in enumerate(batch):
                own = docs[d]
                if epoch and len(own) > WINDOW:
                    at = worst_window(value[own])[0]
                    if not labels[d] and epoch % 2 == 0:
                        at = int(rng.integers(len(own) - WINDOW + 1))
                    own = own[at : at + WINDOW]
                # A word that comes again weighs as often.
                for w, times in zip(*np.unique(own, return_counts=True)):
                    bags.append(ids[first[w] : first[w] + count[w]])
                    weights.append(np.full(count[w], times / (max(count[w], 1) * len(own)), np.float32))
                    row.append(np.full(count[w], r))
            if not bags:
                continue
            bag, weight, row = np.concatenate(bags), np.concatenate(weights), np.concatenate(row)
            mean = np.zeros((len(batch), DIMENSIONS), np.float32)
            np.add.at(mean, row, embed[bag] * weight[:, None])
            z = mean @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), labels[batch]] -= 1
            g_out, g_bias = mean.T @ p, p.sum(0)
            g_mean = p @ out.T
            # One adaptive rate a bucket, as most are rare.
            touched, where = np.unique(bag, return_inverse=True)
            g = np.zeros((len(touched), DIMENSIONS), np.float32)
            np.add.at(g, where, g_mean[row] * weight[:, None])
            seen[0][touched] += (g * g).mean(1)
            embed[touched] -= RATE * g / np.sqrt(seen[0][touched])[:, None]
            seen[1] += g_out * g_out
            out -= RATE * g_out / np.sqrt(seen[1])
            seen[2] += g_bias * g_bias
            bias -= RATE * g_bias / np.sqrt(seen[2])
    return (embed @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


class Scorer:
    """Scores whole texts; words seen before are not hashed again."""

    def __init__(self, bucket_logits: np.ndarray, bias: float):
        self.bucket_logits, self.bias, self.kept = bucket_logits, bias, {}

    def scores(self, texts: list[str]) -> list[float]:
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        own = [words_of(t) for t in texts]
        fresh = list({w for ws in own for w in ws if w not in self.kept})
        self.kept.update(zip(fresh, word_means(fresh, self.bucket_logits).tolist()))
        out = []
        for ws in own:
            values = np.fromiter(map(self.kept.__getitem__, ws), np.float64, len(ws))
            out.append(float(1 / (1 + np.exp(-np.clip(worst_window(values)[1] + self.bias, -500, 500)))))
        return out


def fit(documents: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Scorer | None:
    """Model of the labelled documents that ``learn``, an expression of doc_id, marks.

    At most ``sample`` documents, half of them of each label if there are so
    many, drawn by a hash of the id. None if either label is missing. Of
    several labels of a document the highest counts.
    """
    known = labels.where(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect() if r["toxic"] in (0, 1)}
    if len(sizes) < 2:
        return None
    draw = F.xxhash64("doc_id", F.lit(10)).bitwiseAND(2**53 - 1)
    drawn = None
    for label, n in sizes.items():
        # Thinned by the hash first, so that few rows are ordered.
        thin = known.where(F.col("toxic") == label).withColumn("draw", draw)
        thin = thin.where(F.col("draw") / float(2**53) < sample / n).orderBy("draw").limit(sample // 2)
        drawn = thin if drawn is None else drawn.unionByName(thin)
    rows = (
        documents.join(F.broadcast(drawn), "doc_id")  # no more than ``sample`` rows
        .where(F.col("text").isNotNull())
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"), F.max("draw").alias("draw"))
    )
    rows = materialise(rows, "labelled")
    known = sorted(rows.select("draw", "doc_id", "toxic").collect())
    if len({r["toxic"] for r in known}) < 2:
        return None
    # Text by text, so that the driver never holds all.
    texts = (r["text"] for r in rows.orderBy("draw", "doc_id").select("text").toLocalIterator())
    return Scorer(*train(texts, np.array([r["toxic"] for r in known])))


def scored(spark, model: Scorer | None, text: str = "text") -> Column:
    """Score of a whole text; null is an empty text; without a model 0."""
    if model is None:
        return F.lit(0.0)
    shared = spark.sparkContext.broadcast((model.bucket_logits, model.bias))  # half a MB, fixed

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(*shared.value)  # what it keeps goes with the task
        for texts in batches:
            yield pd.Series([x for part in by_size(texts) for x in scorer.scores(part)], dtype="float64")

    return score(F.coalesce(F.col(text), F.lit("")))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of every whole text, learnt from two thirds of the ids.

    Null text: scored as empty. Nothing to learn from: score 0. Repeated rows
    are scored each, and alike. Columns: doc_id, held_out, score, predicted.
    """
    rows = documents.select("doc_id", "text")
    out = held_out("doc_id", 3, 1)
    model = fit(rows, labels.select("doc_id", "toxic"), ~out)
    return rows.select(
        "doc_id", out.alias("held_out"), scored(documents.sparkSession, model).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
