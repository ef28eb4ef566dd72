"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams, weighted by TF-IDF with document
frequencies counted over all documents learnt from. Follow-the-regularised-
leader with elastic-net penalties trains the weights one example at a time; a
temperature fitted on examples kept out of the training calibrates the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Hashed features; n-grams of 1 to 3 characters.
FEATURES = 1 << 15
ORDERS = (1, 2, 3)
#: Labelled documents at most that the classifier is fitted on, dealt evenly to
#: the languages. Document frequencies come from all of them.
SAMPLE = 2_400
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-4
UNKNOWN = "und"
#: Characters whose n-grams are counted at a time.
SEGMENT = 1_000_000

_LETTER = np.array([chr(c).isalpha() and not 0xD800 <= c < 0xE000 for c in range(0x10000)])


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def feature_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a whole text: their ids and how often each is there."""
    total = np.zeros(FEATURES, np.int64)
    for at in range(0, max(1, len(text)), SEGMENT):
        code = np.frombuffer(text[at : at + SEGMENT + max(ORDERS) - 1].lower().encode("utf-32-le"), "<u4")
        code = np.where(_LETTER[np.minimum(code, 0xFFFF)] | (code > 0xFFFF), code, 32).astype(np.uint32)
        for n in ORDERS:
            ends = min(SEGMENT, len(code) - n + 1)
            if ends <= 0:
                continue
            mixed = np.full(ends, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for k in range(n):
                mixed = (mixed ^ code[k : k + ends]) * np.uint32(0x85EBCA6B)
                mixed ^= mixed >> np.uint32(15)
            total += np.bincount(mixed & np.uint32(FEATURES - 1), minlength=FEATURES)
    there = np.flatnonzero(total)
    return there, total[there]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of unit length as (ids, values)."""
    at, n = feature_counts(text)
    value = (1 + np.log(n)) * idf[at]
    return at, value / max(np.linalg.norm(value), 1e-12)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features and a bias, by language
    temperature: float

    def logits(self, text: str) -> np.ndarray:
        at, value = vector(text, self.idf)
        return value @ self.weights[at] + self.weights[-1]

    def predict(self, text: str) -> tuple[str, float]:
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train_ftrl(
    examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, epochs: int = EPOCHS
) -> np.ndarray:
    """FTRL-proximal; the last row of the weights is an unpenalised bias."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def weights(at):
        w = (np.sign(z[at]) * L1 - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) > L1, w, 0.0)

    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            at, value = examples[k]
            at, value = np.append(at, FEATURES), np.append(value, 1.0)
            w = weights(at)
            w[-1] = -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA)
            error = softmax(value @ w)
            error[labels[k]] -= 1
            g = value[:, None] * error
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(slice(None))
    w[-1] = -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA)
    return w


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of the least cross-entropy.

    The targets are Platt's: of n examples (n + 1) / (n + 2) for the label and
    the rest evenly for the others. So there is a least value even if every
    example is told right, and the search widens until it lies inside.
    """
    classes = logits.shape[1] if len(labels) else 0
    if classes < 2:
        return 1.0
    n = len(labels)
    target = np.full(logits.shape, 1 / ((n + 2) * (classes - 1)))
    target[np.arange(n), labels] = (n + 1) / (n + 2)

    def loss(at: float) -> float:
        z = logits / np.exp(at)
        z = z - z.max(1, keepdims=True)
        return float((target * (np.log(np.exp(z).sum(1, keepdims=True)) - z)).sum(1).mean())

    low, high = -3.0, 3.0
    while loss(low) < loss(low + 0.1) and low > -30:
        low -= 3
    while loss(high) < loss(high - 0.1) and high < 30:
        high += 3
    for _ in range(60):  # the loss has one lowest point in the inverse temperature
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(documents: DataFrame, learn: Column, sample: int = SAMPLE) -> LanguageModel | None:
    """Model of the rows of ``documents`` (doc_id, text, lang) that ``learn`` marks.

    None if no such row has a language and letters. Frequencies cover them all;
    the classifier sees at most ``sample``, drawn by a hash of the id.
    """
    rows = documents.where(learn & F.col("lang").isNotNull() & has_letters(F.col("text")))

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for text in batch["text"]:
                found[feature_counts(text)[0]] += 1
                found[-1] += 1
        at = np.flatnonzero(found)
        yield pd.DataFrame({"feature": at.astype("int32"), "n": found[at]})

    counted = (
        rows.select("text").mapInPandas(frequencies, "feature int, n long")
        .groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    )
    if not len(counted):
        return None
    df = np.zeros(FEATURES + 1)
    df[counted["feature"]] = counted["n"]
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)

    small = rows.select("text", "lang", F.xxhash64("doc_id", F.lit(9)).alias("draw"))
    sizes = {r["lang"]: r["count"] for r in small.groupBy("lang").count().collect()}
    if not sizes:
        return None
    each = max(1, sample // len(sizes))
    # Thinned by the hash first, so that few rows are ranked.
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, 1.5 * each / n)).otherwise(share)
    thin = small.where(F.col("draw").bitwiseAND(2**53 - 1) / float(2**53) < share)
    drawn = (
        thin.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text")))
        .where(F.col("rank") <= each)
    )

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = [vector(t, idf) for t in batch["text"]]
            yield pd.DataFrame({
                "lang": batch["lang"], "draw": batch["draw"],
                "at": [a.astype("<u2").tobytes() for a, _ in both],
                "value": [v.astype("<f4").tobytes() for _, v in both],
            })

    got = sorted(
        drawn.select("lang", "draw", "text")
        .mapInPandas(featurise, "lang string, draw long, at binary, value binary").collect(),
        key=lambda r: (r["draw"], r["lang"], bytes(r["at"])),
    )
    languages = sorted({r["lang"] for r in got})
    examples = [(np.frombuffer(r["at"], "<u2").astype(int), np.frombuffer(r["value"], "<f4")) for r in got]
    labels = np.array([languages.index(r["lang"]) for r in got])
    kept = np.arange(len(got)) % 5 == 4  # for the temperature
    train = np.flatnonzero(~kept)
    weights = train_ftrl([examples[k] for k in train], labels[train], len(languages))
    logits = np.array([examples[k][1] @ weights[examples[k][0]] + weights[-1] for k in np.flatnonzero(kept)])
    return LanguageModel(
        languages, idf, weights.astype(np.float32), calibrate(logits, labels[kept])
    )


def predicted(model: LanguageModel | None, text: str = "text") -> Column:
    """Struct of lang_pred and score of a whole text; ``und``, 0 without letters."""

    @pandas_udf("struct<lang_pred:string,score:double>")
    def identify(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [model.predict(t) if t else (UNKNOWN, 0.0) for t in texts], columns=["lang_pred", "score"]
        )

    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return identify(F.when(has_letters(F.col(text)), F.col(text)).otherwise(F.lit("")))


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Rows kept from learning: crc32 of the id as text; a null id is learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def language_id(documents: DataFrame) -> DataFrame:
    """Language of every whole text, learnt from three quarters of the ids.

    Null text or no letters: ``und`` with score 0, as for all rows if nothing
    can be learnt. Repeated rows are predicted each, and alike. Columns:
    doc_id, held_out, lang_pred, score.
    """
    rows = documents.select("doc_id", "text", "lang")
    out = held_out("doc_id", 4, 2)
    model = fit(rows, ~out)
    return rows.select("doc_id", out.alias("held_out"), predicted(model).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score"
    )
