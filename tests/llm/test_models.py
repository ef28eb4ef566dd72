"""Language, toxicity and language-model scores: held-out accuracy and edges."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aeolus.llm import language_id, lm_scoring, toxicity

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


def test_language_held_out(table):
    got = language_id.language_id(table).join(table.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == table.count()
    assert (got["held_out"] == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got["doc_id"]]).all()
    own = got[got["held_out"]]
    assert (own["lang"] == own["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_language_edges(documents, nothing):
    got = language_id.language_id(documents).collect()
    assert len(got) == documents.count()
    by = {r.doc_id: r for r in got}
    assert all((by[d].lang_pred, by[d].score) == ("und", 0.0) for d in (9001, 9002, 9003))
    assert language_id.language_id(nothing).count() == 0
    unlabelled = documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.language_id(unlabelled).collect()} == {"und"}


def test_features_cover_whole_texts(monkeypatch):
    text = "Abc défg, " * 50
    whole = [x.tolist() for x in language_id.feature_counts(text)]
    monkeypatch.setattr(language_id, "SEGMENT", 37)
    assert [x.tolist() for x in language_id.feature_counts(text)] == whole
    assert language_id.feature_counts("")[0].size == 0


def test_temperature_undoes_overconfidence():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(4000, 3))
    labels = np.array([rng.choice(3, p=language_id.softmax(x)) for x in logits])
    assert 2.6 < language_id.calibrate(logits * 3, labels) < 3.4


def test_temperature_search_widens():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(3000, 3))
    labels = np.array([rng.choice(3, p=language_id.softmax(x)) for x in logits])
    for scale in (1e-3, 1e3):  # optima beyond the first bracket
        assert language_id.calibrate(logits * scale, labels) == pytest.approx(scale, rel=0.2)
    # Every example told right: still a least value, and no certainty.
    right = np.eye(3)[rng.integers(0, 3, 200)]
    t = language_id.calibrate(right, right.argmax(1))
    assert 1e-3 < t < 1 and 0.98 < language_id.softmax(right / t).max(1).mean() < 0.999
    assert language_id.calibrate(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_long_documents_are_learnt_from(spark):
    """Texts over a million characters count in both fits."""
    rows = [(k, ("bonjour le monde " if k % 2 else "hello the world ") * 70_000, "fr" if k % 2 else "en") for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True))
    assert [model.predict(t)[0] for t in ("bonjour le monde", "hello the world")] == ["fr", "en"]
    long = [(k, "fine words here " * 5_000 + ("snotterfink " if k % 2 else "lovely ") + "fine words here " * 9_000) for k in range(12)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id long, toxic int")
    learnt = toxicity.fit(spark.createDataFrame(long, "doc_id long, text string"), labels, F.lit(True))
    toxic, clean = learnt.scores([long[1][1], long[0][1]])
    assert toxic > clean


def test_every_word_of_a_document_trains(monkeypatch):
    """The first epoch averages all words, the last ones too."""
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    texts = ["calm " * 4_000 + f"{'snotterfink' if k % 2 else 'bluebell'} " * 4_000 for k in range(64)]
    model = toxicity.Scorer(*toxicity.train(texts, np.arange(64) % 2))
    bad, good = model.scores(["snotterfink snotterfink", "bluebell bluebell"])
    assert bad > good


def test_toxicity_learns_misspellings():
    rng = np.random.default_rng(0)
    clean = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    bad = ["grumblewort", "snotterfink"]
    texts, labels = [], []
    for k in range(600):
        own = rng.choice(clean, 40).tolist()
        if k % 3 == 0:
            own[rng.integers(40)] = bad[k % 2]
        texts.append(" ".join(own))
        labels.append(int(k % 3 == 0))
    model = toxicity.Scorer(*toxicity.train(texts, np.array(labels)))
    fresh = [" ".join([*rng.choice(clean, 39), w]) for w in ("grumblewrot", "snoterfink", "Grumblewort!!")]
    assert min(model.scores(fresh)) >= 0.7
    assert max(model.scores([" ".join(rng.choice(clean, 40)) for _ in range(100)])) < 0.7
    assert all(0 <= s <= 1 for s in model.scores(["", "x", "word " * 50_000]))


def test_toxicity_of_a_table(spark, table, documents, nothing):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = toxicity.toxicity(table, labels).join(labels, "doc_id").toPandas()
    learnt = got[~got["held_out"]]
    assert (learnt["predicted"] == learnt["toxic"]).mean() > 0.97
    assert (got["held_out"] == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got["doc_id"]]).all()
    rows = toxicity.toxicity(documents, labels).collect()
    assert len(rows) == documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(nothing, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(documents, labels.limit(0)).collect()} == {0.0}


@pytest.fixture(scope="module")
def language_model(table):
    """Vocabulary, word groups and a network trained on the documents of sf0.01."""
    batch = pa.RecordBatch.from_arrays([pa.array([r.text for r in table.collect()])], ["text"])
    counts = np.zeros(lm_scoring.IDS, np.int64)
    for w in lm_scoring.word_sequences(batch.column("text")):
        np.add.at(counts, (w >> np.uint64(7)) & np.uint64(lm_scoring.IDS - 1), 1)
    vocabulary = lm_scoring.Vocabulary.of(counts)
    network = lm_scoring.Network(vocabulary, vocabulary.start())
    groups = list(lm_scoring._groups(batch, vocabulary))
    before = [x for g in groups for x in lm_scoring.log_likelihoods(network, g)]
    for number in range(lm_scoring.ROUNDS):
        for group in groups:
            padded, places = lm_scoring._padded(group)
            places = np.random.default_rng(0).permutation(places[number :: lm_scoring.ROUNDS])
            for at in range(0, len(places), 2_048):
                network.train(padded, places[at : at + 2_048])
    return vocabulary, network, groups, before


def test_language_model_beats_frequencies(language_model):
    vocabulary, network, groups, before = language_model
    words = np.concatenate([x for g in groups for x in g])
    frequencies = np.log(vocabulary.shares)[words].mean()
    assert sum(before) / len(words) == pytest.approx(frequencies, abs=1e-4)  # where it starts
    after = sum(lm_scoring.log_likelihoods(network, g).sum() for g in groups) / len(words)
    assert after > frequencies + 0.15
    # The context counts: words of other documents around them fit worse.
    mixed = np.split(np.random.default_rng(1).permutation(words), range(400, len(words), 400))
    assert lm_scoring.log_likelihoods(network, mixed).sum() / len(words) < after - 0.2


def test_language_model_is_a_distribution(language_model):
    """Over all words the probabilities at a place sum to one."""
    vocabulary, network, groups, _ = language_model
    padded, _ = lm_scoring._padded(groups[0][:1])
    for place in (lm_scoring.SIDE, lm_scoring.SIDE + 7):
        total = 0.0
        for word in np.split(np.arange(lm_scoring.IDS), 8):
            own = np.concatenate([np.append(padded[place - 2 : place], [w, *padded[place + 1 : place + 3]]) for w in word])
            total += np.exp(network.logs(own, np.arange(len(word)) * 5 + 2)).sum()
        assert total == pytest.approx(1, abs=1e-3)


def test_language_model_gradient():
    """A step goes down the numeric gradient's direction."""
    rng = np.random.default_rng(0)
    vocabulary = lm_scoring.Vocabulary.of(rng.integers(0, 50, lm_scoring.IDS))
    network = lm_scoring.Network(vocabulary, vocabulary.start() + rng.normal(0, 0.05, len(vocabulary.start())))
    padded, places = lm_scoring._padded([rng.integers(0, lm_scoring.IDS, 60)])

    def loss(flat):
        return -lm_scoring.Network(vocabulary, flat).logs(padded, places).mean(dtype=np.float64)

    start = network.flat.copy()
    network.seen[:] = 1e6  # a step so small that it shows the gradient
    network.train(padded, places)
    gradient = (start - network.flat) / lm_scoring.RATE * 1e3
    for k in np.argsort(-np.abs(gradient))[[0, 5, 30, 200]]:
        near = [start.copy(), start.copy()]
        near[0][k] += 1e-2
        near[1][k] -= 1e-2
        assert (loss(near[0]) - loss(near[1])) / 2e-2 == pytest.approx(gradient[k], rel=0.05, abs=1e-4)


def test_language_model_edges(documents, nothing):
    got = lm_scoring.score_documents(documents).collect()
    assert len(got) == documents.count()
    assert all((r.n_words, r.log_likelihood, r["mean"]) == (0, 0, 0) for r in got if r.doc_id in (9001, 9002, 9003))
    assert all(r.log_likelihood < 0 for r in got if r.n_words)
    assert lm_scoring.score_documents(nothing).count() == 0
