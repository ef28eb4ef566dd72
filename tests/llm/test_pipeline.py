"""The pipeline's stages against plain versions of themselves."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aeolus.llm import decontamination, language_id, packing, toxicity
from aeolus.llm.common import materialise

SF = "/root/testdata/sf0.001"


def kept_by_hand(rows, n, num, den):
    """Smallest id of each group, by all pairs."""
    sets = [
        frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))
        for w in (re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for _, t in rows)
    ]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if den * len(a & b) >= num * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return sorted(min(g) for g in groups.values())


@pytest.fixture(scope="module")
def stages(spark):
    from aeolus.llm.common import ship

    ship(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [(5001, None, "en", "s", 0), (5002, "", "en", "s", 0), (5003, "123 456 !", "en", "s", 0)], docs.schema
    )
    docs = docs.unionByName(extra).unionByName(docs.where("doc_id = 3")).withColumn("n", F.lit(1)).withColumn("_row", F.lit("x"))
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, materialise(stage(spark, out[-1][1], SF), name)))
    return dict(out)


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_language_rejects_only_what_has_no_letters(stages):
    before = {r.doc_id for r in stages["documents"].select("doc_id").collect()}
    after = {r.doc_id for r in stages["language_id"].select("doc_id").collect()}
    assert before - after == {5001, 5002, 5003}
    assert stages["language_id"].where("doc_id = 3").count() == 2


def test_toxic_documents_go(spark, stages):
    """The stage against the model applied text by text on the driver."""
    docs = stages["language_id"]
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels, ~language_id.held_out("doc_id", 3, 1))
    rows = docs.select("doc_id", "text").collect()
    scores = model.scores([r.text for r in rows])
    kept = sorted(r.doc_id for r, score in zip(rows, scores) if score < toxicity.THRESHOLD)
    assert sorted(r.doc_id for r in stages["toxicity"].select("doc_id").collect()) == kept
    assert len(kept) > 0.8 * len(rows)


def test_language_score_is_a_threshold(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "LEAST_LANGUAGE_SCORE", 1.01)
    assert corpus_pipeline.identify_language(spark, docs, SF).count() == 0


def test_workers_keep_little_of_a_stage(spark, stages):
    """Of earlier stages' tasks nothing is left in the Python workers but the last
    one's table of pieces, which is bounded."""

    def kept(batches):
        import pandas as pd

        from aeolus.llm import packing, toxicity

        for _ in batches:
            pass
        held = [v for v in vars(toxicity).values() if isinstance(v, dict) and v is not vars(toxicity)["__builtins__"]]
        yield pd.DataFrame({"pieces": [len(packing._table(packing.TOKENIZER).hashes)], "words": [sum(map(len, held))]})

    rows = spark.range(0, 64, 1, 16).mapInPandas(kept, "pieces long, words long").collect()
    assert all(r.words == 0 and r.pieces <= packing.KEPT_PIECES for r in rows)


def test_near_copies_keep_one_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages["toxicity"].select("doc_id", "text").collect()]
    got = sorted(r.doc_id for r in stages["near_copies"].select("doc_id").collect())
    assert got == kept_by_hand(rows, 5, 4, 5)


def test_contaminated_documents_go(spark, stages):
    items = {decontamination.normalise(r.text)[0].strip() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}

    def holds(text):
        return any(i in decontamination.normalise(text)[0] for i in items)

    before = {r.doc_id: r.text for r in stages["near_copies"].collect()}
    after = {r.doc_id for r in stages["decontamination"].collect()}
    assert not any(holds(before[d]) for d in after)
    assert all(holds(before[d]) for d in before.keys() - after)


def test_all_that_stays_is_packed(stages):
    docs = {r.doc_id for r in stages["decontamination"].select("doc_id").collect()}
    assert {r.doc_id for r in stages["packing"].select("doc_id").collect()} == docs


def test_run_and_empty_tables(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), name)
        assert docs.count() == 0
