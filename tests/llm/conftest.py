import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    from aeolus.llm.common import ship

    ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with nulls, empty and long texts, repeated rows and clashing columns."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    own = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows]
    own += [own[3], own[3]]
    own += [(9001, None, None, None, None), (9002, "", "en", "x", 0), (None, "no id here at all", "en", "x", 1)]
    own += [(9003, " \n\t ", None, "x", 4), (9004, own[0][1].upper(), "en", "x", 1), (9005, "word " * 60_000, "en", "x", 1)]
    own += [(9006, own[5][1], "en", "x", 1), (9006, own[6][1], "en", "x", 1)]
    return spark.createDataFrame(
        [(*r, 1, "a", 2.0, None, 5) for r in own],
        "doc_id long, text string, lang string, source string, n_chars long,"
        " row int, n string, score double, keys string, shard int",
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
