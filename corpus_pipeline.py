"""Corpus preparation: language, toxicity, near copies, benchmark, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. Nulls and empty texts: the language stage
rejects texts without letters. A stage keeps every row that it doesn't reject,
repeated rows too, but for near copies, of which one row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeolus.llm import decontamination, language_id, ngram_join, packing, toxicity
from aeolus.llm.common import materialise, ship

#: Calibrated score under which no language is taken as known.
LEAST_LANGUAGE_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those that fit no learnt language."""
    ship(spark)
    model = language_id.fit(docs, ~language_id.held_out("doc_id", 4, 2))
    p = F.col("_llm_language")
    return (
        docs.withColumn("_llm_language", language_id.predicted(model))
        .where((p["lang_pred"] != language_id.UNKNOWN) & (p["score"] >= LEAST_LANGUAGE_SCORE))
        .drop("_llm_language")
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose worst window is toxic, learnt from ``labels``."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels, ~language_id.held_out("doc_id", 3, 1))
    return (
        docs.withColumn("_llm_toxic", toxicity.scored(spark, model))
        .where(F.col("_llm_toxic") < toxicity.THRESHOLD)
        .drop("_llm_toxic")
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at Jaccard 0.8 or more on five-word shingles."""
    ship(spark)
    groups = ngram_join.jaccard_groups(docs, n=5, num=4, den=5)
    kept = groups.where("kept").select(F.col("id").alias("_llm_id"), F.col("mark").alias("_llm_mark"))
    marked = docs.withColumn("_llm_key", F.col("doc_id").cast("long")).withColumn(
        "_llm_hash", F.xxhash64(F.coalesce("text", F.lit("")))
    )
    return (
        marked.join(
            kept.distinct(),
            F.col("_llm_key").eqNullSafe(F.col("_llm_id")) & (F.col("_llm_hash") == F.col("_llm_mark")),
            "left_semi",
        )
        .dropDuplicates(["_llm_key", "_llm_hash"])  # repeated rows
        .drop("_llm_key", "_llm_hash")
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item within its edit budget."""
    ship(spark)
    found = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = found.select(F.col("id").alias("_llm_id"), F.col("mark").alias("_llm_mark")).distinct()
    return (
        docs.withColumn("_llm_key", F.col("doc_id").cast("long"))
        .withColumn("_llm_hash", F.xxhash64("text"))
        .join(
            bad,
            F.col("_llm_key").eqNullSafe(F.col("_llm_id")) & (F.col("_llm_hash") == F.col("_llm_mark")),
            "left_anti",
        )
        .drop("_llm_key", "_llm_hash")
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The trained stages can't be told in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
