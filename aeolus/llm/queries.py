"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeolus.llm import (
    decontamination,
    embedding_join,
    html_extract,
    language_id,
    lm_scoring,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    sharding,
    token_alignment,
    token_counts,
    toxicity,
)
from aeolus.llm.common import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(_table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(_table(spark, sf_dir, "documents"), n=3, num=9, den=10).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id"
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(F.col("id").alias("doc_id"), "item_id", "begin", "finish", "edits")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, sf_dir, "documents")).drop("copies")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), plant=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_join": op1_embedding_join,
    "op2_html_extract": op2_html_extract,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_token_counts": op4_token_counts,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_sharding": op7_sharding,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_toxicity": op10_toxicity,
    "op11_entropy_balancing": op11_entropy_balancing,
    "op12_token_alignment": op12_token_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

# CRC-32 by its table of 256 steps, byte by byte; then the running sizes in the
# order of checksum and id decide the shard in which each middle byte falls.
_SHARDS_SQL = """
WITH RECURSIVE step(b, v, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL
  SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM step WHERE k < 8
), crc_table AS (SELECT list(v ORDER BY b) AS t FROM step WHERE k = 8),
hexed AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size, hex(encode(coalesce(text, ''))) AS h
  FROM documents
), bytes AS (
  SELECT doc_id, size,
         list_transform(range(size - 1), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS l
  FROM hexed
), crced AS (
  SELECT doc_id, size, xor(list_reduce(l, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]),
                                       4294967295::BIGINT), 4294967295)::BIGINT AS text_crc32
  FROM bytes, crc_table
), ordered AS (
  SELECT *, sum(size) OVER (ORDER BY text_crc32, doc_id ROWS UNBOUNDED PRECEDING) - size AS before,
         sum(size) OVER () AS total
  FROM crced
), placed AS (
  SELECT *, (((2 * before + size) * 16) // (2 * total))::INTEGER AS shard FROM ordered
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY text_crc32, doc_id) - 1 AS slot,
       NULL::INTEGER AS grown_shard
FROM placed
"""

_VECTORS_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a
  JOIN usable b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.vec_id, e.y FROM reach r JOIN edges e ON r.other = e.x
), component AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT x AS vec_id, count(*) AS n FROM edges GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component USING (vec_id) LEFT JOIN degree USING (vec_id)
"""

_JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE
      WHEN len(w) = 0 THEN []
      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    END) AS s FROM words)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 90 * (p.n + q.n - k)
), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.other = e.x
), component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents JOIN component USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

# The targets fill the sources in order of size to weight; the tilts come from
# bisection instead of Newton steps.
_MIX_SQL = r"""
WITH RECURSIVE sized AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws(':', doc_id, coalesce(text, ''))) AS mark
  FROM documents
), ranked AS (
  SELECT source, sum(size)::DOUBLE AS own, count(*) FILTER (size > 0) AS worded,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (15e-1 * sum(own) OVER () - 2 * coalesce(sum(own) OVER (fullest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (fullest ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, own / w AS room
  FROM ranked WINDOW fullest AS (ORDER BY own / w, source NULLS LAST)
), open_level AS (
  SELECT level FROM levels WHERE NOT level * w > 2 * own ORDER BY room, source NULLS LAST LIMIT 1
), targets AS MATERIALIZED (
  SELECT source, own, own / greatest(worded, 1) AS mean, levels.level * w > 2 * own AS full,
         CASE WHEN levels.level * w > 2 * own THEN 2 * own ELSE (SELECT level FROM open_level) * w END AS target
  FROM levels
), histogram AS MATERIALIZED (
  SELECT s.source, s.size / t.mean AS x, count(*) AS n
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
  WHERE s.size > 0 AND t.target < 2 * t.own GROUP BY ALL
), solve(source, lo, hi, k) AS (
  SELECT source, least(0, ln(target / own)) * mean - 1, ln(2) * mean + 1, 0 FROM targets WHERE own > 0 AND target < 2 * own
  UNION ALL
  SELECT source, CASE WHEN f < t THEN m ELSE lo END, CASE WHEN f < t THEN hi ELSE m END, k + 1
  FROM (
    SELECT s.source, any_value(s.lo) AS lo, any_value(s.hi) AS hi, any_value(s.k) AS k,
           any_value((s.lo + s.hi) / 2) AS m, any_value(t.target / t.mean) AS t,
           sum(h.n * h.x * least(2, exp(least((s.lo + s.hi) / 2 * h.x, 17e-1)))) AS f
    FROM solve s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    JOIN histogram h ON h.source IS NOT DISTINCT FROM s.source
    WHERE s.k < 70 GROUP BY s.source
  )
), tilts AS (SELECT source, (lo + hi) / 2 AS tilt FROM solve WHERE k = 70),
rated AS (
  SELECT s.*, t.own, t.target, round(1048576 * CASE
           WHEN t.full OR t.target >= 2 * t.own AND t.own > 0 THEN 2
           ELSE least(2, exp(least(coalesce(i.tilt, 0) * s.size / t.mean, 17e-1))) END)::BIGINT AS units
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
  LEFT JOIN tilts i ON i.source IS NOT DISTINCT FROM s.source
), summed AS (
  SELECT *, sum(units) OVER (PARTITION BY source ORDER BY size DESC, mark, r ROWS UNBOUNDED PRECEDING)::BIGINT + 524288 AS upto
  FROM rated
)
SELECT doc_id, size, own::BIGINT AS source_size, target,
       ((upto // 1048576 - (upto - units) // 1048576) * size)::BIGINT AS taken
FROM summed
"""

ORACLE: dict[str, str] = {
    "op1_embedding_join": _VECTORS_SQL,
    "op6_jaccard_join": _JACCARD_SQL,
    "op7_sharding": _SHARDS_SQL,
    "op11_entropy_balancing": _MIX_SQL,
}
