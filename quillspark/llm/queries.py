"""The registered queries opN_<name>: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(n: int) -> F.Column:
    """crc32 of doc_id as text, mod n; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.hmm_lm import score_texts

    return score_texts(_table(spark, sf_dir, "documents"), _fold(7) == 2)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.near_dedup import link_documents

    return link_documents(_table(spark, sf_dir, "documents"), words=3, percent=85).drop("uid", "group")


def op2_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.quality_gbt import score_quality

    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), _fold(5) == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.toxicity import score_toxicity

    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), _fold(5) == 0).drop("uid")


def op5_kd_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.kd_shard import shard

    return shard(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.substring_dedup import repeated_passages

    return repeated_passages(_table(spark, sf_dir, "documents")).drop("uid")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.language_id import identify

    return identify(_table(spark, sf_dir, "documents"), _fold(4) == 2)


def op8_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.pivot_search import search

    return search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_lsa_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.lsa_decontam import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("uid")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quillspark.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hmm_lm": op1_hmm_lm,
    "op2_quality_gbt": op2_quality_gbt,
    "op3_near_dedup": op3_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_kd_shard": op5_kd_shard,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_language_id": op7_language_id,
    "op8_pivot_search": op8_pivot_search,
    "op9_lsa_decontam": op9_lsa_decontam,
    "op10_packing": op10_packing,
}

#: The whole contract by joining all shingles: right, but only for small tables.
_NEAR_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, unnest(CASE WHEN length(w) >= 3 THEN list_distinct(list_transform(range(1, length(w) - 1), lambda i: hash(w[i], w[i + 1], w[i + 2]))) WHEN length(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END) AS s FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n, hash(list(s ORDER BY s)) AS same FROM g GROUP BY doc_id),
c AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY same) AS class_id FROM n),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
l AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS low FROM documents UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.node WHERE r.low < l.b),
o AS (SELECT node AS doc_id, min(low) AS component_id FROM r GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(class_id, doc_id) AS class_id, component_id, component_id = doc_id AS kept FROM o LEFT JOIN c USING (doc_id)
"""

#: All pairs of queries and rows.
_SEARCH_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND length(embedding) > 0 AND length(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = length(embedding)),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::bigint AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank, vec_id, score FROM s QUALIFY rank <= 20
"""

#: The others learn, sketch, tokenise or optimise, which SQL can't express.
ORACLE_SQL: dict[str, str] = {"op3_near_dedup": _NEAR_SQL, "op8_pivot_search": _SEARCH_SQL}
