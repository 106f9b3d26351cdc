"""Registered queries of fetching, embedding, resolving and search evaluation, with SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as t
from quillspark.operators import embed, graph, relational, resolve, search, spatial, vector_ops
from quillspark.plans import catalog
from quillspark.plans.catalog import _PAIRS, _TOKENS
from quillspark.plans.registry import register
from quillspark.sources.fetch import fetch, scan
from quillspark.sources.tables import table, unread


def _answer(ids: list, timeout: float) -> list[dict]:
    """A service that knows even ids, needs more time for some and fails for others."""
    if any(i % 13 == 0 for i in ids) or (timeout < 60 and any(i % 5 == 0 for i in ids)):
        raise TimeoutError("no answer")
    return [{"doc_id": i, "name": f"n{i}"} for i in ids if i % 2 == 0]


@register("q_fetched", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND doc_id % 13 > 0 THEN 'n' || doc_id END AS name, CASE WHEN doc_id % 13 = 0 THEN 'TimeoutError: no answer' END AS error FROM documents")
def fetched(spark: SparkSession, d: str) -> DataFrame:
    return fetch(table(spark, d, "documents"), "doc_id", "name string", _answer, batch=16)


def _page(after: int, where: str) -> tuple[list[int], bool]:
    """A service that gives at most 30 ids a page, of those that its predicate lets through."""
    every = [i for i in range(200) if i % 3 == 0] if where == "complete" else list(range(200))
    left = [i for i in every if i > after]
    return left[:30], len(left) > 30


@register("q_scanned", "SELECT range AS id FROM range(200) WHERE range % 3 = 0")
def scanned(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, lambda after: _page(after, "complete"), "id")


@register("q_resumed", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resumed(spark: SparkSession, d: str) -> DataFrame:
    return unread(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@register("q_kinds", "SELECT DISTINCT event_type AS kind FROM events")
def kinds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_type").alias("kind")).distinct().orderBy("kind")


@register("q_valid_urls", "SELECT page_id, page_id % 5 NOT IN (1, 2, 3) AS good FROM pages")
def valid_urls(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("page_id") % 5
    url = F.when(n == 1, "ftp://a.b/c").when(n == 2, "https:///c").when(n == 3, "http://a.b:99999/").when(n == 4, "http://a.b:80/x?y").otherwise("https://a.b")
    return table(spark, d, "pages").select("page_id", t.valid_url(url).alias("good"))


@register("q_encodable", "SELECT * FROM (VALUES (0, 'alpha beta gamma'), (1, 'one'), (2, '')) v(id, text)")
def encodable(spark: SparkSession, d: str) -> DataFrame:
    asked = ['Alpha "beta gamma" -delta', "one OR -two", "-x OR"]
    return spark.createDataFrame([(i, search.parse(q).without_operators()) for i, q in enumerate(asked)], "id int, text string")


@register("q_components", r"SELECT doc_id, 'title' AS component, source AS text FROM documents UNION ALL SELECT doc_id, 'methods', '**' || lang || '** x' FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 'claims', E'one\n\ntwo' FROM documents UNION ALL SELECT doc_id, 'inference_claims', 'two' FROM documents")
def components(spark: SparkSession, d: str) -> DataFrame:
    said = lambda name, value: F.struct(F.lit(name).alias("question_name"), value.alias("value"))
    claim = lambda text, kind: F.struct(F.lit(text).alias("claim"), F.lit(kind).alias("claim_type"))
    methods = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<p><b>"), "lang", F.lit("</b> \n x</p>"))).otherwise(" ")
    rows = table(spark, d, "documents").select("doc_id", F.concat(F.lit("  "), "source").alias("title"), F.array(said("Results", F.lit("")), said(" Methods ", methods)).alias("responses"), F.array(claim(" one ", "EXPLICIT"), claim("two", "IMPLICIT"), claim("", "IMPLICIT")).alias("claims"))
    return embed.components(rows, "doc_id", ["title", "introduction", "methods", "results", "claims", "inference_claims"])


@register("q_pooled_vectors", f"WITH x AS (SELECT doc_id, {_TOKENS} AS w FROM documents), c AS (SELECT doc_id, unnest(list_transform(range(0, 1 + ceil(greatest(length(w) - 20, 0) / 15)::bigint), lambda i: w[i * 15 + 1:i * 15 + 20])) AS c FROM x WHERE length(w) > 0) SELECT doc_id, round(avg(length(c)), 6) AS a, round(avg(length(c[1])), 6) AS b, count(*) AS chunks FROM c GROUP BY doc_id")
def pooled_vectors(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", t.tokens(F.col("text")).alias("w"))
    encode = lambda w: F.array(F.size(w).cast("double"), F.length(F.get(w, F.lit(0))).cast("double"))
    found = embed.pooled(docs, "doc_id", "w", encode, 20, 5)
    return found.select("doc_id", F.round(F.col("vector")[0], 6).alias("a"), F.round(F.col("vector")[1], 6).alias("b"), "chunks")


@register("q_layers", "SELECT vec_id AS id, round(0.5 * greatest(0, embedding[1]::double + embedding[2]::double) - greatest(0, embedding[3]::double - embedding[4]::double) + 0.25, 6) AS x FROM embeddings")
def layers(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", F.slice("embedding", 1, 4).alias("v"))
    first = np.array([[1.0, 0], [1, 0], [0, 1], [0, -1]])
    found = embed.forward(rows, "vec_id", "v", [(first, np.zeros(2), "relu"), (np.array([[0.5], [-1.0]]), np.array([0.25]), "linear")])
    return found.select("id", F.round(F.col("vector")[0], 6).alias("x"))


@register("q_ridge", "WITH s AS (SELECT sum(embedding[1]::double * embedding[1]) + 2 AS a, sum(embedding[1]::double * embedding[2]) AS b, sum(embedding[2]::double * embedding[2]) + 2 AS c, sum(embedding[1]::double * embedding[3]) AS p, sum(embedding[2]::double * embedding[3]) AS q FROM embeddings) SELECT round((c * p - b * q) / (a * c - b * b), 6) AS w0, round((a * q - b * p) / (a * c - b * b), 6) AS w1 FROM s")
def ridge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select(F.slice("embedding", 1, 2).alias("x"), F.slice("embedding", 3, 1).alias("y"))
    w = embed.ridge(rows, "x", "y", 2.0)
    return spark.createDataFrame([(round(float(w[0, 0]), 6), round(float(w[1, 0]), 6))], "w0 double, w1 double")


@register("q_resolved", "SELECT doc_id AS id, doc_id AS work, CASE doc_id % 3 WHEN 0 THEN 'doi' WHEN 1 THEN 'pmid' ELSE 'title' END AS how, CASE WHEN doc_id % 3 = 2 AND doc_id % 2 = 0 THEN 1.03 ELSE 1.0 END::double AS score FROM documents WHERE doc_id % 3 < 2 OR doc_id % 4 > 0")
def resolved(spark: SparkSession, d: str) -> DataFrame:
    docs, n = table(spark, d, "documents"), F.col("doc_id") % 3
    title = F.concat(F.lit("Title of record "), "doc_id", F.lit(" in "), "lang")
    works = docs.select(F.col("doc_id").alias("work"), F.concat(F.lit("10.1/x"), "doc_id").alias("doi"), (F.col("doc_id") + 10000).cast("string").alias("pmid"), title.alias("title"), F.lit(2000).alias("year"))
    refs = docs.select(F.col("doc_id").alias("id"), F.when(n == 0, F.concat(F.lit("10.1/x"), "doc_id")).alias("doi"), F.when(n == 1, (F.col("doc_id") + 10000).cast("string")).alias("pmid"), F.when(F.col("doc_id") % 4 > 0, F.upper(title)).otherwise("quite another thing").alias("title"), F.when(F.col("doc_id") % 2 == 0, 2000).otherwise(1999).alias("year"))
    candidates = docs.select(F.col("doc_id").alias("id"), F.explode(F.array(F.col("doc_id"), F.col("doc_id") + 1)).alias("work"))
    return resolve.resolve(refs, works, candidates)


@register("q_works", "SELECT page_id AS id, 'W' || page_id AS work, '10.1/a' || page_id AS doi, (500 + page_id)::varchar AS pmid, url AS title, 2000 + page_id % 20 AS year, 'J' AS journal, page_id % 2 = 0 AS is_review FROM pages")
def works(spark: SparkSession, d: str) -> DataFrame:
    made = F.struct(F.concat(F.lit("W"), "page_id").alias("id"), F.concat(F.lit("https://doi.org/10.1/A"), "page_id").alias("doi"), F.struct(F.concat(F.lit("https://x/"), 500 + F.col("page_id")).alias("pmid")).alias("ids"), F.col("url").alias("display_name"), (2000 + F.col("page_id") % 20).alias("publication_year"), F.struct(F.struct(F.lit("J").alias("display_name")).alias("source")).alias("primary_location"), F.when(F.col("page_id") % 2 == 0, "Review").alias("type"))
    rows = table(spark, d, "pages").select(F.col("page_id").alias("id"), resolve.work(F.to_json(made)).alias("w"))
    return rows.select("id", *(F.col(f"w.{c}").alias(c) for c in ("work", "doi", "pmid", "title", "year", "journal", "is_review")))


@register("q_paired_vectors", "SELECT vec_id, embedding[1]::double AS a, embedding[64]::double AS b FROM embeddings WHERE vec_id % 2 = 0")
def paired_vectors(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    small = rows.select("vec_id", F.slice("embedding", 1, 8).alias("small"))
    return small.join(rows.where("vec_id % 2 = 0").select("vec_id", "embedding"), "vec_id").select("vec_id", F.col("small")[0].cast("double").alias("a"), F.col("embedding")[63].cast("double").alias("b"))


@register("q_author_dedup", "SELECT c_mktsegment || '|' || c_nationkey AS key, arg_min(c_name, c_custkey) AS name, array_to_string(list_sort(list(DISTINCT c_custkey)), ',') AS submissions FROM customer GROUP BY c_mktsegment, c_nationkey")
def author_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").withColumn("person", F.concat(F.lit("  "), F.initcap("c_mktsegment")))
    keyed = rows.withColumn("key", F.concat_ws("|", F.upper(t.name_key(F.col("person"))), t.name_key(F.col("c_nationkey").cast("string")))).withColumn("name", F.col("c_name"))
    merged = relational.merge_by_key(keyed, ["key"], F.col("c_custkey"), ["name"], {"c_custkey": "submissions"})
    return merged.withColumn("submissions", F.array_join(F.transform("submissions", lambda x: x.cast("string")), ","))


@register("q_title_search", f"WITH x AS (SELECT doc_id, unnest({_TOKENS.replace('lower(text)', 'lower(source)')}) AS token FROM documents) SELECT doc_id AS id, max((token = 'src1')::int)::bigint AS exactness FROM x WHERE damerau_levenshtein(token, 'src1') <= 1 GROUP BY doc_id")
def title_search(spark: SparkSession, d: str) -> DataFrame:
    titles = search.build_index(table(spark, d, "documents"), "doc_id", "source", folders=4)
    return search.search(titles, search.parse("src1"))[0]


@register("q_typo_recall", "SELECT 1.0::double AS recall")
def typo_recall(spark: SparkSession, d: str) -> DataFrame:
    index = catalog.index(spark, d)
    words = [r["token"] for r in index.vocabulary.where("token rlike '^[a-z]{4,}$'").orderBy(F.desc("df"), "token").limit(25).collect()]
    return search.typo_recall(index, words)


@register("q_lod_stride", "SELECT vec_id FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS r, count(*) OVER () AS n FROM embeddings) WHERE r % ceil(n / 120)::bigint = 0")
def lod_stride(spark: SparkSession, d: str) -> DataFrame:
    return spatial.lod_cap(table(spark, d, "embeddings").select("vec_id"), None, "vec_id", 120).select("vec_id")


#: The graph of each row and its nearest neighbour, and its components.
_PARTS = f"""WITH RECURSIVE {_PAIRS}, k AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) <= 1), e AS (SELECT id AS u, neighbour AS v FROM k UNION SELECT neighbour, id FROM k),
r AS (SELECT vec_id AS id, vec_id AS low FROM embeddings UNION SELECT e.v, r.low FROM r JOIN e ON e.u = r.id WHERE r.low < e.v), c AS (SELECT id, min(low) AS component FROM r GROUP BY id)"""


def _nearest(spark: SparkSession, d: str) -> DataFrame:
    near = vector_ops.neighbours(table(spark, d, "embeddings"), "vec_id", "embedding", 1)
    return vector_ops.undirected(near.select(F.col("id").alias("u"), F.col("neighbour").alias("v"), (1 - F.col("distance")).alias("w")))


@register("q_components_of_graph", _PARTS + " SELECT id, component FROM c")
def components_of_graph(spark: SparkSession, d: str) -> DataFrame:
    return graph.components(_nearest(spark, d), table(spark, d, "embeddings").select(F.col("vec_id").alias("id")))


@register("q_bridges", _PARTS + ", o AS (SELECT component, row_number() OVER (ORDER BY component) AS place FROM (SELECT DISTINCT component FROM c)), m AS (SELECT id, place FROM c JOIN o USING (component)), p AS (SELECT a.place, a.id AS u, b.id AS v, round(greatest(0, list_cosine_similarity(x.embedding::double[], y.embedding::double[])), 9) AS w FROM m a JOIN m b ON b.place = a.place + 1 JOIN embeddings x ON x.vec_id = a.id JOIN embeddings y ON y.vec_id = b.id) SELECT u, v, round(greatest(w, 0.000001), 6) AS w FROM p QUALIFY row_number() OVER (PARTITION BY place ORDER BY w DESC, u, v) = 1")
def bridges(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    labels = graph.components(_nearest(spark, d), rows.select(F.col("vec_id").alias("id")))
    return graph.bridges(labels, rows, "vec_id", "embedding", block=64).withColumn("w", F.round("w", 6))
