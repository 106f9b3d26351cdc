"""Registered queries of keywords, measures, scalar functions and sinks, with SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import display, scholarly
from quillspark.functions import text as t
from quillspark.functions import vectors as v
from quillspark.operators import evaluation, keywords, sequence, spatial, vector_ops
from quillspark.plans.catalog import _FOLD, _PAIRS, _TOKENS
from quillspark.plans.corpus import _NEAR, _near
from quillspark.plans.registry import FORMATS, cached, register
from quillspark.sources import sinks
from quillspark.sources.tables import read_cluster, shared_folder, table, write_clustered

_STOP = "[" + ", ".join(f"'{w}'" for w in keywords.STOP_WORDS) + "]"
_PHRASES = rf"w AS (SELECT doc_id, lang, list_filter(regexp_extract_all(lower(text), '([a-z][a-z\-]+)', 1), lambda x: NOT list_contains({_STOP}, x)) AS w FROM documents), g AS (SELECT doc_id, lang, unnest(list_distinct(list_concat(w, list_transform(range(1, length(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, length(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS term FROM w)"


@register("q_phrase_topics", f"WITH {_PHRASES}, n AS (SELECT lang AS cluster, term, count(*) AS n FROM g GROUP BY ALL), tot AS (SELECT cluster, sum(n) AS total FROM n GROUP BY cluster), df AS (SELECT term, count(*) AS df FROM n GROUP BY term) SELECT cluster, (row_number() OVER (PARTITION BY cluster ORDER BY round(n / total * ln(1 + (SELECT count(*) FROM tot) / df), 9) DESC, term)) AS place, term, round(n / total * ln(1 + (SELECT count(*) FROM tot) / df), 6) AS score FROM n JOIN tot USING (cluster) JOIN df USING (term) QUALIFY place <= 10")
def phrase_topics(spark: SparkSession, d: str) -> DataFrame:
    return keywords.topics(table(spark, d, "documents"), "lang", "doc_id", "text").withColumn("score", F.round("score", 6))


@register("q_only_candidates", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang || ',en' ELSE lang END AS kept, CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS dropped FROM documents WHERE lang <> 'en'")
def only_candidates(spark: SparkSession, d: str) -> DataFrame:
    words = F.when(F.col("doc_id") % 2 == 0, F.array("lang", "source", F.lit("en"), "lang")).otherwise(F.array("lang"))
    rows = table(spark, d, "documents").where("lang <> 'en'").select("doc_id", words.alias("w"), F.array(*map(F.lit, ("en", "fr", "de", "es"))).alias("c"))
    return keywords.only_candidates(rows, "w", "c").select("doc_id", F.array_join("kept", ",").alias("kept"), F.array_join("dropped", ",").alias("dropped"))


_GRAMS = "list_concat({0}, list_transform(range(1, length({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"


@register("q_group_keywords", f"WITH x AS (SELECT doc_id, source, {_TOKENS} AS w FROM documents WHERE doc_id < 300), f AS (SELECT source, doc_id, unnest({_GRAMS.format('w')}) AS term FROM x), tf AS (SELECT source, doc_id, term, count(*) AS tf FROM f GROUP BY ALL), a AS (SELECT source, term, count(*) AS df, sum(tf) AS n FROM tf GROUP BY source, term QUALIFY row_number() OVER (PARTITION BY source ORDER BY sum(tf) DESC, term) <= 200), s AS (SELECT source, count(DISTINCT doc_id) AS docs FROM tf GROUP BY source), r AS (SELECT source, doc_id, term, tf * (ln((1 + docs) / (1 + df)) + 1) AS x FROM tf JOIN a USING (source, term) JOIN s USING (source)), m AS (SELECT source, doc_id, sqrt(sum(x * x)) AS m FROM r GROUP BY ALL), o AS (SELECT source, term, sum(x / m) AS score FROM r JOIN m USING (source, doc_id) GROUP BY ALL) SELECT source, row_number() OVER (PARTITION BY source ORDER BY round(score, 9) DESC, term) AS place, term, round(score, 6) AS score FROM o QUALIFY place <= 8")
def group_keywords(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("doc_id < 300").withColumn("w", t.tokens(F.col("text")))
    return keywords.group_keywords(docs, "source", "doc_id", "w", features=200).select("source", "place", "term", F.round("score", 6).alias("score"))


@register("q_top_tokens", f"WITH x AS (SELECT lang, unnest({_TOKENS}) AS token FROM documents) SELECT lang, token, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, token) AS place FROM x GROUP BY lang, token QUALIFY place <= 5")
def top_tokens(spark: SparkSession, d: str) -> DataFrame:
    return keywords.top_tokens(table(spark, d, "documents").withColumn("w", t.tokens(F.col("text"))), "lang", "w")


_CHAT = _TOKENS


@register("q_segment_phrases", f"WITH x AS (SELECT role, {_CHAT} AS w FROM conversations), j AS (SELECT role, flatten(list(w)) AS w FROM (SELECT role, w FROM x) GROUP BY role), f AS (SELECT role, unnest(list_filter(w, lambda y: true)) AS term FROM j), tf AS (SELECT role, term, count(*) AS tf FROM f GROUP BY ALL), a AS (SELECT term, count(*) AS df, sum(tf) AS n FROM tf GROUP BY term ORDER BY n DESC, term LIMIT 300), r AS (SELECT role, term, tf * (ln((1 + (SELECT count(*) FROM j)) / (1 + df)) + 1) AS x FROM tf JOIN a USING (term)), m AS (SELECT role, sqrt(sum(x * x)) AS m FROM r GROUP BY role) SELECT role, term, round(x / m, 6) AS score, row_number() OVER (PARTITION BY role ORDER BY round(x / m, 9) DESC, term) AS place FROM r JOIN m USING (role) QUALIFY place <= 5")
def segment_phrases(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("role", t.tokens(F.col("text")).alias("w"))
    return keywords.segment_phrases(rows, "role", "w", features=300, pairs=False).withColumn("score", F.round("score", 6))


@register("q_group_summary", "WITH x AS (SELECT label, vec_id, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings), c AS (SELECT label, list(x ORDER BY pos) AS c FROM (SELECT label, pos, avg(x) AS x FROM x GROUP BY ALL) GROUP BY label), u AS (SELECT label, list_transform(c, lambda y: y / sqrt(list_dot_product(c, c))) AS c FROM c), p AS (SELECT a.label, b.label AS \"similar\", round(list_dot_product(a.c, b.c), 9) AS s FROM u a JOIN u b ON a.label <> b.label QUALIFY row_number() OVER (PARTITION BY a.label ORDER BY s DESC, b.label) = 1), r AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY round(list_dot_product(embedding::double[], c), 9) DESC, vec_id) AS n FROM embeddings JOIN u USING (label) QUALIFY n <= 5), l AS (SELECT label, string_agg(vec_id::varchar, ',' ORDER BY n) AS representatives FROM r GROUP BY label), t AS (SELECT label, 't' || (vec_id % 3) AS topic, count(*) AS n FROM embeddings GROUP BY ALL), o AS (SELECT label, sum(n)::bigint AS size, string_agg(topic || ':' || n, ',' ORDER BY n DESC, topic) AS topics FROM t GROUP BY label) SELECT label, size, topics, representatives, \"similar\", round(s, 6) AS similarity FROM o JOIN l USING (label) JOIN p USING (label)")
def group_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").withColumn("topic", F.concat(F.lit("t"), F.col("vec_id") % 3))
    found = keywords.group_summary(rows, "label", "vec_id", "embedding", "topic")
    return found.select("label", "size", F.array_join("topics", ",").alias("topics"), F.array_join(F.transform("representatives", lambda x: x.cast("string")), ",").alias("representatives"), "similar", F.round("similarity", 6).alias("similarity"))


@register("q_adjusted_mutual_information", "WITH t AS (SELECT source AS a, lang AS b, count(*) AS n FROM documents GROUP BY ALL), x AS (SELECT a, sum(n)::double AS na FROM t GROUP BY a), y AS (SELECT b, sum(n)::double AS nb FROM t GROUP BY b), s AS (SELECT sum(n)::double AS s FROM t), e AS (SELECT sum(k / s * ln(s * k / (na * nb)) * exp(lgamma(na + 1) + lgamma(nb + 1) + lgamma(s - na + 1) + lgamma(s - nb + 1) - lgamma(s + 1) - lgamma(k + 1) - lgamma(na - k + 1) - lgamma(nb - k + 1) - lgamma(s - na - nb + k + 1))) AS e FROM (SELECT na, nb, s, unnest(range(greatest(1, na + nb - s)::bigint, least(na, nb)::bigint + 1))::double AS k FROM x, y, s)), m AS (SELECT sum(n / s * ln(n * s / (na * nb))) AS mi FROM t JOIN x USING (a) JOIN y USING (b), s), h AS (SELECT (SELECT -sum(na / s * ln(na / s)) FROM x, s) AS ha, (SELECT -sum(nb / s * ln(nb / s)) FROM y, s) AS hb) SELECT round((mi - e) / ((ha + hb) / 2 - e), 6) AS ami FROM m, e, h")
def adjusted_mutual_information(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.adjusted_mutual_information(table(spark, d, "documents"), "source", "lang").withColumn("ami", F.round("ami", 6))


@register("q_fragmentation", "WITH t AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), p AS (SELECT lang, n, sum(n) OVER (PARTITION BY lang) AS s FROM t), e AS (SELECT lang, first(s) AS s, count(*) AS active, -sum(n / s * ln(n / s)) AS h FROM p GROUP BY lang) SELECT round(sum(active * s) / sum(s), 6) AS active, round(sum(h / ln((SELECT count(DISTINCT source) FROM documents)) * s) / sum(s), 6) AS entropy FROM e")
def fragmentation(spark: SparkSession, d: str) -> DataFrame:
    found = evaluation.fragmentation(table(spark, d, "documents"), "source", "lang")
    return found.select(F.round("active", 6).alias("active"), F.round("entropy", 6).alias("entropy"))


@register("q_silhouette", "WITH d AS (SELECT a.vec_id AS id, a.label AS c, b.label AS o, sum(list_distance(a.embedding::double[], b.embedding::double[])) AS d, count(*) AS n FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY ALL), s AS (SELECT id, max(d / n) FILTER (WHERE c = o) AS a, min(d / n) FILTER (WHERE c <> o) AS b FROM d GROUP BY id) SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s")
def silhouette(spark: SparkSession, d: str) -> DataFrame:
    return vector_ops.silhouette(table(spark, d, "embeddings"), "vec_id", "embedding", "label").withColumn("silhouette", F.round("silhouette", 6))


#: A projection that keeps the first half of the components.
_HALF = "h AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, round(greatest(1 - list_cosine_similarity(a.embedding[1:32]::double[], b.embedding[1:32]::double[]), 0), 9) AS distance FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id), f AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) <= 10)"


@register("q_recall_at", f"WITH {_NEAR}, {_HALF} SELECT round(count(f.id) / 10 / (SELECT count(DISTINCT id) FROM k), 6) AS recall FROM k LEFT JOIN f USING (id, neighbour)")
def recall_at(spark: SparkSession, d: str) -> DataFrame:
    half = table(spark, d, "embeddings").withColumn("embedding", F.slice("embedding", 1, 32))
    return evaluation.recall_at(vector_ops.neighbours(half, "vec_id", "embedding", 10), _near(spark, d), 10).withColumn("recall", F.round("recall", 6))


@register("q_centroid_agreement", "WITH x AS (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings), c AS (SELECT label, list(x ORDER BY pos) AS c FROM (SELECT label, pos, avg(x) AS x FROM x GROUP BY ALL) GROUP BY label), s AS (SELECT vec_id, e.label, c.label AS cluster, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_cosine_similarity(embedding::double[], c), 9) DESC, c.label) AS n FROM embeddings e, c) SELECT round(avg((n = 1)::int), 6) AS top1, round(avg((n <= 3)::int), 6) AS top3 FROM s WHERE label = cluster")
def centroid_agreement(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    centres = vector_ops.centroids(rows, "label", "embedding").select(F.col("label").alias("cluster"), "centroid")
    scored = rows.crossJoin(F.broadcast(centres)).select(F.col("vec_id").alias("id"), "cluster", F.round(v.cosine(F.col("embedding"), F.col("centroid")), 9).alias("similarity"))
    found = evaluation.centroid_agreement(scored, rows.select(F.col("vec_id").alias("id"), "label"))
    return found.select(F.round("top1", 6).alias("top1"), F.round("top3", 6).alias("top3"))


@register("q_overlap_entropy", "SELECT vec_id, round(-(p * ln(p) + (1 - p) * ln(1 - p)) / ln(2), 6) AS entropy FROM (SELECT vec_id, (vec_id % 9 + 1) / 11 AS p FROM embeddings)")
def overlap_entropy(spark: SparkSession, d: str) -> DataFrame:
    p = (F.col("vec_id") % 9 + 1) / 11
    rows = table(spark, d, "embeddings").select("vec_id", F.array(p, 1 - p).alias("p"))
    return evaluation.overlap_entropy(rows, "p").select("vec_id", F.round("entropy", 6).alias("entropy"))


@register("q_inner_neighbours", "WITH n AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, round(-list_dot_product(a.embedding::double[], b.embedding::double[]), 9) AS d FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) SELECT id, neighbour, row_number() OVER (PARTITION BY id ORDER BY d, neighbour) AS rank FROM n QUALIFY rank <= 30")
def inner_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return vector_ops.neighbours(table(spark, d, "embeddings"), "vec_id", "embedding", 30, measure="inner").select("id", "neighbour", "rank")


@register("q_padded_neighbours", f"WITH {_NEAR} SELECT vec_id AS id, CASE WHEN vec_id % 2 = 0 THEN (SELECT string_agg(neighbour::varchar, ',' ORDER BY rank) FROM k WHERE k.id = vec_id AND rank <= 3) || ',' || vec_id ELSE concat_ws(',', vec_id, vec_id, vec_id, vec_id) END AS neighbours FROM embeddings")
def padded_neighbours(spark: SparkSession, d: str) -> DataFrame:
    near = _near(spark, d).where("rank <= 3 and id % 2 = 0")
    found = vector_ops.padded(near, table(spark, d, "embeddings").select(F.col("vec_id").alias("id")), 4)
    return found.select("id", F.array_join(F.transform("neighbours", lambda x: x.cast("string")), ",").alias("neighbours"))


@register("q_positive_graph", "WITH e AS (SELECT l_suppkey AS u, l_partkey AS v, l_discount - 0.03 AS w FROM lineitem) SELECT least(u, v) AS u, greatest(u, v) AS v, round(max(w), 6) AS w FROM e WHERE u <> v AND w > 0 GROUP BY ALL")
def positive_graph(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("u"), F.col("l_partkey").alias("v"), (F.col("l_discount") - 0.03).alias("w"))
    return vector_ops.positive_graph(edges).withColumn("w", F.round("w", 6))


@register("q_unplaced", "SELECT vec_id AS id, CASE WHEN vec_id % 20 = 0 THEN 'no vector' ELSE 'not finite' END AS reason FROM embeddings WHERE vec_id % 10 = 0")
def unplaced(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").withColumn("x", F.col("embedding")[0])
    bad = rows.withColumn("embedding", F.when(F.col("vec_id") % 20 == 0, None).when(F.col("vec_id") % 10 == 0, F.array(F.lit(float("nan")).cast("float"))).otherwise(F.col("embedding")))
    return vector_ops.place_or_fail(bad, rows.where("vec_id % 10 > 0"), "vec_id", "embedding", ["x"])[1]


@register("q_spherical_means", "WITH e AS (SELECT label, embedding[1:4]::double[] AS v FROM embeddings), p AS (SELECT label, atan2(sqrt(v[2] ** 2 + v[3] ** 2 + v[4] ** 2), v[1]) AS a, atan2(sqrt(v[3] ** 2 + v[4] ** 2), v[2]) AS b, atan2(sqrt(v[4] ** 2), v[3]) AS c FROM e), m AS (SELECT label, abs(atan2(avg(sin(a)), avg(cos(a)))) AS a, abs(atan2(avg(sin(b)), avg(cos(b)))) AS b, abs(atan2(avg(sin(c)), avg(cos(c)))) AS c FROM p GROUP BY label) SELECT label, round(cos(a), 6) AS x0, round(sin(a) * cos(b), 6) AS x1, round(sin(a) * sin(b) * cos(c), 6) AS x2, round(sin(a) * sin(b) * sin(c), 6) AS x3 FROM m")
def spherical_means(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("label", F.slice("embedding", 1, 4).alias("v"))
    found = vector_ops.spherical_means(rows, "label", "v")
    return found.select("label", *(F.round(F.col("mean")[i], 6).alias(f"x{i}") for i in range(4)))


@register("q_window_score", "SELECT round(sum(list_cosine_similarity(a.embedding::double[], b.embedding::double[]) / (b.vec_id - a.vec_id)), 4) AS score FROM embeddings a JOIN embeddings b ON b.vec_id > a.vec_id AND b.vec_id <= a.vec_id + 5")
def window_score(spark: SparkSession, d: str) -> DataFrame:
    return sequence.window_score(table(spark, d, "embeddings"), "vec_id", "embedding").withColumn("score", F.round("score", 4))


@register("q_edge_mass", "WITH p AS (SELECT b.vec_id - a.vec_id AS o, greatest(0, list_cosine_similarity(a.embedding::double[], b.embedding::double[])) AS w FROM embeddings a JOIN embeddings b ON b.vec_id > a.vec_id), w AS (SELECT o, sum(w) AS w FROM p GROUP BY o), c AS (SELECT *, sum(w) OVER (ORDER BY o) AS c, sum(w) OVER () AS t FROM w) SELECT round(sum(w), 3) AS weight, round(sum(w) FILTER (WHERE o = 1) / sum(w), 6) AS adjacent, round(sum(w) FILTER (WHERE o <= 5) / sum(w), 6) AS \"window\", round(sum(w * o) / sum(w), 4) AS distance, min(o) FILTER (WHERE c >= 0.5 * t) AS half, min(o) FILTER (WHERE c >= 0.8 * t) AS most FROM c")
def edge_mass(spark: SparkSession, d: str) -> DataFrame:
    found = sequence.edge_mass(table(spark, d, "embeddings"), "vec_id", "embedding")
    return found.select(F.round("weight", 3).alias("weight"), F.round("adjacent", 6).alias("adjacent"), F.round("window", 6).alias("window"), F.round("distance", 4).alias("distance"), "half", "most")


@register("q_community_measures", f"WITH {_NEAR}, g AS (SELECT least(id, neighbour) AS u, greatest(id, neighbour) AS v, avg(1 - distance) AS w, first(CASE WHEN id < neighbour THEN la ELSE lb END) AS lu, first(CASE WHEN id < neighbour THEN lb ELSE la END) AS lv FROM k GROUP BY ALL), t AS (SELECT 2 * sum(w) AS t, avg((lu = lv)::int) AS coverage FROM g), i AS (SELECT lu AS l, sum(w) AS i FROM g WHERE lu = lv GROUP BY lu), e AS (SELECT l, sum(w) AS vol, sum(w) FILTER (WHERE cut) AS cut FROM (SELECT lu AS l, w, lu <> lv AS cut FROM g UNION ALL SELECT lv, w, lu <> lv FROM g) GROUP BY l), z AS (SELECT label AS l, count(*) AS n FROM embeddings GROUP BY label) SELECT count(*) AS communities, round(first(coverage), 6) AS coverage, round(sum(n * coalesce(i, 0) / (n * (n - 1) / 2)) / sum(n), 6) AS density, round(sum(n * coalesce(cut, 0) / least(vol, t - vol)) / sum(n), 6) AS conductance FROM z LEFT JOIN i USING (l) LEFT JOIN e USING (l), t")
def community_measures(spark: SparkSession, d: str) -> DataFrame:
    graph = vector_ops.undirected(_near(spark, d).select(F.col("id").alias("u"), F.col("neighbour").alias("v"), (1 - F.col("distance")).alias("w")))
    found = sequence.community_measures(graph, table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label"))
    return found.select("communities", *(F.round(c, 6).alias(c) for c in ("coverage", "density", "conductance")))


# scalar functions over whole tables


@register("q_markdown_text", r"""SELECT conv_id, turn, trim(regexp_replace('Title A link ' || regexp_replace(text, '[*_]', '', 'g') || ' b', '\s+', ' ', 'g')) AS text FROM conversations WHERE NOT regexp_matches(text, '[`\[]')""")
def markdown_text(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").where(r"not text rlike '[`\\[]'")
    raw = F.concat(F.lit("# Title\n\n- **A** [link](http://x) `"), F.lit("` "), "text", F.lit("\n2. b"))
    raw = F.concat(F.lit("# Title\n\n- **A** [link](http://x) "), "text", F.lit("\n2. b"))
    return rows.select("conv_id", "turn", t.markdown_to_text(raw).alias("text"))


@register("q_string_lists", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN lang || ';' || source WHEN 1 THEN lang WHEN 2 THEN '' ELSE '' END AS items, CASE doc_id % 4 WHEN 0 THEN lang || ';' || source WHEN 1 THEN lang || ';x' ELSE 'one' END AS words FROM documents")
def string_lists(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id") % 4
    raw = F.when(n == 0, F.to_json(F.array("lang", "source"))).when(n == 1, F.concat(F.lit(" "), "lang")).when(n == 2, " ")
    blob = F.when(n == 0, F.concat("lang", F.lit(" | "), "source", F.lit("|"))).when(n == 1, F.concat("lang", F.lit(", x"))).otherwise(" one ")
    return table(spark, d, "documents").select("doc_id", F.array_join(t.string_list(raw), ";").alias("items"), F.array_join(t.keywords(blob), ";").alias("words"))


_REFERENCE = "'Author A, B C. A title of record ' || doc_id || '. Journal ' || (1990 + n_chars % 30) || '. doi: 10.1234/AB.' || doc_id || '. PMID: ' || (10000 + doc_id)"


def _reference() -> F.Column:
    year = (1990 + F.col("n_chars") % 30).cast("string")
    return F.concat(F.lit("Author A, B C. A title of record "), "doc_id", F.lit(". Journal "), year, F.lit(". doi: 10.1234/AB."), "doc_id", F.lit(". PMID: "), (10000 + F.col("doc_id")).cast("string"))


@register("q_references", "SELECT doc_id, '10.1234/ab.' || doc_id AS doi, (10000 + doc_id)::varchar AS pmid, (1990 + n_chars % 30)::int AS year, 'A title of record ' || doc_id AS title FROM documents")
def references(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").withColumn("r", _reference())
    return rows.select("doc_id", F.array_join(t.dois(F.col("r")), ",").alias("doi"), scholarly.pmid(F.col("r")).alias("pmid"), scholarly.year(F.col("r")).alias("year"), scholarly.guessed_title(F.col("r")).alias("title"))


@register("q_reference_entries", "SELECT doc_id, 'First ' || lang || ' and on|Second ' || source AS entries FROM documents")
def reference_entries(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("1. First "), "lang", F.lit("\n  and   on\n\n- Second "), "source")
    return table(spark, d, "documents").select("doc_id", F.array_join(scholarly.entries(raw), "|").alias("entries"))


@register("q_split_coverage", "SELECT doc_id, doc_id % 3 = 0 AS good FROM documents")
def split_coverage(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id") % 3
    parts = F.when(n == 0, F.array(F.lit("Alpha  beta"), F.lit("gamma"))).when(n == 1, F.array(F.lit("gamma"), F.lit("alpha beta"))).otherwise(F.array(F.lit("alpha")))
    return table(spark, d, "documents").select("doc_id", scholarly.covers(F.lit("alpha beta GAMMA delta"), parts).alias("good"))


@register("q_title_scores", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 1.03 ELSE 1.0 END::double AS same, CASE WHEN doc_id % 2 = 0 THEN 1.03 ELSE 1.0 END::double AS held, 0.0::double AS other FROM documents")
def title_scores(spark: SparkSession, d: str) -> DataFrame:
    year, other = F.lit(2001), F.when(F.col("doc_id") % 2 == 0, 2001).otherwise(1999)
    title = F.concat(F.lit("Title of "), "lang", F.lit(" "), "source")
    mixed = F.concat(F.lit("TITLE of: "), "lang", F.lit("-"), "source")
    return table(spark, d, "documents").select("doc_id", scholarly.candidate_score(title, mixed, year, other).alias("same"), scholarly.reference_score(F.concat(F.lit("A. B.  "), title, F.lit(".")), title, year, other).alias("held"), scholarly.title_similarity(title, F.lit("")).alias("other"))


@register("q_closest_sentences", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 1 END AS n FROM documents")
def closest_sentences(spark: SparkSession, d: str) -> DataFrame:
    quote = F.when(F.col("doc_id") % 2 == 0, "The sky is blue.").otherwise("The sky was blue.")
    return table(spark, d, "documents").select("doc_id", F.size(scholarly.closest_sentences(quote, F.lit("Grass grows. The sky is blue. 42!"))).alias("n"))


@register("q_vocabulary_hits", "SELECT n_nationkey, r_regionkey FROM nation, region WHERE contains(lower(n_name), lower(r_name[1:2]))")
def vocabulary_hits(spark: SparkSession, d: str) -> DataFrame:
    words = F.broadcast(table(spark, d, "region"))
    codes = table(spark, d, "nation")
    hit = scholarly.vocabulary_hits(F.concat(F.lit(" "), F.substring("r_name", 1, 2)), F.col("n_name"), F.lit(""))
    return codes.join(words, hit).select("n_nationkey", "r_regionkey")


@register("q_parallel_references", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '10.1/a;' ELSE '' END AS dois, CASE WHEN doc_id % 2 = 0 THEN 'https://doi.org/10.1/a;http://u' ELSE 'http://u' END AS urls, CASE WHEN doc_id % 2 = 0 THEN lang || ';' ELSE '' END AS titles FROM documents")
def parallel_references(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    ref = lambda doi, url, title: F.struct(doi.alias("doi"), url.alias("url"), title.alias("title"))
    refs = F.array(ref(F.when(F.col("doc_id") % 2 == 0, "10.1/a"), none, F.when(F.col("doc_id") % 2 == 0, F.col("lang"))), ref(none, F.lit(""), none), ref(none, F.lit("http://u"), none))
    made = table(spark, d, "documents").select("doc_id", scholarly.parallel(refs).alias("p"))
    return made.select("doc_id", *(F.array_join(f"p.{c}", ";").alias(c) for c in ("dois", "urls", "titles")))


_DAY = "(doc_id % 28 + 1)::int"


@register("q_windows", f"SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN make_timestamp(2026, 6, {_DAY}, 11, 45, 0) END AS start, CASE WHEN doc_id % 5 > 0 THEN make_timestamp(2026, 6, {_DAY}, 12, 45, 0) END AS \"end\", CASE WHEN doc_id % 5 > 0 THEN 'Day ' || greatest(1, {_DAY} - 14) || ' (' || strftime(make_date(2026, 6, {_DAY}), '%a Jun %d') || ') · 13:45–14:45' END AS label FROM documents")
def windows(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit(" Monday, JUNE "), (F.col("doc_id") % 28 + 1).cast("string"), F.lit(" | 13:45-14:45"))).otherwise("no window")
    start, end = display.window_bounds(raw, 2026)
    return table(spark, d, "documents").select("doc_id", start.alias("start"), end.alias("end")).withColumn("label", display.window_label(F.col("start"), F.col("end"), "2026-06-15")).select("doc_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "label")


@register("q_opacity", "SELECT doc_id, round(least(0.9, greatest(0.12, 40 / greatest(1, n_chars) ** 0.42)), 6) AS density, round(least(0.9, greatest(0.12, least(0.9, greatest(0.12, 40 / greatest(1, n_chars) ** 0.42)) * sqrt(greatest(1, doc_id % 7)))), 6) AS backdrop, round(least(14, greatest(5, 5 * greatest(1, doc_id % 50) ** 0.4)), 6) AS size FROM documents")
def opacity(spark: SparkSession, d: str) -> DataFrame:
    n, z = F.col("n_chars"), F.col("doc_id")
    return table(spark, d, "documents").select("doc_id", F.round(display.density_opacity(n), 6).alias("density"), F.round(display.backdrop_opacity(n, z % 7), 6).alias("backdrop"), F.round(display.marker_size(z % 50), 6).alias("size"))


@register("q_flags", "SELECT doc_id, length(trim(text)) >= 280 AS clampable, CASE WHEN doc_id % 2 = 1 THEN 1 + doc_id % 2 * 2 ELSE 2 END AS session, CASE WHEN doc_id % 3 = 0 THEN false ELSE true END AS safe FROM documents WHERE doc_id > 0")
def flags(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("doc_id")
    name = F.when(key % 3 == 0, F.array(F.lit(".."), F.lit("a/b"), F.lit(" "))[(key % 3).cast("int")]).otherwise("a.txt")
    return table(spark, d, "documents").where("doc_id > 0").select("doc_id", display.clampable(F.col("text")).alias("clampable"), display.session_of((key % 2).cast("int"), key, {0: (1, 2), 1: (3, 4)}).alias("session"), display.path_safe(name).alias("safe"))


@register("q_row_keys", "SELECT n_nationkey, sha256('{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || ',\"none\":null}')[1:12] AS key FROM nation")
def row_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").withColumn("none", F.lit(None).cast("string")).select("n_nationkey", display.row_key("n_name", "n_regionkey", "none").alias("key"))


@register("q_link_status", "SELECT CASE WHEN page_id % 7 = 0 THEN 'none' ELSE (page_id % 4 + 2) || 'xx' END AS status, count(*) AS n FROM pages GROUP BY ALL")
def link_status(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("page_id") % 7 > 0, (F.col("page_id") % 4 + 2) * 100 + 3)
    return table(spark, d, "pages").select(display.status_class(status).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


@register("q_names", "SELECT doc_id, nfc_normalize(lower(source || ' é ü')) AS key, concat_ws(' ', source, CASE WHEN doc_id % 2 = 0 THEN lang END, 'Last') AS name, CASE WHEN doc_id % 3 = 0 THEN source || ', C' WHEN doc_id % 3 = 1 THEN 'P, T' ELSE '' END AS place FROM documents")
def names(spark: SparkSession, d: str) -> DataFrame:
    entry = lambda order, inst, country: F.struct(F.lit(order).alias("affiliation_order"), inst.alias("institution"), F.lit(" ").alias("city"), F.lit(None).cast("string").alias("state"), F.lit(country).alias("country"))
    n = F.col("doc_id") % 3
    places = F.when(n == 0, F.array(entry(1, F.lit("P"), "T"), entry(0, F.col("source"), "C"))).when(n == 1, F.array(entry(2, F.lit("P"), "T")))
    rows = table(spark, d, "documents").withColumn("places", places)
    return rows.select("doc_id", t.name_key(F.concat(F.lit(" "), "source", F.lit(" é Ü "))).alias("key"), t.full_name(F.col("source"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(" "), F.lit("Last")).alias("name"), t.primary_affiliation(F.col("places")).alias("place"))


@register("q_vector_functions", "SELECT vec_id, round(embedding[1]::double / sqrt(list_dot_product(embedding::double[], embedding::double[])), 6) AS unit, round(acos(list_cosine_similarity(embedding::double[], list_reverse(embedding)::double[])), 6) AS angle, vec_id % 5 > 0 AS finite FROM embeddings")
def vector_functions(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("embedding")
    odd = F.when(F.col("vec_id") % 5 == 0, F.array(F.lit(float("inf")).cast("float"))).otherwise(e)
    return table(spark, d, "embeddings").select("vec_id", F.round(v.unit(e)[0], 6).alias("unit"), F.round(v.angular(e, F.reverse(e)), 6).alias("angle"), v.finite(odd).alias("finite"))


@register("q_category_distance", "SELECT a.n_nationkey AS a, b.n_nationkey AS b, CASE WHEN a.n_regionkey <> b.n_regionkey THEN 1.0 WHEN a.n_name[1] = b.n_name[1] THEN 0.0 ELSE 0.5 END::double AS distance FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey")
def category_distance(spark: SparkSession, d: str) -> DataFrame:
    side = lambda x: table(spark, d, "nation").select(F.col("n_nationkey").alias(x), F.col("n_regionkey").alias(f"{x}p"), F.substring("n_name", 1, 1).alias(f"{x}c"))
    return F.broadcast(side("a")).join(side("b"), F.col("a") < F.col("b")).select("a", "b", t.category_distance(F.col("ap"), F.col("ac"), F.col("bp"), F.col("bc")).alias("distance"))


@register("q_grid_cells", "WITH p AS (SELECT vec_id, embedding[1]::double AS x, embedding[2]::double AS y FROM embeddings), s AS (SELECT min(x) AS a, min(y) AS b, greatest(max(x) - min(x), max(y) - min(y)) AS w FROM p) SELECT vec_id, (least(floor((y - b) / w * 8), 7) * 8 + least(floor((x - a) / w * 8), 7))::bigint AS cell FROM p, s")
def grid_cells(spark: SparkSession, d: str) -> DataFrame:
    points = table(spark, d, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    low = points.agg(F.min("x"), F.min("y"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))).first()
    return points.select("vec_id", spatial.cells(points, "x", "y", 8, tuple(low)).cast("long").alias("cell"))


@register("q_tags", "SELECT conv_id, turn, concat_ws(',', CASE WHEN regexp_matches(text, '(?i)\\b(the|of)\\b') THEN 'English' END, CASE WHEN regexp_matches(text, '(?i)\\bund\\b') THEN 'German' END) AS tags FROM conversations")
def tags(spark: SparkSession, d: str) -> DataFrame:
    found = t.tags(F.col("text"), {"English": r"\b(the|of)\b", "German": r"\bund\b"})
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(found, ",").alias("tags"))


# sinks, read again


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@register("q_bundles", "SELECT vec_id, label FROM embeddings WHERE vec_id % 2 = 1 AND label = 3")
def bundles(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "bundles")
    rows = table(spark, d, "embeddings").select("vec_id", "label", F.when(F.col("vec_id") % 2 == 0, "a").otherwise("b").alias("model"), F.concat(F.lit("c"), "label").alias("component"))
    sinks.write_bundles(rows.withColumn("vec_id", F.lit(-1).cast("long")), path, ["model", "component"])
    sinks.write_bundles(rows, path, ["model", "component"])
    return sinks.read_bundle(spark, path, model="b", component="c3")


@register("q_cache", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'fresh ' || lang WHEN doc_id % 2 = 0 THEN 'old' ELSE 'computed' END AS value FROM documents")
def cache(spark: SparkSession, d: str) -> DataFrame:
    docs, path = table(spark, d, "documents"), _path(spark, "cache")
    old = docs.where("doc_id % 2 = 0").select("doc_id", F.lit("old").alias("value"))
    sinks.merge_cache(old, docs.where("doc_id % 3 = 0").select("doc_id", F.concat(F.lit("fresh "), "lang").alias("value")), "doc_id", path)
    return cached(docs, spark.read.parquet(path), "doc_id", lambda rows: rows.withColumn("value", F.lit("computed")))


@register("q_packed", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id BETWEEN 20 AND 90")
def packed(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "packed")
    sinks.write_packed(table(spark, d, "documents").select("doc_id", "lang", "n_chars"), "doc_id", path)
    return sinks.read_packed(spark, path, "doc_id long, lang string, n_chars long", 20, 90)


@register("q_nested_corpus", "SELECT o_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def nested_corpus(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "nested")
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("lines"))
    sinks.write_corpus(table(spark, d, "orders").join(lines, "o_orderkey"), path)
    read = spark.read.parquet(path)
    return read.select("o_orderkey", F.size("lines").cast("long").alias("lines"), F.aggregate("lines.l_quantity", F.lit(0.0), lambda a, x: a + x).alias("quantity"))


@register("q_release", "SELECT doc_id, source FROM documents WHERE doc_id BETWEEN 10 AND 60")
def release(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "release")
    points = table(spark, d, "embeddings").select("vec_id", "label")
    sinks.write_release({"articles": table(spark, d, "documents").drop("text"), "points": points}, path, {"articles": ["doc_id"], "points": ["label", "vec_id"]})
    return sinks.read_range(spark, path, "articles", ["doc_id", "source"], "doc_id", 10, 60)


@register("q_clustered_vectors", "SELECT vec_id FROM embeddings WHERE label = 2")
def clustered_vectors(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "vectors")
    write_clustered(table(spark, d, "embeddings"), path, "label", "vec_id")
    return read_cluster(spark, path, "label", 2).select("vec_id")


@register("q_rollup_sink", "SELECT source, count(*) AS n, avg(n_chars)::double AS size FROM documents GROUP BY source")
def rollup_sink(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "rollup")
    FORMATS.run("parquet", table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.avg("n_chars").alias("size")), path)
    return spark.read.parquet(path)


@register("q_json_shards", "SELECT page_id, url FROM pages")
def json_shards(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "shards")
    FORMATS.run("json", table(spark, d, "pages").select("page_id", "url").repartition(3), path)
    return spark.read.schema("page_id long, url string").json(path)


@register("q_listing", "SELECT page_id, 'a, \"b\" ' || url AS title FROM pages")
def listing(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "listing")
    sinks.write_listing(table(spark, d, "pages").select("page_id", F.concat(F.lit('a, "b" '), "url").alias("title")), path, ["page_id"])
    return sinks.read_listing(spark, path, "page_id long, title string")


@register("q_article_csv", "SELECT doc_id, lang || '|' || source AS words FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, '' FROM documents WHERE doc_id % 2 = 1")
def article_csv(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "articles")
    rows = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.to_json(F.array("lang", "source"))).alias("words"))
    rows.write.csv(path, header=True, escape='"')
    return sinks.read_articles(spark, path, "doc_id long, words string", ["words"]).select("doc_id", F.array_join("words", "|").alias("words"))


@register("q_under_heading", "SELECT n_name AS name, 'x, y' AS slot FROM nation WHERE n_nationkey < 5")
def under_heading(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "program")
    text = F.concat(F.lit('Programme,\n\n,note\nName,Slot\n'), F.array_join(F.collect_list(F.concat("n_name", F.lit(',"x, y"'))), "\n"), F.lit("\n\n"))
    table(spark, d, "nation").where("n_nationkey < 5").agg(text.alias("value")).coalesce(1).write.text(path)
    read = sinks.read_under_heading(spark, path, "Name,", 2)
    return read.select(F.col("cells")[0].alias("name"), F.col("cells")[1].alias("slot"))


@register("q_content_keys", "SELECT page_id, sha256(html) || '/' || url AS key FROM pages")
def content_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", sinks.content_key("html", "url").alias("key"))


@register("q_discovered", "SELECT 'regions' AS input, 1 AS files")
def discovered(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "inputs")
    table(spark, d, "region").select("r_name").coalesce(1).write.text(path)
    found = sinks.discover(sinks.manifest(spark, path, "*.txt"), {"regions": r"^part-.*\.txt$"})
    return found.groupBy("input").agg(F.count("sha256").cast("int").alias("files"))


@register("q_public_authors", "SELECT c_custkey AS id, 0 AS first_order FROM customer")
def public_authors(spark: SparkSession, d: str) -> DataFrame:
    place = lambda i: F.struct(F.lit(i).alias("affiliation_order"), F.lit("x").alias("institution"))
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"), F.lit("m").alias("middle_initial"), F.lit("l").alias("last_name"), F.lit("mail").alias("email"), F.lit(1).alias("submission_id"), F.array(place(2), place(0), place(1)).alias("affiliations"))
    shown = sinks.public_authors(rows)
    return shown.select("id", F.col("affiliations")[0]["affiliation_order"].alias("first_order")) if "email" not in shown.columns else rows.limit(0)


@register("q_normalised_records", "SELECT o_orderkey, 's1,s2' AS sessions, '2,1' AS authors FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, '', '2,1' FROM orders WHERE o_orderkey % 2 = 1")
def normalised_records(spark: SparkSession, d: str) -> DataFrame:
    nested = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.array(F.lit("s1"), F.lit(None).cast("string")), F.array(F.lit("s2"))))
    author = lambda order, key: F.struct(F.lit(order).alias("author_order"), F.lit(key).alias("id"))
    rows = table(spark, d, "orders").select("o_orderkey", nested.alias("sessions"), F.array(author(5, 1), author(3, 2)).alias("authors"))
    made = sinks.normalised(rows)
    return made.select("o_orderkey", F.array_join("sessions", ",").alias("sessions"), F.array_join(F.transform("authors", lambda x: x.cast("string")), ",").alias("authors"))


@register("q_pubmed", "SELECT page_id AS pmid, 'On ' || page_id AS title, E'one\\n\\ntwo' AS abstract, 2001 AS year FROM pages")
def pubmed(spark: SparkSession, d: str) -> DataFrame:
    xml = F.concat(F.lit("<A><PMID>"), "page_id", F.lit("</PMID><ArticleTitle>On "), "page_id", F.lit("</ArticleTitle><AbstractText>one</AbstractText><AbstractText>two</AbstractText><PubDate><Year>2001</Year></PubDate></A>"))
    return table(spark, d, "pages").select(sinks.pubmed(xml).alias("p")).select("p.*")


@register("q_schema_fields", "SELECT n_name || '.' || f AS field, k AS kind, sha256(n_name || '|' || f || '|' || k)[1:12] AS digest FROM nation, (VALUES ('id', 'ID'), ('name', 'String')) v(f, k)")
def schema_fields(spark: SparkSession, d: str) -> DataFrame:
    one = lambda name, kind: F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"))
    return sinks.fields(table(spark, d, "nation").select(F.col("n_name").alias("type"), F.array(one("id", "ID"), one("name", "String")).alias("fields")))


@register("q_consumed_fields", "SELECT source AS field, array_to_string(list_sort(list(DISTINCT lang)), ',') AS modules FROM documents GROUP BY source")
def consumed_fields(spark: SparkSession, d: str) -> DataFrame:
    uses = table(spark, d, "documents").select(F.col("source").alias("field"), F.col("lang").alias("module"))
    return sinks.consumed(uses).withColumn("modules", F.array_join("modules", ","))


__all__ = ["_FOLD", "_PAIRS"]
