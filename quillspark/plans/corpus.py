"""Registered queries of the corpus build, of ranked lists, of semantic search, of keywords and of measures, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import display, scholarly
from quillspark.functions import text as t
from quillspark.functions import vectors as v
from quillspark.operators import corpus, evaluation, keywords, ranking, relational, search, semantic, sequence, spatial, vector_ops
from quillspark.plans import catalog
from quillspark.plans.catalog import _FOLD, _PAIRS, _TOKENS
from quillspark.plans.registry import cached, register
from quillspark.sources.tables import table

_STATES = "CASE n_chars % 6 WHEN 0 THEN 'Withdrawn' WHEN 1 THEN ' withdrawn' WHEN 2 THEN NULL WHEN 3 THEN 'Oral' ELSE 'Poster' END AS decision, CASE WHEN doc_id % 11 = 0 THEN '' ELSE lpad(doc_id::varchar, 7, '0') END AS poster"


def _records(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a decision and a poster number."""
    n = F.col("n_chars") % 6
    decision = F.when(n == 0, "Withdrawn").when(n == 1, " withdrawn").when(n == 2, None).when(n == 3, "Oral").otherwise("Poster")
    return table(spark, d, "documents").withColumn("decision", decision).withColumn("poster", F.when(F.col("doc_id") % 11 == 0, "").otherwise(F.lpad(F.col("doc_id").cast("string"), 7, "0")))


@register("q_accepted", f"SELECT doc_id, poster::int AS poster FROM (SELECT *, {_STATES} FROM documents) WHERE decision IS DISTINCT FROM 'Withdrawn' AND poster <> '' AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def accepted(spark: SparkSession, d: str) -> DataFrame:
    return corpus.accepted(_records(spark, d), "doc_id", "decision", "poster", table(spark, d, "labels").where("toxic = 1")).select("doc_id", "poster")


@register("q_not_withdrawn", f"SELECT doc_id FROM (SELECT *, {_STATES} FROM documents) WHERE lower(trim(coalesce(decision, ''))) <> 'withdrawn'")
def not_withdrawn(spark: SparkSession, d: str) -> DataFrame:
    return corpus.not_withdrawn(_records(spark, d), "decision").select("doc_id")


@register("q_columns", "SELECT doc_id, lang, source FROM documents")
def columns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang", "source")


_SAVED = "SELECT DISTINCT role AS kind, conv_id AS id FROM conversations"


def _saved(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "conversations").select(F.col("role").alias("kind"), F.col("conv_id").alias("id"))
    return corpus.saved_scope(items, table(spark, d, "pages").where("page_id % 3 > 0").select(F.lit("user").alias("kind"), F.col("page_id").alias("id")))


@register("q_saved_scope", f"SELECT kind, id, kind = 'user' AND id IN (SELECT page_id FROM pages WHERE page_id % 3 > 0) AS shown FROM ({_SAVED})")
def saved_scope(spark: SparkSession, d: str) -> DataFrame:
    return _saved(spark, d)


@register("q_hidden", f"SELECT count(*) AS hidden, array_to_string(list_sort(list(DISTINCT kind)), ',') AS kinds FROM ({_SAVED}) WHERE NOT (kind = 'user' AND id IN (SELECT page_id FROM pages WHERE page_id % 3 > 0))")
def hidden(spark: SparkSession, d: str) -> DataFrame:
    return corpus.hidden_summary(_saved(spark, d))


@register("q_pick_list", "SELECT c_nationkey, n_name AS title, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE contains(lower(n_name), 'n') GROUP BY ALL")
def pick_list(spark: SparkSession, d: str) -> DataFrame:
    titles = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("title"))
    return corpus.pick_list(table(spark, d, "customer"), "c_nationkey", titles, "Ń")


@register("q_backdrop", "SELECT p_partkey FROM part WHERE p_size BETWEEN 5 AND 20 AND p_brand IN (SELECT p_brand FROM part WHERE p_partkey <= 3)")
def backdrop(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part")
    brands = [r["p_brand"] for r in rows.where("p_partkey <= 3").collect()]
    return corpus.backdrop(rows, "p_size", (5, 20), "p_brand", brands).select("p_partkey")


@register("q_map_points", "SELECT vec_id FROM embeddings WHERE vec_id % 7 = 0 OR vec_id % 4 <= 1")
def map_points(spark: SparkSession, d: str) -> DataFrame:
    level = F.when(F.col("vec_id") % 7 > 0, F.col("vec_id") % 4)
    return corpus.up_to_level(table(spark, d, "embeddings").withColumn("lod", level), "lod", 1).select("vec_id")


@register("q_category_records", f"SELECT doc_id, trim(decision) AS decision, trim(source) AS title, lang AS parent, lang || ' :: ' || CASE WHEN doc_id % 2 = 0 THEN source ELSE 'Unknown' END AS exact FROM (SELECT *, {_STATES} FROM documents) WHERE trim(decision) IN ('Poster', 'Oral')")
def category_records(spark: SparkSession, d: str) -> DataFrame:
    rows = _records(spark, d).withColumn("c", F.when(F.col("doc_id") % 2 == 0, F.array("lang", "source")).otherwise(F.array("lang")))
    return corpus.category_records(rows, "doc_id", "decision", "source", "c")


@register("q_topic_defaults", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Unknown' ELSE lang END AS parent, CASE WHEN doc_id % 3 = 0 THEN 'Unknown' WHEN doc_id % 3 = 1 THEN lang ELSE source END AS sub, CASE WHEN doc_id % 3 = 0 OR lang = 'en' THEN 'en' ELSE lang || ',en' END AS facets FROM documents")
def topic_defaults(spark: SparkSession, d: str) -> DataFrame:
    values = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).when(F.col("doc_id") % 3 == 1, F.array("lang")).otherwise(F.array("lang", "source"))
    rows = table(spark, d, "documents").withColumn("v", values)
    first = F.when(F.col("doc_id") % 3 > 0, F.col("lang"))
    return rows.select("doc_id", corpus.topic_parent(F.col("v")).alias("parent"), corpus.topic_subcategory(F.col("v")).alias("sub"), F.array_join(corpus.facet_values(first, F.lit("en")), ",").alias("facets"))


@register("q_with_defaults", "SELECT doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 9) AS toxic, coalesce(b.text, '') AS item, coalesce(u.url, 'none') AS url FROM documents LEFT JOIN labels l USING (doc_id) LEFT JOIN benchmark b ON b.item_id = doc_id LEFT JOIN pages u ON u.page_id = doc_id")
def with_defaults(spark: SparkSession, d: str) -> DataFrame:
    part = lambda name, key, value: table(spark, d, name).select(F.col(key).alias("doc_id"), F.col(value).alias("value"))
    parts = {"quality": (part("labels", "doc_id", "quality"), F.lit(-1)), "toxic": (part("labels", "doc_id", "toxic"), F.lit(9)), "item": (part("benchmark", "item_id", "text"), F.lit("")), "url": (part("pages", "page_id", "url"), F.lit("none"))}
    return corpus.with_defaults(table(spark, d, "documents").select("doc_id"), "doc_id", parts)


@register("q_members", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def members(spark: SparkSession, d: str) -> DataFrame:
    accepted_ids = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return corpus.members(table(spark, d, "lineitem"), "l_orderkey", accepted_ids).select("l_orderkey", "l_linenumber")


@register("q_with_vectors", "SELECT doc_id, label, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents JOIN embeddings ON vec_id = doc_id")
def with_vectors(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").join(table(spark, d, "embeddings"), F.col("doc_id") == F.col("vec_id")).select("doc_id", "label")
    return relational.dense_ids(rows, ["doc_id"], "place")


@register("q_labels_in_use", "SELECT DISTINCT c_nationkey, CASE WHEN c_nationkey < 15 THEN n_name END AS name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def labels_in_use(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "nation").where("n_nationkey < 15").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("name"))
    return corpus.labels_in_use(table(spark, d, "customer"), "c_nationkey", names)


@register("q_cells", "SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def cells(spark: SparkSession, d: str) -> DataFrame:
    return corpus.cells(table(spark, d, "documents").select("doc_id"), "doc_id", table(spark, d, "labels"), ["quality", "toxic"])


@register("q_rollup_all", "SELECT id, q::double AS quality, n::double AS size, e::double AS label FROM (SELECT doc_id AS id, quality AS q FROM labels) FULL JOIN (SELECT doc_id AS id, n_chars AS n FROM documents WHERE doc_id % 2 = 0) USING (id) FULL JOIN (SELECT vec_id AS id, label AS e FROM embeddings) USING (id)")
def rollup_all(spark: SparkSession, d: str) -> DataFrame:
    part = lambda name, key, value: table(spark, d, name).select(F.col(key).alias("id"), F.col(value).alias("value"))
    return corpus.rollup_all({"quality": part("labels", "doc_id", "quality"), "size": part("documents", "doc_id", "n_chars").where("id % 2 = 0"), "label": part("embeddings", "vec_id", "label")}, "id")


@register("q_mean_vectors", "WITH f AS (SELECT vec_id AS id, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings UNION ALL SELECT vec_id + 100, unnest(embedding)::double, generate_subscripts(embedding, 1) - 1 FROM embeddings), m AS (SELECT id, pos, avg(x) AS x, count(*) AS parts FROM f GROUP BY ALL), s AS (SELECT id, sqrt(sum(x * x)) AS s FROM m GROUP BY id) SELECT id, pos::int AS pos, round(x / s, 6) AS x, parts FROM m JOIN s USING (id) WHERE pos < 4")
def mean_vectors(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    found = corpus.mean_vectors([one, one.withColumn("id", F.col("id") + 100)], "id", "embedding")
    return found.select("id", F.posexplode("embedding").alias("pos", "x"), "parts").where("pos < 4").withColumn("x", F.round("x", 6))


_THREE = "SELECT vec_id, label, embedding[1]::double AS x, embedding[2]::double AS y, embedding[3]::double AS z FROM embeddings"


@register("q_inherit", f"WITH p AS ({_THREE}), d AS (SELECT a.vec_id AS id, b.vec_id AS b, b.label, round((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2, 9) AS d FROM p a JOIN p b ON a.vec_id % 10 = 0 AND b.vec_id % 10 <> 0) SELECT id, label FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, b) = 1")
def inherit(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", "label", F.slice(F.col("embedding").cast("array<double>"), 1, 3).alias("at"))
    return vector_ops.inherit(rows.where("vec_id % 10 = 0"), rows.where("vec_id % 10 <> 0"), "vec_id", "at", ["label"])


_NEAR = f"{_PAIRS}, k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS rank FROM n QUALIFY rank <= 10)"


def _near(spark: SparkSession, d: str) -> DataFrame:
    return vector_ops.neighbours(table(spark, d, "embeddings"), "vec_id", "embedding", 10)


@register("q_expand_keeping", f"WITH {_NEAR} SELECT vec_id AS id FROM embeddings WHERE vec_id % 25 = 0 UNION SELECT neighbour FROM k WHERE id % 25 = 0")
def expand_keeping(spark: SparkSession, d: str) -> DataFrame:
    return semantic.expand_keeping(table(spark, d, "embeddings").where("vec_id % 25 = 0").select(F.col("vec_id").alias("id")), _near(spark, d))


@register("q_label_map", "SELECT DISTINCT c_nationkey AS cluster, CASE WHEN c_nationkey % 3 = 0 THEN n_name WHEN c_nationkey % 3 = 1 THEN 'raw ' || c_nationkey END AS label FROM customer JOIN nation ON n_nationkey = c_nationkey")
def label_map(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "cluster")
    titles = nation.select("cluster", F.when(F.col("cluster") % 3 == 0, F.col("n_name")).otherwise(" ").alias("label"))
    raw = nation.where("cluster % 3 < 2").select("cluster", F.concat(F.lit("raw "), "cluster").alias("label"))
    return corpus.label_of(table(spark, d, "customer").select(F.col("c_nationkey").alias("cluster")), "cluster", [titles, raw])


@register("q_state_mismatches", "WITH a AS (SELECT doc_id AS artifact, lang AS state FROM documents WHERE doc_id % 5 > 0), b AS (SELECT doc_id AS artifact, CASE WHEN doc_id % 3 = 0 THEN 'en' ELSE lang END AS state FROM documents WHERE doc_id % 7 > 0) SELECT artifact, a.state AS \"left\", b.state AS \"right\" FROM a FULL JOIN b USING (artifact) WHERE a.state IS DISTINCT FROM b.state")
def state_mismatches(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("artifact"), F.col("lang").alias("state"))
    other = docs.where("artifact % 7 > 0").withColumn("state", F.when(F.col("artifact") % 3 == 0, "en").otherwise(F.col("state")))
    return corpus.state_mismatches(docs.where("artifact % 5 > 0"), other)


@register("q_by_author", "SELECT doc_id FROM documents WHERE source = 'src1' OR lang = 'fr'")
def by_author(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").withColumn("authors", F.array(F.upper("source"), F.concat(F.lit(" "), "lang")))
    return corpus.by_author(rows, "authors", [" Ŝrc1 ", "FR"]).select("doc_id")


@register("q_cluster_labels", "SELECT vec_id, CASE WHEN label % 3 = 0 THEN 'title ' || label WHEN label % 3 = 1 THEN 'a, b, c' || label ELSE 'cluster ' || label END AS label FROM embeddings WHERE label <> 4")
def cluster_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", F.col("label").alias("cluster"))
    n = F.col("cluster") % 3
    topics = rows.select("cluster").distinct().where("cluster <> 4").select("cluster", F.when(n == 0, F.concat(F.lit("title "), "cluster")).when(n == 1, "").alias("title"), F.when(n == 1, F.array(F.lit("a"), F.lit("b"), F.concat(F.lit("c"), "cluster"), F.lit("d"))).otherwise(F.array().cast("array<string>")).alias("keywords"))
    return corpus.cluster_labels(rows, "cluster", topics).select("vec_id", "label")


@register("q_most_similar", f"WITH {_NEAR} SELECT id AS vec_id, (rank - 1)::int AS place, neighbour AS id, 'v' || neighbour AS title FROM k WHERE neighbour % 3 > 0")
def most_similar(spark: SparkSession, d: str) -> DataFrame:
    lists = _near(spark, d).groupBy(F.col("id").alias("vec_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "neighbour"))), lambda s: s["neighbour"]).alias("n"))
    known = table(spark, d, "embeddings").where("vec_id % 3 > 0").select(F.col("vec_id").alias("id"), F.concat(F.lit("v"), "vec_id").alias("title"))
    return corpus.most_similar(lists, "vec_id", "n", known)


@register("q_recounted", "SELECT c_custkey, uses FROM customer JOIN (SELECT o_custkey, count(DISTINCT o_orderpriority) AS uses FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey")
def recounted(spark: SparkSession, d: str) -> DataFrame:
    uses = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("user"))
    return corpus.recounted(table(spark, d, "customer").select("c_custkey", F.lit(0).alias("uses")), uses, "c_custkey")


_CELLS = "SELECT l_returnflag AS cell, l_suppkey AS id, l_partkey AS neighbour, l_discount + l_quantity / 100 AS distance FROM lineitem"


def _related(spark: SparkSession, d: str, farthest: bool) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("cell"), F.col("l_suppkey").alias("id"), F.col("l_partkey").alias("neighbour"), (F.col("l_discount") + F.col("l_quantity") / 100).alias("distance"))
    found = corpus.related(rows, 1, table(spark, d, "part").where("p_size < 30").select(F.col("p_partkey").alias("id")), farthest)
    return found.select("id", F.round("least", 6).alias("least"), F.round("mean", 6).alias("mean"), "cells")


@register("q_related", f"SELECT neighbour AS id, round(min(distance), 6) AS least, round(avg(distance), 6) AS mean, count(*) AS cells FROM ({_CELLS}) WHERE id = 1 AND neighbour IN (SELECT p_partkey FROM part WHERE p_size < 30) GROUP BY neighbour")
def related(spark: SparkSession, d: str) -> DataFrame:
    return _related(spark, d, False)


@register("q_most_different", f"SELECT neighbour AS id, round(avg(distance), 6) AS mean FROM ({_CELLS}) WHERE id = 1 AND neighbour IN (SELECT p_partkey FROM part WHERE p_size < 30) GROUP BY neighbour ORDER BY avg(distance) DESC, count(*) DESC, neighbour LIMIT 5")
def most_different(spark: SparkSession, d: str) -> DataFrame:
    return _related(spark, d, True).limit(5).select("id", "mean")


_PLACED = "SELECT c_mktsegment AS label, c_nationkey % 4 AS session FROM customer"


def _placed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_mktsegment").alias("label"), (F.col("c_nationkey") % 4).alias("session"))


@register("q_discoverability", f"WITH r AS ({_PLACED}), n AS (SELECT *, (SELECT count(*) FROM r o WHERE o.label = r.label AND o.session <> r.session) AS outside, (SELECT count(*) FROM r o WHERE o.label = r.label AND o.session = xor(r.session, 1)) AS paired FROM r) SELECT session, round(avg(outside), 6) AS outside, round(avg(paired), 6) AS paired, round(avg((paired > 0)::int), 6) AS found FROM n GROUP BY session")
def discoverability(spark: SparkSession, d: str) -> DataFrame:
    pairs = spark.createDataFrame([(0, 1), (1, 0), (2, 3), (3, 2)], "session int, paired int")
    found = corpus.discoverability(_placed(spark, d), "label", "session", pairs)
    return found.select("session", *(F.round(c, 6).alias(c) for c in ("outside", "paired", "found")))


@register("q_session_summary", f"WITH r AS ({_PLACED}) SELECT session, label, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT * FROM (VALUES (4, NULL, 0), (5, NULL, 0))")
def session_summary(spark: SparkSession, d: str) -> DataFrame:
    return corpus.session_summary(_placed(spark, d), "session", "label", spark.range(6).select(F.col("id").cast("int").alias("session")))


@register("q_telemetry", "SELECT event_type, count(*) AS runs, round(sum(value), 4) AS value, count(*) FILTER (WHERE value < 5) AS failures, round(count(*) FILTER (WHERE value < 5) / count(*), 6) AS rate, count(*) FILTER (WHERE value < 5) / count(*) > 0.05 AS over FROM events GROUP BY event_type")
def telemetry(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("failed", F.col("value") < 5)
    return corpus.telemetry(rows, "event_type", ["value"], "failed", 0.05).withColumn("value", F.round("value", 4)).withColumn("rate", F.round("rate", 6))


@register("q_set_difference", "SELECT doc_id, 'missing' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT vec_id FROM embeddings) UNION ALL SELECT vec_id, 'extra' FROM (SELECT vec_id FROM embeddings EXCEPT SELECT doc_id FROM documents)")
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    return corpus.set_difference(table(spark, d, "documents"), table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id")), "doc_id")


@register("q_selected", "SELECT page_id AS id, url AS title FROM pages WHERE page_id = 7")
def selected(spark: SparkSession, d: str) -> DataFrame:
    shown = lambda name, key, title: table(spark, d, name).select(F.col(key).alias("id"), F.col(title).alias("title"))
    return corpus.selected({"document": shown("documents", "doc_id", "source"), "page": shown("pages", "page_id", "url")}, "page", 7)


@register("q_selected_nothing", "SELECT doc_id AS id FROM documents WHERE false")
def selected_nothing(spark: SparkSession, d: str) -> DataFrame:
    return corpus.selected({"document": table(spark, d, "documents").select(F.col("doc_id").alias("id"))}, "other", 7)


@register("q_shuffled", "SELECT doc_id FROM documents")
def shuffled(spark: SparkSession, d: str) -> DataFrame:
    return corpus.shuffled(table(spark, d, "documents").select("doc_id"), "doc_id", 5).select("doc_id")


_BOOK = "SELECT doc_id AS poster_id, CASE WHEN doc_id % 2 = 0 THEN upper(source) ELSE source END || ' ' || (n_chars % 10) AS title, lang, source FROM documents"


def _book(spark: SparkSession, d: str, order: str) -> DataFrame:
    title = F.concat(F.when(F.col("doc_id") % 2 == 0, F.upper("source")).otherwise(F.col("source")), F.lit(" "), F.col("n_chars") % 10)
    author = F.struct(F.upper("lang").alias("last_name"), F.col("source").alias("first_name"))
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("poster_id"), title.alias("title"), F.when(F.col("doc_id") % 5 > 0, F.array(author)).otherwise(F.array().cast("array<struct<last_name:string,first_name:string>>")).alias("authors"))
    return corpus.sorted_book(rows, order).select("poster_id", "place")


@register("q_book_by_title", f"SELECT poster_id, row_number() OVER (ORDER BY lower(title), poster_id) - 1 AS place FROM ({_BOOK})")
def book_by_title(spark: SparkSession, d: str) -> DataFrame:
    return _book(spark, d, "title")


@register("q_book_by_author", f"SELECT poster_id, row_number() OVER (ORDER BY CASE WHEN poster_id % 5 > 0 THEN lang ELSE '' END, CASE WHEN poster_id % 5 > 0 THEN source ELSE '' END, lower(title), poster_id) - 1 AS place FROM ({_BOOK})")
def book_by_author(spark: SparkSession, d: str) -> DataFrame:
    return _book(spark, d, "first_author")


@register("q_book_by_poster", "SELECT doc_id AS poster_id, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents")
def book_by_poster(spark: SparkSession, d: str) -> DataFrame:
    return _book(spark, d, "poster_id")


@register("q_append_semantic", "WITH l AS (SELECT 'a' AS kind, doc_id AS id, n_chars * 1000000 + doc_id AS o FROM documents WHERE lang = 'fr'), s AS (SELECT 'a' AS kind, doc_id AS id, (doc_id % 17)::double AS d FROM documents WHERE n_chars % 2 = 0 UNION ALL SELECT 'b', page_id, (page_id % 5)::double FROM pages), u AS (SELECT kind, id, 0 AS section, (row_number() OVER (ORDER BY o))::double AS o FROM l UNION ALL SELECT kind, id, 1, d FROM s WHERE (kind, id) NOT IN (SELECT (kind, id) FROM l)) SELECT kind, id, section, row_number() OVER (ORDER BY section, o, kind, id) - 1 AS place FROM u")
def append_semantic(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    lexical = relational.dense_ids(docs.where("lang = 'fr'").select(F.lit("a").alias("kind"), F.col("doc_id").alias("id"), "n_chars"), ["n_chars", "id"], "place")
    near = docs.where("n_chars % 2 = 0").select(F.lit("a").alias("kind"), F.col("doc_id").alias("id"), (F.col("doc_id") % 17).alias("distance"))
    pages = table(spark, d, "pages").select(F.lit("b").alias("kind"), F.col("page_id").alias("id"), (F.col("page_id") % 5).alias("distance"))
    return ranking.append_semantic(lexical, near.union(pages))


@register("q_sort_keys", "WITH u AS (SELECT 'overlay' AS kind, page_id AS id, -(page_id % 3)::double AS a, -page_id::double AS b FROM pages UNION ALL SELECT 'article', doc_id, -(doc_id % 3)::double, -(1990 + n_chars % 30)::double FROM documents) SELECT kind, id, row_number() OVER (ORDER BY a, b, kind, id) - 1 AS place FROM u")
def sort_keys(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("id")
    over = ranking.sort_keys("overlay", key % 3, key)
    article = ranking.sort_keys("article", key % 3, key, F.col("year"))
    pages = table(spark, d, "pages").select(F.lit("overlay").alias("kind"), F.col("page_id").alias("id")).select("kind", "id", over[0].alias("a"), over[1].alias("b"))
    docs = table(spark, d, "documents").select(F.lit("article").alias("kind"), F.col("doc_id").alias("id"), (1990 + F.col("n_chars") % 30).alias("year")).select("kind", "id", article[0].alias("a"), article[1].alias("b"))
    return relational.dense_ids(pages.union(docs), ["a", "b", "kind", "id"], "place").select("kind", "id", "place")


@register("q_sort_keys_empty", "WITH u AS (SELECT 'overlay' AS kind, page_id AS id, -1.0::double AS a, page_id::double AS b FROM pages UNION ALL SELECT 'article', doc_id, -(1990 + n_chars % 30)::double, doc_id::double FROM documents) SELECT kind, id, row_number() OVER (ORDER BY a, b, kind, id) - 1 AS place FROM u")
def sort_keys_empty(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("id")
    over, article = ranking.sort_keys("overlay", None, key), ranking.sort_keys("article", None, key, F.col("year"))
    pages = table(spark, d, "pages").select(F.lit("overlay").alias("kind"), F.col("page_id").alias("id")).select("kind", "id", over[0].alias("a"), over[1].alias("b"))
    docs = table(spark, d, "documents").select(F.lit("article").alias("kind"), F.col("doc_id").alias("id"), (1990 + F.col("n_chars") % 30).alias("year")).select("kind", "id", article[0].alias("a"), article[1].alias("b"))
    return relational.dense_ids(pages.union(docs), ["a", "b", "kind", "id"], "place").select("kind", "id", "place")


@register("q_seed_list", "SELECT doc_id AS id, n_chars % 4 AS score, 1990 + n_chars % 30 AS year FROM documents WHERE n_chars % 4 > 0 ORDER BY score DESC, year DESC, id LIMIT 25")
def seed_list(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), (F.col("n_chars") % 4).alias("score"), (1990 + F.col("n_chars") % 30).alias("year"))
    return ranking.seed_list(docs.where("score > 0").select("id", "score"), docs)


#: Spaces are kept, as a phrase must be found as it stands.
_LEGACY = f"WITH x AS (SELECT doc_id, lower(source) AS title, lower(text) AS body, {_TOKENS} AS b, {_TOKENS.replace('lower(text)', 'lower(source)')} AS s, [lang] AS l FROM documents), y AS (SELECT *, list_concat(b, s, l) AS every FROM x)"


def _legacy(spark: SparkSession, d: str) -> tuple[DataFrame, ranking.Record]:
    rows = table(spark, d, "documents").withColumn("title", F.lower("source"))
    return rows, ranking.Record(F.col("title"), F.lower("text"), [(t.tokens(F.col("source")), 10.0), (F.array("lang"), 6.0), (t.tokens(F.col("text")), 1.5)])


@register("q_weighted_search", _LEGACY + " SELECT doc_id, greatest(CASE WHEN list_contains(every, 'the') AND contains(body, 'of the') AND NOT list_contains(every, 'fr') THEN length(list_filter(b, lambda w: w = 'the')) * 1.5 + 10 ELSE 0 END, CASE WHEN list_contains(every, 'src1') THEN length(list_filter(s, lambda w: w = 'src1')) * 10.0 ELSE 0 END, CASE WHEN NOT list_contains(every, 'en') AND NOT list_contains(every, 'de') THEN 1.0 ELSE 0 END)::double AS score FROM y WHERE score > 0")
def weighted_search(spark: SparkSession, d: str) -> DataFrame:
    rows, record = _legacy(spark, d)
    return ranking.ranked(rows, ranking.weighted_score(record, ranking.parse('the "of the" -fr or SRC1 Or -en -de'))).select("doc_id", "score")


@register("q_semantic_threshold", "SELECT doc_id, (n_chars % 10) / 10.0::double AS score FROM documents WHERE n_chars % 10 >= 6")
def semantic_threshold(spark: SparkSession, d: str) -> DataFrame:
    return ranking.ranked(_legacy(spark, d)[0], F.col("n_chars") % 10 / 10, 0.6).select("doc_id", "score")


@register("q_options_with_selected", "SELECT source AS value, count(*) AS n FROM documents WHERE lang = 'es' GROUP BY source UNION ALL SELECT 'nowhere', 0")
def options_with_selected(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("lang = 'es'").withColumn("v", F.array("source"))
    seen = [r["source"] for r in rows.select("source").distinct().collect()]
    return ranking.options_with_selected(rows, "v", ["nowhere", *seen[:1]])


#: Runs of a benchmark: a supplier is a run, its lines give the measures.
_RUNS = "SELECT l_suppkey AS name, round(avg(l_discount), 6) AS silhouette, round(avg(l_tax), 6) AS agreement, round(avg(l_quantity), 6) AS ratio, round(stddev_pop(l_discount), 6) AS modularity, count(*) AS labels, max(l_quantity) AS calinski_harabasz, min(l_quantity) AS davies_bouldin, round(avg(l_extendedprice), 4) AS entropy, 1.0::double AS largest, l_suppkey % 4 AS evaluation FROM lineitem GROUP BY l_suppkey"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    runs = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("name")).agg(F.round(F.avg("l_discount"), 6).alias("silhouette"), F.round(F.avg("l_tax"), 6).alias("agreement"), F.round(F.avg(q), 6).alias("ratio"), F.round(F.stddev_pop("l_discount"), 6).alias("modularity"), F.count("*").alias("labels"), F.max(q).alias("calinski_harabasz"), F.min(q).alias("davies_bouldin"), F.round(F.avg("l_extendedprice"), 4).alias("entropy"))
    return runs.withColumn("largest", F.lit(1.0)).withColumn("evaluation", F.col("name") % 4)


@register("q_composite", f"WITH r AS ({_RUNS}), v AS (SELECT * FROM r WHERE name % 9 > 0), e AS (SELECT min(silhouette) AS a, max(silhouette) AS b, min(ratio) AS c, max(ratio) AS d, min(calinski_harabasz) AS e, max(calinski_harabasz) AS f, min(davies_bouldin) AS g, max(davies_bouldin) AS h, min(entropy) AS i, max(entropy) AS j FROM v) SELECT name, round(CASE WHEN name % 9 = 0 THEN -1 ELSE 0.3 * (silhouette - a) / (b - a) + 0.2 * (ratio - c) / (d - c) + 0.15 * CASE WHEN f > e THEN (calinski_harabasz - e) / (f - e) ELSE 1 END + 0.15 * CASE WHEN h > g THEN 1 - (davies_bouldin - g) / (h - g) ELSE 1 END + 0.1 * (entropy - i) / (j - i) + 0.1 END, 6) AS composite FROM r, e")
def composite(spark: SparkSession, d: str) -> DataFrame:
    return ranking.composite(_runs(spark, d), ranking.BENCHMARK, "name % 9 > 0").select("name", F.round("composite", 6).alias("composite"))


_SCORED = f"SELECT *, round(0.3 * silhouette + 0.3 * agreement + 0.2 * ratio + 0.2 * modularity, 6) AS comparison, CASE WHEN name % 3 = 0 THEN 'low' WHEN name % 3 = 1 THEN 'mid' ELSE 'outside_target_band' END AS band FROM ({_RUNS})"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    score = ranking.comparison_score(F.col("silhouette"), F.col("agreement"), F.col("ratio"), F.col("modularity"))
    return _runs(spark, d).withColumn("comparison", F.round(score, 6)).withColumn("band", ranking.band(F.col("name") % 3, [("low", 0, 0), ("mid", 1, 1)]))


@register("q_best_by_band", f"SELECT band, name, comparison FROM ({_SCORED}) QUALIFY row_number() OVER (PARTITION BY band ORDER BY comparison DESC, silhouette DESC, agreement DESC, labels, name) = 1")
def best_by_band(spark: SparkSession, d: str) -> DataFrame:
    return ranking.best_by_band(_scored(spark, d)).select("band", "name", "comparison")


@register("q_cross_rollup", f"WITH s AS ({_SCORED}), b AS (SELECT evaluation, min(name) AS name FROM s GROUP BY evaluation), base AS (SELECT s.evaluation, silhouette AS bs, agreement AS ba, modularity AS bm FROM s JOIN b USING (evaluation, name)), w AS (SELECT * FROM s WHERE name NOT IN (SELECT name FROM b) QUALIFY row_number() OVER (PARTITION BY evaluation, band ORDER BY comparison DESC, silhouette DESC, agreement DESC, labels, name) = 1), r AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY comparison DESC, silhouette DESC, agreement DESC, labels DESC, evaluation DESC, name DESC) AS band_rank, row_number() OVER (PARTITION BY evaluation ORDER BY comparison DESC, silhouette DESC, agreement DESC, labels DESC, evaluation DESC, name DESC) = 1 AS best_of_evaluation, row_number() OVER (ORDER BY comparison DESC, silhouette DESC, agreement DESC, labels DESC, evaluation DESC, name DESC) = 1 AS best FROM w JOIN base USING (evaluation)) SELECT evaluation, band, name::varchar AS name, round(silhouette - bs, 6) AS silhouette_gain, round(agreement - ba, 6) AS agreement_gain, round(modularity - bm, 6) AS modularity_gain, band_rank, best_of_evaluation, best FROM r")
def cross_rollup(spark: SparkSession, d: str) -> DataFrame:
    scored = _scored(spark, d)
    least = F.broadcast(scored.groupBy("evaluation").agg(F.min("name").alias("_least")))
    named = scored.join(least, "evaluation").withColumn("name", F.when(F.col("name") == F.col("_least"), "baseline").otherwise(F.lpad(F.col("name").cast("string"), 9, "0"))).drop("_least")
    found = ranking.cross_rollup(named, "baseline")
    return found.select("evaluation", "band", F.col("name").cast("long").cast("string").alias("name"), *(F.round(c, 6).alias(c) for c in ("silhouette_gain", "agreement_gain", "modularity_gain")), "band_rank", "best_of_evaluation", "best")


@register("q_rank_score", f"WITH r AS (SELECT name, silhouette AS coverage, agreement AS density, modularity AS conductance, ratio AS clustering, name % 13 = 0 AS degenerate FROM ({_RUNS})), s AS (SELECT *, 0.35 * (1 - (row_number() OVER (ORDER BY coverage DESC, name) - 1) / (count(*) OVER () - 1)) + 0.2 * (1 - (row_number() OVER (ORDER BY density DESC, name) - 1) / (count(*) OVER () - 1)) + 0.3 * (1 - (row_number() OVER (ORDER BY conductance, name) - 1) / (count(*) OVER () - 1)) + 0.15 * (1 - (row_number() OVER (ORDER BY clustering DESC, name) - 1) / (count(*) OVER () - 1)) - degenerate::int AS score FROM r) SELECT name, round(score, 6) AS score, row_number() OVER (ORDER BY degenerate, round(score, 9) DESC, conductance, coverage DESC, density DESC, clustering DESC, name) AS rank FROM s")
def rank_score(spark: SparkSession, d: str) -> DataFrame:
    runs = _runs(spark, d).select("name", F.col("silhouette").alias("coverage"), F.col("agreement").alias("density"), F.col("modularity").alias("conductance"), F.col("ratio").alias("clustering"), (F.col("name") % 13 == 0).alias("degenerate"))
    return ranking.rank_score(runs, "name", "degenerate").select("name", F.round("score", 6).alias("score"), "rank")


_SWEEP = f"SELECT name AS resolution, labels AS communities, ratio AS modularity FROM ({_RUNS})"


@register("q_elbow", f"WITH s AS ({_SWEEP}), g AS (SELECT *, row_number() OVER w AS place, communities - lag(communities) OVER w AS step, modularity - lag(modularity) OVER w AS rise FROM s WINDOW w AS (ORDER BY communities, resolution)), h AS (SELECT *, CASE WHEN step > 0 THEN rise / step WHEN step IS NOT NULL THEN 0 END AS gain FROM g) SELECT resolution, communities, modularity FROM h WHERE place = coalesce((SELECT min(place) FROM h WHERE gain < (SELECT median(gain) FROM h)), (SELECT max(place) FROM h))")
def elbow(spark: SparkSession, d: str) -> DataFrame:
    return ranking.elbow(_runs(spark, d).select(F.col("name").alias("resolution"), F.col("labels").alias("communities"), F.col("ratio").alias("modularity")))


@register("q_noise_plateau", f"WITH s AS (SELECT name AS size, silhouette * 10 AS noise FROM ({_RUNS})), n AS (SELECT *, lead(noise) OVER (ORDER BY size) AS next FROM s) SELECT coalesce(min(size) FILTER (WHERE noise <= 0.49 AND abs(noise - next) < 0.01), arg_min(size, noise)) AS size FROM n")
def noise_plateau(spark: SparkSession, d: str) -> DataFrame:
    return ranking.noise_plateau(_runs(spark, d).select(F.col("name").alias("size"), (F.col("silhouette") * 10).alias("noise")), 0.49, 0.01)


#: Quantised vectors and unit query vectors.
_QUANTISED = "m AS (SELECT max(list_max(list_transform(embedding, lambda x: abs(x::double)))) AS m FROM embeddings), c AS (SELECT vec_id AS id, label AS cluster, list_transform(embedding, lambda x: greatest(-127, least(127, round_even(x::double * 127.0 / m, 0)::int))) AS q FROM embeddings, m), a AS (SELECT vec_id AS query_id, list_transform(embedding, lambda x: x::double / sqrt(list_dot_product(embedding::double[], embedding::double[]))) AS v FROM embeddings WHERE vec_id % 100 = 7)"


def _quantised(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, float]:
    rows = table(spark, d, "embeddings")
    largest = rows.agg(F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))).first()[0]
    asked = rows.where("vec_id % 100 = 7").select(F.col("vec_id").alias("query_id"), v.unit(F.col("embedding")).alias("vector"))
    return rows.select(F.col("vec_id").alias("id"), F.col("label").alias("cluster"), v.quantise(F.col("embedding"), F.lit(largest)).alias("q")), asked, largest


@register("q_semantic_search", f"WITH {_QUANTISED}, s AS (SELECT query_id, id, greatest(-1, least(1, list_dot_product(v, q::double[]) * m / 127)) AS s FROM a, c, m) SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, id) AS rank, id, round(s, 6) AS cosine FROM s QUALIFY rank <= 50")
def semantic_search(spark: SparkSession, d: str) -> DataFrame:
    rows, asked, largest = _quantised(spark, d)
    return semantic.search_all(asked, rows, largest).withColumn("cosine", F.round("cosine", 6))


@register("q_semantic_facade", f"WITH {_QUANTISED}, s AS (SELECT id, greatest(-1, least(1, list_dot_product(v, q::double[]) * m / 127)) AS s FROM a, c, m WHERE query_id = 7) SELECT row_number() OVER (ORDER BY round(s, 9) DESC, id) AS rank, id, round(s, 6) AS cosine FROM s QUALIFY rank <= 50")
def semantic_facade(spark: SparkSession, d: str) -> DataFrame:
    rows, asked, largest = _quantised(spark, d)
    encode = lambda text: asked.where(f"query_id = {len(text)}").first()["vector"]
    return semantic.facade("seven 7", encode, rows, largest).withColumn("cosine", F.round("cosine", 6))


@register("q_short_query", "SELECT 0 AS rank, vec_id AS id, 0.0::double AS cosine FROM embeddings WHERE false")
def short_query(spark: SparkSession, d: str) -> DataFrame:
    rows, _, largest = _quantised(spark, d)
    return semantic.facade("ab", lambda text: [], rows, largest)


def _routed_sql(horizon: float, budget: int) -> str:
    return f"""WITH {_QUANTISED}, x AS (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
cm AS (SELECT label, list(x ORDER BY pos) AS cv FROM (SELECT label, pos, avg(x) AS x FROM x GROUP BY ALL) GROUP BY label),
o AS (SELECT query_id, label AS cluster, v, row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(v, cv), 9) DESC, label) AS visit FROM a, cm),
s AS (SELECT query_id, o.cluster, visit, id, greatest(-1, least(1, list_dot_product(v, q::double[]) * m / 127)) AS s FROM o JOIN c USING (cluster), m WHERE visit <= {budget}),
h AS (SELECT *, row_number() OVER (PARTITION BY query_id, cluster ORDER BY round(s, 9) DESC, id) AS place FROM s QUALIFY place <= 5),
st AS (SELECT query_id, coalesce(min(visit) FILTER (WHERE 1 - best > {horizon}), max(visit)) AS stop FROM (SELECT query_id, visit, max(s) AS best FROM h GROUP BY ALL) GROUP BY query_id),
w AS (SELECT h.* FROM h JOIN st USING (query_id) WHERE visit <= stop), {_NEAR},
nm AS (SELECT query_id, neighbour AS id, distance, row_number() OVER (PARTITION BY query_id, neighbour ORDER BY visit, place, rank) AS r, visit, place, rank AS nth FROM w JOIN k ON k.id = w.id),
rc AS (SELECT nm.*, c.cluster, c.q FROM nm JOIN c USING (id) WHERE r = 1 AND (query_id, id) NOT IN (SELECT (query_id, id) FROM w)),
vs AS (SELECT query_id, cluster FROM w GROUP BY ALL),
fr AS (SELECT query_id, cluster, row_number() OVER (PARTITION BY query_id ORDER BY min((visit, place, nth)), cluster) AS nth FROM rc WHERE (query_id, cluster) NOT IN (SELECT (query_id, cluster) FROM vs) GROUP BY query_id, cluster),
cl AS (SELECT query_id, cluster FROM fr JOIN (SELECT query_id, count(*) AS spent FROM vs GROUP BY query_id) USING (query_id) WHERE spent + nth > {budget}),
ev AS (SELECT query_id, id, s, 'cosine' AS source FROM w UNION ALL SELECT query_id, id, CASE WHEN cl.cluster IS NOT NULL THEN 1 - distance ELSE greatest(-1, least(1, list_dot_product(v, q::double[]) * m / 127)) END, CASE WHEN cl.cluster IS NOT NULL THEN 'knn-distance' ELSE 'cosine' END FROM rc JOIN a USING (query_id) LEFT JOIN cl USING (query_id, cluster), m)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, id) AS rank, id, round(s, 6) AS cosine, source FROM ev QUALIFY rank <= 20"""


def _routed(spark: SparkSession, d: str, horizon: float, budget: int) -> DataFrame:
    rows, asked, largest = _quantised(spark, d)
    centres = vector_ops.centroids(table(spark, d, "embeddings"), "label", "embedding").withColumnRenamed("label", "cluster")
    return semantic.routed(asked, rows, centres, _near(spark, d), largest, k=20, seeds=5, horizon=horizon, budget=budget).withColumn("cosine", F.round("cosine", 6))


@register("q_routed_search", _routed_sql(0.8, 10))
def routed_search(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d, 0.8, 10)


@register("q_routed_horizon", _routed_sql(0.15, 4))
def routed_horizon(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d, 0.15, 4)
