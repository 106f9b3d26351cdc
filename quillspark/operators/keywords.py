"""Keywords of groups of texts: n-grams, TF-IDF by group, group summaries and topic tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import ngrams
from quillspark.functions.vectors import dot
from quillspark.operators.evaluation import ctfidf
from quillspark.operators.vector_ops import centroids
from quillspark.sources.tables import stored

#: Words that are no phrases of a topic.
STOP_WORDS = (
    "the a an of in on for to and or with by as is are was were be been being this that these those we our their its it they them from at but not no such than "
    "between into via using use used show shown showed shows found find finds study studies studied result results method methods analysis analyses data based "
    "however thus also may can could would should will have has had i ii iii iv v vi vii p n rs ms vs etc"
).split()


def phrase_words(text: Column) -> Column:
    """Runs of letters and hyphens of two characters or more that begin with a letter, in lower case, without stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([a-z][a-z\-]+)"), 1)
    return F.filter(words, lambda w: ~w.isin(STOP_WORDS))


def phrases(text: Column, most: int = 3) -> Column:
    """All phrases of one to ``most`` words after stop words are gone."""
    each = lambda words: F.flatten(F.array(*(ngrams(words, n) for n in range(1, most + 1))))
    return F.get(F.transform(F.array(phrase_words(text)), each), F.lit(0))


def phrase_counts(docs: DataFrame, cluster: str, key: str, text: str) -> DataFrame:
    """(cluster, term, n): how many documents of a cluster have a phrase. Texts are dealt out first, as a file of few row groups
    is read by as few tasks."""
    dealt = docs.select(cluster, key, text).repartition(4 * docs.sparkSession.sparkContext.defaultParallelism, key)
    each = dealt.select(cluster, key, F.explode(F.array_distinct(phrases(F.col(text)))).alias("term"))
    return each.groupBy(F.col(cluster).alias("cluster"), "term").agg(F.count("*").alias("n"))


def topics(docs: DataFrame, cluster: str, key: str, text: str, most: int = 10) -> DataFrame:
    """(cluster, place, term, score): each cluster's best phrases by class-based TF-IDF, ties by the phrase."""
    scored = ctfidf(phrase_counts(docs, cluster, key, text))
    order = Window.partitionBy("cluster").orderBy(F.desc(F.round("score", 9)), "term")
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).select("cluster", "place", "term", "score")


def only_candidates(rows: DataFrame, words: str, candidates: str, strict: bool = False) -> DataFrame:
    """Rows whose words are candidates, each once, in order, and those dropped; none left of some is an error, as is any
    dropped one with strict."""
    kept, gone = F.array_distinct(F.filter(words, lambda w: F.array_contains(F.col(candidates), w))), F.filter(words, lambda w: ~F.array_contains(F.col(candidates), w))
    bad = (F.size(gone) > 0) if strict else ((F.size(kept) == 0) & (F.size(words) > 0))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("words that are no candidates: "), F.array_join(F.slice(gone, 1, 5), ", ")))).otherwise(kept)
    return rows.withColumn("kept", checked.cast("array<string>")).withColumn("dropped", gone)


def tfidf_terms(docs: DataFrame, group: str, key: str, words: str, features: int = 5000) -> DataFrame:
    """(group, term, score): for every group its documents' TF-IDF rows added up.

    words is an array of tokens without stop words. Terms are words and pairs of neighbours; each group keeps its ``features``
    most frequent ones, ties by the term. A document's row is count x (ln((1 + documents) / (1 + documents with the term)) + 1),
    scaled to length 1, with the numbers of its own group.
    """
    terms = F.explode(F.concat(ngrams(F.col(words), 1), ngrams(F.col(words), 2)))
    tf = stored(docs.select(F.col(group).alias("g"), F.col(key).alias("k"), terms.alias("term")).groupBy("g", "k", "term").agg(F.count("*").alias("tf")), "terms")
    about = tf.groupBy("g", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("n"))
    place = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("n"), "term"))
    kept = about.withColumn("_n", place).where(F.col("_n") <= features).select("g", "term", "df")
    sizes = tf.select("g", "k").distinct().groupBy("g").agg(F.count("*").alias("docs"))
    idf = kept.join(F.broadcast(sizes), "g").select("g", "term", (F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1).alias("idf"))
    rows = tf.join(idf, ["g", "term"]).withColumn("x", F.col("tf") * F.col("idf"))
    norms = rows.groupBy("g", "k").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return rows.join(norms, ["g", "k"]).groupBy(F.col("g").alias(group), "term").agg(F.sum(F.col("x") / F.col("norm")).alias("score"))


def group_keywords(docs: DataFrame, group: str, key: str, words: str, most: int = 8, features: int = 5000) -> DataFrame:
    """(group, place, term, score): each group's best terms, ties by the term."""
    scored = tfidf_terms(docs, group, key, words, features).withColumn("score", F.round("score", 9))
    return scored.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), "term"))).where(F.col("place") <= most)


def top_tokens(rows: DataFrame, segment: str, words: str, most: int = 5) -> DataFrame:
    """(segment, place, token, n): the tokens that most titles of a segment have in all, ties by the token."""
    n = rows.select(segment, F.explode(words).alias("token")).groupBy(segment, "token").agg(F.count("*").alias("n"))
    return n.withColumn("place", F.row_number().over(Window.partitionBy(segment).orderBy(F.desc("n"), "token"))).where(F.col("place") <= most)


def segment_phrases(rows: DataFrame, segment: str, words: str, most: int = 5, features: int = 8000, pairs: bool = True) -> DataFrame:
    """(segment, place, term, score): the best words, and pairs of neighbours, of segments, each of which counts as one document of the
    same corpus. A segment's words are gathered, so segments are parts of a list, not of a corpus."""
    joined = rows.groupBy(segment).agg(F.flatten(F.collect_list(words)).alias("w")).withColumn("g", F.lit(0))
    terms = F.explode(F.concat(ngrams(F.col("w"), 1), ngrams(F.col("w"), 2)) if pairs else F.col("w"))
    tf = stored(joined.select("g", segment, terms.alias("term")).groupBy(segment, "term").agg(F.count("*").alias("tf")), "segments")
    about = tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("n")).orderBy(F.desc("n"), "term").limit(features)
    docs = joined.agg(F.count("*").alias("docs"))
    idf = about.crossJoin(F.broadcast(docs)).select("term", (F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1).alias("idf"))
    x = tf.join(idf, "term").withColumn("x", F.col("tf") * F.col("idf"))
    norms = x.groupBy(segment).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    scored = x.join(norms, segment).select(segment, "term", F.round(F.col("x") / F.col("norm"), 9).alias("score"))
    return scored.withColumn("place", F.row_number().over(Window.partitionBy(segment).orderBy(F.desc("score"), "term"))).where(F.col("place") <= most)


def group_summary(rows: DataFrame, group: str, key: str, vector: str, topic: str, most: int = 5) -> DataFrame:
    """(group, size, topics, representatives, similar, similarity): size, topics with their counts, the rows nearest to the
    centroid, and the group with the most similar centroid. Groups are few; a topic's counts come before any list."""
    centres = centroids(rows, group, vector)
    counts = rows.groupBy(group, F.coalesce(topic, F.lit("Unknown")).alias("_t")).agg(F.count("*").alias("_n"))
    about = counts.groupBy(group).agg(F.sum("_n").alias("size"), F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("less"), F.col("_t").alias("topic")))).alias("_c"))
    near = rows.join(F.broadcast(centres), group).select(group, key, F.round(dot(F.col(vector), F.col("centroid")), 9).alias("_s"))
    first = near.withColumn("_p", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_s"), key))).where(F.col("_p") <= most)
    first = first.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", F.col(key).alias("id")))), lambda s: s["id"]).alias("representatives"))
    other = centres.select(F.col(group).alias("similar"), F.col("centroid").alias("_o"))
    pairs = centres.join(F.broadcast(other), F.col(group) != F.col("similar")).select(group, "similar", F.round(dot(F.col("centroid"), F.col("_o")), 9).alias("similarity"))
    best = pairs.groupBy(group).agg(F.max_by("similar", F.struct("similarity", -F.col("similar"))).alias("similar"), F.max("similarity").alias("similarity"))
    out = about.join(first, group).join(best, group, "left")
    return out.select(group, "size", F.transform("_c", lambda s: F.concat(s["topic"], F.lit(":"), -s["less"])).alias("topics"), "representatives", "similar", "similarity")
