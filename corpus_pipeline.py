"""From raw documents to training sequences: toxicity, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage works on all that its predecessor kept. The first four return the columns of documents, whatever their names,
and the rows that they leave alone as they are. Empty tables give empty tables. A stage begins with a collection of the
executors' garbage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.lsa_decontam import contaminated
from quillspark.llm.near_dedup import link_documents
from quillspark.llm.packing import pack
from quillspark.llm.store import Scratch, free_name, if_small, passing, release
from quillspark.llm.substring_dedup import repeated_passages, without_passages
from quillspark.llm.toxicity import score_toxicity

#: The stages decide by learned scores, minhashes and latent vectors, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that names a row's doc_id and text, and what it is called."""
    name = free_name(docs, "_q_uid")
    return docs.withColumn(name, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))), name


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs but for the rows named in gone (uid)."""
    named, name = _named(docs)
    names = if_small(Scratch(docs.sparkSession, "gone").save(gone.select(F.col("uid").alias(name)).distinct()))
    return named.join(names, name, "left_anti").select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go, every row that repeats one of them too. Null and empty texts stay. Without
    labels the lexicon decides, so documents without an insult stay."""
    release(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return _without(docs, score_toxicity(docs, labels, held_out).where("predicted = 1"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group at a similarity of 0.8 over five-word shingles the row with the least doc_id stays, null after all others;
    of rows with the same doc_id that with the least hash of its text, and of rows that repeat both any one. Rows without
    a word are in no group and stay, all of them."""
    release(spark)
    linked = Scratch(spark, "linked").save(link_documents(docs, words=5, percent=80))
    release(spark)
    grouped = linked.where(F.col("group").isNotNull())
    first = grouped.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid")).alias("first"))
    stay = first.select(F.col("first.uid").alias("uid")).union(linked.where(F.col("group").isNull()).select("uid").distinct())
    named, name = _named(docs)
    stay = Scratch(spark, "stay").save(stay.select(F.col("uid").alias(name)))
    left = named.join(if_small(stay), name, "left_semi")
    again = Scratch(spark, "again").save(grouped.groupBy(F.col("uid").alias(name)).count().where("count > 1").select(name))
    if again.isEmpty():
        return left.select(docs.columns)
    single = left.join(if_small(again), name, "left_anti")
    return single.union(left.join(if_small(again), name, "left_semi").dropDuplicates([name])).select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has are cut, n_chars follows; a document with nothing left goes.
    Rows with a null doc_id or text are left alone; rows that repeat doc_id and text are one document and are cut alike."""
    release(spark)
    return without_passages(docs, repeated_passages(docs))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or a paraphrase of one go, null doc_ids and repeated rows alike. Null and empty texts
    stay, and null items ask for nothing."""
    release(spark)
    return _without(docs, contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens; a null or empty text is one token, and every row is packed, repeated ones too. Workers keep no cache that later stages would have to make room for."""
    release(spark)
    return pack(docs, str(public_tokenizers.path("word_bpe_49k.json")), cache_words=100_000, reuse=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store = Scratch(spark, "pipeline")
    before = None
    for _, stage in STAGES:
        with passing():
            after = store.save(stage(spark, docs, sf_dir))
        store.drop(before)
        docs = before = after
    return docs
