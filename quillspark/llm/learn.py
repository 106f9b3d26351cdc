"""Bounded samples, taken by a hash, that no single task has to choose from all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(labels: DataFrame, target: str, held_out: Column, rows: int) -> DataFrame:
    """(doc_id, y) of at most ``rows`` documents that are not held out, taken by a hash of doc_id.

    Labels other than 0 and 1 and null doc_ids are ignored; a doc_id with several labels takes the largest. The
    result is small enough to broadcast: its bound is ``rows``.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y"))
    ids = ids.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~F.coalesce(held_out, F.lit(False)))
    one = ids.groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("o", F.xxhash64("doc_id"))
    return by_hash(one, "o", rows, one.count()).select("doc_id", "y")


def by_hash(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """At most ``rows`` rows of distinct ``key``, a 64-bit hash: the least of those in a share of the hashes that has 1.5
    times ``rows`` of the ``total`` rows in the mean, so that no task reads many more than it keeps. Repeated keys count once."""
    share = min(1.0, (1.5 * rows + 50) / max(total, 1))
    some = df.where(F.pmod(F.col(key), F.lit(1 << 40)) < int(share * (1 << 40)))
    return some.dropDuplicates([key]).orderBy(key).limit(rows)
