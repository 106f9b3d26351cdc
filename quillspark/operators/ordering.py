"""Orders, pages, slots and differences of lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import fold
from quillspark.operators.relational import dense_ids, first_by_key


def page(rows: DataFrame, order: list[Column | str], number: int, size: int = 60) -> DataFrame:
    """Page ``number`` (from 0) of an ordered list; only the rows up to its end are kept by any task."""
    return rows.orderBy(*order).offset(number * size).limit(size)


def merge_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """(source, id, first, second, place) of sources (id, first, second): both keys descending, missing keys last,
    then the source's name and the id. Places count from 0 and are numbered range by range."""
    named = [d.select(F.lit(k).alias("source"), F.col("id").cast("long").alias("id"), F.col("first").cast("double").alias("first"), F.col("second").cast("double").alias("second")) for k, d in sources.items()]
    every = reduce(DataFrame.union, named)
    low = lambda c: F.coalesce(-F.col(c), F.lit(float("inf")))
    keyed = every.withColumn("_a", low("first")).withColumn("_b", low("second"))
    return dense_ids(keyed, ["_a", "_b", "source", "id"], "place").drop("_a", "_b")


def ordered_distinct(rows: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """The first row of every key, in order."""
    return first_by_key(rows, [key], order).orderBy(*order)


def difference(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, state): added or removed keys of two runs; equal sets give no rows."""
    a = before.select(key).distinct().withColumn("_a", F.lit(1))
    b = after.select(key).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, key, "full_outer").where("_a is null or _b is null")
    return both.select(key, F.when(F.col("_a").isNull(), "added").otherwise("removed").alias("state"))


def slots(rows: DataFrame, start: str, name: str = "slot") -> DataFrame:
    """Rows with the dense rank, from 0, of their start; the distinct starts are numbered apart. Null starts get null."""
    known = dense_ids(rows.select(start).where(F.col(start).isNotNull()).distinct(), [start], name)
    return rows.join(known, start, "left")


def by_size(rows: DataFrame, label: str, name: str = "renamed") -> DataFrame:
    """(label, n, renamed): labels numbered from 0 by size, larger first, ties by the label. One row a label."""
    sizes = rows.groupBy(label).agg(F.count("*").alias("n"))
    return sizes.withColumn(name, (F.row_number().over(Window.partitionBy().orderBy(F.desc("n"), label)) - 1).cast("long"))


def letter(text: Column) -> Column:
    """The index letter: A-Z of the first character but spaces without its accent, else Other."""
    first = F.upper(F.substring(fold(F.regexp_replace(text, r"^\p{Zs}+", "")), 1, 1))
    return F.when(first.rlike("^[A-Z]$"), first).otherwise("Other")  # some signs have two capitals, as the sharp s


def invariants(rows: DataFrame, key: str, parent: DataFrame, parent_key: str, reference: str) -> DataFrame:
    """(n, repeated_keys, missing_keys, dangling) of a table and of its references to a parent table."""
    known = parent.select(F.col(parent_key).alias(reference)).where(F.col(reference).isNotNull()).distinct().withColumn("_there", F.lit(1))
    joined = rows.join(known, reference, "left").groupBy(key).agg(F.count("*").alias("c"), F.count_if(F.col(reference).isNotNull() & F.col("_there").isNull()).alias("d"))
    return joined.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if((F.col("c") > 1) & F.col(key).isNotNull()).alias("repeated_keys"), F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("c"))), F.lit(0)).alias("missing_keys"), F.coalesce(F.sum("d"), F.lit(0)).alias("dangling"))


def merge_references(uses: DataFrame, key: str, order: Column, fields: list[str], raw: str, keep: int = 3) -> DataFrame:
    """(key, uses, fields..., raw): counts, each field's first value that is there, and the first distinct raw texts.

    Raw texts are made distinct, each with its first place, before any list is gathered, and a key's list is cut in
    the window, so a key with very many uses stays small.
    """
    firsts = uses.groupBy(key).agg(F.count("*").alias("uses"), *(F.min_by(F.col(f), F.when(F.col(f).isNotNull(), order)).alias(f) for f in fields))
    texts = uses.where(F.col(raw).isNotNull()).groupBy(key, raw).agg(F.min(order).alias("_at"))
    texts = texts.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_at", raw))).where(F.col("_n") <= keep)
    lists = texts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", raw))), lambda s: s[raw]).alias(raw))
    return firsts.join(lists, key, "left").withColumn(raw, F.coalesce(raw, F.array().cast("array<string>")))
