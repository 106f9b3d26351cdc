"""Sinks of a corpus and the reads that go with them. All tables are Parquet or JSON in folders that Spark's committer fills, so a
reader never sees half a table and a lost task is written again."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bundles(rows: DataFrame, path: str, by: list[str]) -> None:
    """Vectors or analyses in a folder for each model and component; a bundle that is written again replaces the old one only."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def read_bundle(spark: SparkSession, path: str, **which: str) -> DataFrame:
    """One bundle; the other folders aren't read."""
    rows = spark.read.parquet(path)
    for column, value in which.items():
        rows = rows.where(F.col(column) == value)
    return rows.drop(*which)


def merge_cache(cache: DataFrame, fresh: DataFrame, key: str, path: str) -> None:
    """A cache with fresh entries, of which a key's last one stays: fresh ones come before those that are there."""
    kept = cache.join(fresh.select(key), key, "left_anti")
    fresh.dropDuplicates([key]).unionByName(kept).write.option("compression", "zstd").parquet(path)


def write_packed(rows: DataFrame, key: str, path: str) -> None:
    """Keys and zlib-compressed JSON of their rows, sorted by key, so that a read of one key or of a range touches few row groups."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [None if x is None else zlib.compress(x.encode()) for x in batch.column("value").to_pylist()]
            yield pa.record_batch([batch.column("key"), pa.array(packed, pa.binary())], names=["key", "value"])

    plain = rows.select(F.col(key).cast("long").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))
    plain.mapInArrow(pack, "key long, value binary").repartitionByRange("key").sortWithinPartitions("key").write.parquet(path)


def read_packed(spark: SparkSession, path: str, schema: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """Rows of the keys from low to high, both included."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = [None if x is None else zlib.decompress(x).decode() for x in batch.column("value").to_pylist()]
            yield pa.record_batch([batch.column("key"), pa.array(plain, pa.string())], names=["key", "value"])

    rows = spark.read.parquet(path)
    if low is not None:
        rows = rows.where(F.col("key") >= low)
    if high is not None:
        rows = rows.where(F.col("key") <= high)
    return rows.mapInArrow(unpack, "key long, value string").select(F.from_json("value", schema).alias("r")).select("r.*")


def write_corpus(rows: DataFrame, path: str) -> None:
    """Nested records as they are: arrays and structs stay columns, so reads of a few fields stay cheap."""
    rows.write.option("compression", "zstd").parquet(path)


def write_release(tables: dict[str, DataFrame], path: str, sort: dict[str, list[str]]) -> None:
    """The tables of a backdrop or an overlay, a folder each, sorted where a key is given, so that range reads prune."""
    for name, rows in tables.items():
        keys = sort.get(name)
        (rows.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else rows).write.option("compression", "zstd").parquet(f"{path}/{name}")


def read_range(spark: SparkSession, path: str, name: str, columns: list[str], key: str | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
    """Some columns of one table of a release, of keys from low to high; other columns and row groups aren't read."""
    rows = spark.read.parquet(f"{path}/{name}")
    if key is not None:
        rows = rows.where(F.col(key).between(low, high))
    return rows.select(*columns)


def write_listing(rows: DataFrame, path: str, order: list[str]) -> None:
    """Headed CSV in order, cells quoted where they must be; a listing is for people and so one file."""
    rows.orderBy(*order).coalesce(1).write.csv(path, header=True, quoteAll=False, escape='"')


def read_listing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True)


def read_articles(spark: SparkSession, path: str, schema: str, lists: list[str]) -> DataFrame:
    """Headed CSV of which some columns are JSON lists of strings; blank lists are empty."""
    rows = spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True)
    return rows.withColumns({c: F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>")) for c in lists})


def read_under_heading(spark: SparkSession, path: str, heading: str, columns: int) -> DataFrame:
    """(line, cells): the rows of a CSV file below the first line that begins with ``heading``, wherever that is; ``columns`` cells
    a row, blank lines left out. Meant for small files, which are read whole to know their lines' order."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    first = lines.where(F.col("text").startswith(heading)).agg(F.min("line").alias("_first"))
    body = lines.crossJoin(F.broadcast(first)).where((F.col("line") > F.col("_first")) & (F.trim("text") != ""))
    schema = ", ".join(f"c{i} string" for i in range(columns))
    return body.select("line", F.from_csv("text", schema, {"escape": '"'}).alias("c")).select("line", F.array(*(F.col(f"c.c{i}") for i in range(columns))).alias("cells"))


def content_key(content: str, name: str) -> F.Column:
    """The key under which a file is published: the digest of its bytes and its name."""
    return F.concat(F.sha2(F.col(content).cast("binary"), 256), F.lit("/"), F.col(name))


def manifest(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(name, bytes, sha256) of the files below a folder; files are read by Spark, one a task at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def discover(found: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(input, name, sha256) of a manifest: for every input the one file whose name its pattern matches; none or several are an error."""
    spark = found.sparkSession
    wanted = spark.createDataFrame(list(patterns.items()), "input string, pattern string")
    hits = wanted.join(found, F.expr("name rlike pattern"), "left").groupBy("input").agg(F.count("name").alias("n"), F.first("name").alias("name"), F.first("sha256").alias("sha256"))
    return hits.select("input", F.when(F.col("n") == 1, F.col("name")).otherwise(F.raise_error(F.concat(F.lit("not one file for "), "input")).cast("string")).alias("name"), "sha256")


def public_authors(rows: DataFrame) -> DataFrame:
    """Authors without their addresses: names and submission, affiliations in order. Columns are named, so that nothing new slips through."""
    ordered = F.array_sort("affiliations", lambda a, b: a["affiliation_order"] - b["affiliation_order"])
    return rows.select("id", "first_name", "middle_initial", "last_name", "submission_id", ordered.alias("affiliations"))


def normalised(rows: DataFrame) -> DataFrame:
    """Records with their sessions, one list or none, flattened, and their authors in order."""
    sessions = F.flatten(F.coalesce(F.col("sessions"), F.array().cast("array<array<string>>")))
    authors = F.array_sort("authors", lambda a, b: a["author_order"] - b["author_order"])
    return rows.withColumn("sessions", F.filter(sessions, lambda s: s.isNotNull())).withColumn("authors", F.transform(authors, lambda a: a["id"]))


def pubmed(xml: F.Column) -> F.Column:
    """A struct of a PubMed article's id, title, abstract and year, by paths; what isn't there is null."""
    text = lambda path: F.nullif(F.xpath_string(xml, F.lit(path)), F.lit(""))
    parts = F.xpath(xml, F.lit("//AbstractText/text()"))
    return F.struct(text("//PMID").cast("long").alias("pmid"), text("//ArticleTitle").alias("title"), F.nullif(F.array_join(parts, "\n\n"), F.lit("")).alias("abstract"), text("//PubDate/Year").cast("int").alias("year"))


def fields(schema: DataFrame) -> DataFrame:
    """(field, type, digest) of an introspected schema (type, fields: array of name and kind): a row a field, with a digest of both."""
    flat = schema.select("type", F.explode("fields").alias("f"))
    return flat.select(F.concat_ws(".", "type", "f.name").alias("field"), F.col("f.kind").alias("kind"), F.substring(F.sha2(F.concat_ws("|", "type", "f.name", "f.kind"), 256), 1, 12).alias("digest"))


def consumed(uses: DataFrame) -> DataFrame:
    """(field, modules): every field that a module reads, with the modules that do, in order."""
    return uses.groupBy("field").agg(F.array_sort(F.collect_set("module")).alias("modules"))
