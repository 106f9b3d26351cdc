"""Readers and writers. Paths go to Spark's own readers, so any file system that Spark knows will do."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STORED: list[tuple[SparkSession, str]] = []

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(spark: SparkSession, folder: str, names: list[str] = NAMES) -> None:
    """All tables of a folder as temporary views."""
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headed CSV with quoted line breaks; the schema is given, so nothing is read to infer it."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Nested JSON records, one or more files of arrays or objects."""
    return spark.read.schema(schema).json(path, multiLine=True)


def write_clustered(rows: DataFrame, path: str, cluster: str, key: str) -> None:
    """Parquet sorted by (cluster, key), so that statistics prune reads of one cluster to a few row groups."""
    rows.repartitionByRange(cluster, key).sortWithinPartitions(cluster, key).write.option("compression", "zstd").option("parquet.block.size", 8 << 20).parquet(path)


def read_cluster(spark: SparkSession, path: str, cluster: str, value: int) -> DataFrame:
    return spark.read.parquet(path).where(F.col(cluster) == value)


def write_shards(rows: DataFrame, path: str) -> None:
    """Gzip JSON lines."""
    rows.write.json(path, compression="gzip")


def write_partitioned(rows: DataFrame, path: str, by: list[str]) -> None:
    rows.write.partitionBy(*by).option("compression", "zstd").parquet(path)


def unread(ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Ids that a resumed run still has to fetch."""
    return ids.join(done.select(key), key, "left_anti")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a local master without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quillspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(rows: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Writes Parquet to the shared folder, in folders of the columns ``by``, and reads it again; kept until the driver ends."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = rows.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    _STORED.append((spark, path))
    out = spark.read.schema(rows.schema).parquet(path)
    out._quillspark_path = path
    return out


def discard(rows: DataFrame) -> None:
    """Deletes a table that ``stored`` wrote and nothing reads any more."""
    spark = rows.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(rows._quillspark_path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for spark, path in _STORED:
        with contextlib.suppress(Exception):  # the session may have ended already
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
