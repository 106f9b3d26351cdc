"""Intermediate tables in the folder that all executors share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading it again, so a lost
executor costs a re-read and never a recomputation of the chain. Tables that are no longer needed are
deleted by the operator that wrote them; what a result still reads stays until the driver ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEPT: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a local master without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quillspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for spark, path in _KEPT:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended already
            return


@contextmanager
def passing() -> Iterator[None]:
    """Tables that operators write inside, results included, are deleted at the end, when what is read from them has been written."""
    known = len(_KEPT)
    try:
        yield
    finally:
        while len(_KEPT) > known:
            delete(*_KEPT.pop())


def free_name(df: DataFrame, name: str) -> str:
    """name, lengthened until no column of df has it; Spark ignores case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bytes of an Arrow batch, which the JVM and Python both hold, and more than once.
BATCH = "8m"


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the session, unless it names a bound of its own. Results don't depend on it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH)


def release(spark: SparkSession) -> None:
    """Executors collect their garbage, so that heap which one stage has filled goes back to the system and the next one's Python
    workers find room. Executors grow their heap up to its bound rather than collect it, and seldom shrink it by themselves. A task
    for each core reaches all executors that are idle; one that isn't reached is as it was."""
    from pyspark.sql import functions as F

    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.reflect(F.lit("java.lang.System"), F.lit("gc"))).collect()


class Scratch:
    """The tables that one run of an operator writes."""

    def __init__(self, spark: SparkSession, name: str):
        bound_batches(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: dict[int, str] = {}
        _KEPT.append((spark, self.root))

    def save(self, df: DataFrame) -> DataFrame:
        """Writes a table and returns it as read again."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._quillspark_scratch = self  # keeps id(out) from being reused while the path is known
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Deletes tables that nothing reads any more."""
        for df in tables:
            if df is not None and (path := self.paths.pop(id(df), None)):
                delete(self.spark, path)

    def finish(self, df: DataFrame) -> DataFrame:
        """Writes the result and deletes every other table."""
        out = self.save(df)
        for key in [k for k in self.paths if k != id(out)]:
            delete(self.spark, self.paths.pop(key))
        return out


#: Rows of 8 to 24 bytes that may be broadcast: about 24 MB at most.
SMALL_ROWS = 1_000_000


def if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Marks a narrow stored table for broadcast if its counted rows are few; else a shuffled join follows."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
