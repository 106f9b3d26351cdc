"""Session settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC keeps timestamps comparable; LAST_WIN is the duplicate-key rule of the answer maps.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(master: str = "local[*]", shuffle_partitions: int = 8, memory: str = "8g", **more: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    conf = SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": memory, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"} | more
    return SparkSession.builder.master(master).config(map=conf).getOrCreate()
