"""Rows from a service that answers for batches of ids: growing timeouts, and batches that fail are halved until the bad ids stand alone."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Page = Callable[[int], tuple[list[int], bool]]
Answer = Callable[[list[Any], float], list[dict[str, Any]]]


def ask(ids: list[Any], answer: Answer, timeouts: tuple[float, ...]) -> tuple[list[dict[str, Any]], list[tuple[Any, str]]]:
    """The rows for ids, and the ids that fail alone with the last error. A batch is tried once with each timeout."""
    error = ""
    for limit in timeouts:
        try:
            return answer(ids, limit), []
        except Exception as e:  # noqa: BLE001  any failure of the service counts
            error = f"{type(e).__name__}: {e}"
    if len(ids) == 1:
        return [], [(ids[0], error)]
    half = len(ids) // 2
    parts = [ask(part, answer, timeouts) for part in (ids[:half], ids[half:])]
    return parts[0][0] + parts[1][0], parts[0][1] + parts[1][1]


def fetch(ids: DataFrame, key: str, columns: str, answer: Answer, *, batch: int = 100, timeouts: tuple[float, ...] = (30.0, 60.0, 120.0)) -> DataFrame:
    """(key, columns..., error): what the service says of every id that isn't null, each once. An id without an answer has null
    columns and no error. Ids are dealt over tasks; a lost task asks again for its own."""
    kind = ids.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            wanted = frame[key].tolist()
            for at in range(0, len(wanted), batch):
                part = wanted[at : at + batch]
                rows, failed = ask(part, answer, timeouts)
                said, wrong = {r[key]: r for r in rows}, dict(failed)
                yield pd.DataFrame({key: part} | {n: pd.Series([said.get(i, {}).get(n) for i in part], dtype=object) for n in names} | {"error": pd.Series([wrong.get(i) for i in part], dtype=object)})

    return ids.select(key).where(F.col(key).isNotNull()).distinct().mapInPandas(run, f"{key} {kind}, {columns}, error string")


def scan(spark: SparkSession, page: Page, key: str, start: int = -1) -> DataFrame:
    """All ids of a service that gives them in pages: ``page`` takes the last id seen and gives the next ones, in order, and whether
    there are more. What the service itself filters never travels. Pages follow each other, so the driver asks, and keeps ids only."""
    ids, more = [], True
    while more:
        found, more = page(ids[-1] if ids else start)
        if not found:
            break
        ids += found
    return spark.createDataFrame([(i,) for i in ids], f"{key} long")
