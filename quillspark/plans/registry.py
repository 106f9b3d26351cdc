"""What can be run by name: queries with their SQL, and kinds of analysis, formats and orders that users add."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Names a query, and DuckDB SQL that says the same if there is any."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


@dataclass
class Registry:
    """Functions by name. A name is given once; an unknown one is an error that lists the known ones."""

    what: str
    found: dict[str, Callable[..., Any]] = field(default_factory=dict)

    def add(self, name: str, f: Callable[..., Any]) -> None:
        if name in self.found:
            raise ValueError(f"{self.what} {name} is there already")
        self.found[name] = f

    def run(self, name: str, *args: Any, **options: Any) -> Any:
        if name not in self.found:
            raise KeyError(f"no {self.what} {name}; known: {', '.join(sorted(self.found))}")
        return self.found[name](*args, **options)


#: An analysis takes a table and options and gives a table; a format takes a table and a path.
ANALYSES, FORMATS = Registry("analysis"), Registry("format")
FORMATS.add("parquet", lambda rows, path: rows.write.option("compression", "zstd").parquet(path))
FORMATS.add("json", lambda rows, path: rows.write.json(path, compression="gzip"))
FORMATS.add("csv", lambda rows, path: rows.write.csv(path, header=True))


@dataclass
class Corpus:
    """A corpus that lists are made of: its kind, its rows (id and what a list shows) and the two columns it is sorted by."""

    kind: str
    rows: DataFrame
    keys: tuple[str, str]

    def found(self, ids: DataFrame) -> DataFrame:
        """(id, first, second) of those ids that the corpus has."""
        return ids.join(self.rows.selectExpr("id", f"{self.keys[0]} AS first", f"{self.keys[1]} AS second"), "id")


def cached(rows: DataFrame, cache: DataFrame, key: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(key, value) of all rows: from the cache where it has the key, else computed for the rows that it doesn't have."""
    known = rows.select(key).distinct().join(cache.select(key, "value"), key)
    fresh = compute(rows.join(cache.select(key), key, "left_anti")).select(key, "value")
    return known.union(fresh)


def structured(prompts: DataFrame, answer: Callable[[Iterable[str]], Iterable[str]], column: str = "prompt") -> DataFrame:
    """Prompts with the answers that a user's function gives for batches of them; a model, its retries and tiers are the user's."""
    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        return pd.Series(list(answer(batch.tolist())), dtype=object)

    return prompts.withColumn("answer", run(column))
