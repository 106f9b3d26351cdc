"""Facets: values inside a facet are alternatives, facets are conjunctive, and each is counted without its own filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def passes(facets: dict[str, Column], chosen: dict[str, list[str]], apart: str | None = None) -> Column:
    """facets: arrays of values by name. Facets without chosen values, and the facet ``apart``, say nothing."""
    tests = [F.coalesce(F.arrays_overlap(facets[k], F.array(*map(F.lit, v))), F.lit(False)) for k, v in chosen.items() if v and k != apart]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def counts(rows: DataFrame, facets: dict[str, Column], chosen: dict[str, list[str]]) -> DataFrame:
    """(facet, value, n) under every active filter but the facet's own, in one pass over the rows."""
    named = lambda k: lambda x: F.struct(F.lit(k).alias("facet"), x.alias("value"))
    parts = [F.when(passes(facets, chosen, k), F.transform(F.array_distinct(v), named(k))) for k, v in facets.items()]
    empty = F.array().cast("array<struct<facet:string,value:string>>")
    every = F.flatten(F.array(*(F.coalesce(p, empty) for p in parts)))
    found = rows.select(F.explode(every).alias("f")).select("f.facet", "f.value").where("value is not null")
    return found.groupBy("facet", "value").agg(F.count("*").alias("n"))


def options(rows: DataFrame, facets: dict[str, Column]) -> DataFrame:
    """All values of every facet."""
    return counts(rows, facets, {}).select("facet", "value")
