"""Texts on their way to vectors and vectors on their way to other spaces: components, chunks, layers, ridge projections."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.markup import html_to_markdown
from quillspark.operators.vector_ops import raw_matrix

#: Components that are answers to a question of that name.
SECTIONS = ("introduction", "methods", "results", "conclusion")


def _spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def section(responses: Column, name: str) -> Column:
    """The first answer to a question, as Markdown on one line; empty without one. responses: (question_name, value)."""
    mine = F.get(F.filter(responses, lambda r: F.lower(F.trim(r["question_name"])) == name), F.lit(0))
    return _spaces(html_to_markdown(F.coalesce(mine["value"], F.lit(""))))


def claims(found: Column, implicit: bool = False) -> Column:
    """Claims (claim, claim_type) as paragraphs, all of them or the implicit ones."""
    kept = F.filter(found, lambda c: (c["claim_type"] == "IMPLICIT") if implicit else F.lit(True))
    return F.array_join(F.filter(F.transform(kept, lambda c: F.trim(F.coalesce(c["claim"], F.lit("")))), lambda t: t != ""), "\n\n")


def component(name: str) -> Column:
    """The text of a component of a record (title, responses, claims); empty if it has none."""
    if name == "title":
        return _spaces(F.col("title"))
    if name in SECTIONS:
        return section(F.col("responses"), name)
    if name in ("claims", "inference_claims"):
        return F.coalesce(claims(F.col("claims"), name != "claims"), F.lit(""))
    raise ValueError(f"no component {name}")


def components(records: DataFrame, key: str, names: list[str]) -> DataFrame:
    """(key, component, text) of the components that records have."""
    wide = records.select(key, *(component(n).alias(n) for n in names))
    return wide.unpivot(key, names, "component", "text").where("text <> ''")


def chunks(words: Column, window: int, overlap: int = 0) -> Column:
    """Windows of an array of words that begin every window - overlap words, up to the one that holds the last word."""
    step = window - overlap
    last = F.ceil(F.greatest(F.size(words) - window, F.lit(0)) / step).cast("int") * step
    return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(0), last, F.lit(step)), lambda s: F.slice(words, s + 1, F.lit(window)))).otherwise(F.array().cast("array<array<string>>"))


def pooled(docs: DataFrame, key: str, words: str, encode: Callable[[Column], Column], window: int, overlap: int = 0) -> DataFrame:
    """(key, vector, chunks): the mean of a text's chunks' vectors, as ``encode`` gives them for an array of words. Chunks travel
    apart, so a very long text is spread over tasks; texts without words have no row."""
    each = docs.select(key, F.posexplode(chunks(F.col(words), window, overlap)).alias("chunk", "w")).select(key, "chunk", encode(F.col("w")).alias("v"))
    flat = each.select(key, F.posexplode("v").alias("pos", "x")).groupBy(key, "pos").agg(F.avg("x").alias("x"), F.count("*").alias("n"))
    return flat.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("vector"), F.max("n").alias("chunks"))


def forward(rows: DataFrame, key: str, vector: str, layers: list[tuple[np.ndarray, np.ndarray, str]]) -> DataFrame:
    """(id, vector): rows through layers (weights: inputs x outputs, bias, relu, tanh, unit or linear). The model is broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(layers)
    act = {"relu": lambda x: np.maximum(x, 0), "tanh": np.tanh, "linear": lambda x: x, "unit": lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = raw_matrix(batch.column("v"))
                for w, b, kind in shared.value:
                    x = act[kind](x @ w + b)
                cuts = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
                yield pa.record_batch([batch.column("id"), pa.ListArray.from_arrays(cuts, pa.array(np.ascontiguousarray(x, np.float64).ravel()))], names=["id", "vector"])

    return rows.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).mapInArrow(run, "id long, vector array<double>")


def ridge(rows: DataFrame, x: str, y: str, penalty: float) -> np.ndarray:
    """Weights (inputs x outputs) of a linear map from x to y with a penalty on their squares, by the normal equations: tasks add up
    products of their rows, a matrix each, and the small system is solved on the driver."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                a, b = raw_matrix(batch.column("x")), raw_matrix(batch.column("y"))
                got = a.T @ np.hstack((a, b))
                total = got if total is None else total + got
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.record_batch([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())], names=["i", "j", "s"])

    sums = rows.select(F.col(x).alias("x"), F.col(y).alias("y")).mapInArrow(products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    n = int(sums["i"].max()) + 1
    grid = np.zeros((n, int(sums["j"].max()) + 1))
    grid[sums["i"], sums["j"]] = sums["s"]
    return np.linalg.solve(grid[:, :n] + penalty * np.eye(n), grid[:, n:])
