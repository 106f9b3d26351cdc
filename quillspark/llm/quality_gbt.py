"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed once for every whole text, vectorised over a block of texts. Trees grow on the driver from a
bounded sample of labelled rows, with features cut into at most 64 bins, and are flattened into arrays that numpy
walks for all texts and trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm import text as tx
from quillspark.llm.learn import labelled
from quillspark.llm.store import Scratch

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_spread", "longest_word", "upper", "lower", "digit", "space", "newline", "punctuation", "bang", "bar", "symbol", "beyond_ascii", "entropy",
    "distinct_words", "top_word", "distinct_shingles", "distinct_lines", "line_length", "one_letter", "capitalised", "closed_by_mark", "other_sign_share", "control",
)
_LINE = np.ones(256, bool)
_LINE[10] = False


def _set(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER, _LOW, _DIGIT = (_set("".join(map(chr, range(a, b)))) for a, b in ((65, 91), (97, 123), (48, 58)))
_MARK, _SYMBOL = _set(".,;:?!'\"()-"), _set("#$%&*+/<=>@[\\]^_`{}~")


def _spread(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's share of distinct values and share of its commonest value; 1 and 0 for an empty row."""
    distinct, top = np.ones(len(at) - 1), np.zeros(len(at) - 1)
    for r, (a, b) in enumerate(zip(at[:-1], at[1:])):
        if b > a:
            part = np.sort(x[a:b])
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            distinct[r], top[r] = len(cuts) / (b - a), np.diff(cuts, append=b - a).max() / (b - a)
    return distinct, top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text; an empty text has zeros where nothing can be measured."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    seen = np.bincount(row * 256 + data[offsets[0] : offsets[-1]], minlength=n * 256).reshape(n, 256)
    some = np.maximum(size, 1)
    share = lambda member: seen[:, member].sum(1) / some
    p = seen / some[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    starts, lengths, at = tx.runs(data, offsets)
    words = np.diff(at)
    any_word = np.maximum(words, 1)
    total = lambda x: np.diff(np.concatenate(([0.0], np.cumsum(x)))[at])
    mean = total(lengths) / any_word
    spread = np.sqrt(np.maximum(total(lengths.astype(float) ** 2) / any_word - mean**2, 0))
    longest = np.zeros(n)
    if len(starts):
        longest[words > 0] = np.maximum.reduceat(lengths, at[:-1][words > 0])
    h = tx.hashes(data, starts, lengths)
    distinct, top = _spread(h, at)
    distinct3, _ = _spread(*tx.shingles(h, at, 3))
    line_starts, line_lengths, line_at = tx.runs(data, offsets, _LINE)
    lines = np.diff(line_at)
    distinct_lines, _ = _spread(tx.hashes(data, line_starts, line_lengths), line_at)
    first, last = data[starts], data[starts + lengths - 1]
    one = total((lengths == 1).astype(float)) / any_word
    return np.column_stack(
        [
            np.log1p(size), np.log1p(words), mean, spread, np.log1p(longest), share(_UPPER), share(_LOW), share(_DIGIT), share(~tx.WORD), share(~_LINE), share(_MARK), share(_set("!")), share(_set("|")), share(_SYMBOL), seen[:, 128:].sum(1) / some, entropy,
            distinct, top, distinct3, distinct_lines, np.log1p(size / np.maximum(lines, 1)), one, total(_UPPER[first].astype(float)) / any_word, total(_MARK[last].astype(float)) / any_word, total((_SYMBOL | _set("|"))[last].astype(float)) / any_word, seen[:, :9].sum(1) / some,
        ]
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tx.buffers(batch.column("text"))
        for i, j in tx.blocks(offsets, 2_000_000):
            x = statistics(data, offsets[i : j + 1]).astype(np.float32)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.record_batch([batch.column("doc_id").slice(i, j - i), batch.column("held_out").slice(i, j - i), flat], names=["doc_id", "held_out", "x"])


@dataclass
class Forest:
    """Trees as rows of equal length; a leaf points to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.full(len(x), self.base)
        trees = np.arange(len(self.feature))[None]
        node = np.zeros((len(x), trees.size), np.int32)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go_left = x[rows, self.feature[trees, node]] <= self.cut[trees, node]
            node = np.where(go_left, self.left[trees, node], self.right[trees, node])
        return self.base + self.value[trees, node].sum(1)


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, least: int = 10) -> Forest:
    """Boosts the logistic loss with second-order gains over binned features."""
    y = y.astype(float)
    mean = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(mean / (1 - mean)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0) for c in x.T]
    code = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)]).astype(np.int64) if len(x) else np.empty((0, x.shape[1]), np.int64)
    nodes = 2 ** (depth + 1) - 1
    made = [np.zeros((trees, nodes), t) for t in (np.int32, np.float64, np.int32, np.int32, np.float64)]
    feature, cut, left, right, value = made
    left[:] = right[:] = np.arange(nodes)
    margin = np.full(len(y), base)
    d = x.shape[1]
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        where = np.zeros(len(y), np.int64)
        for level in range(depth):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(where == node)
                if len(rows) < 2 * least:
                    continue
                key = (code[rows] + np.arange(d) * bins).ravel()
                sums = [np.bincount(key, weights=np.repeat(w, d), minlength=d * bins).reshape(d, bins).cumsum(1) for w in (grad[rows], hess[rows], np.ones(len(rows)))]
                g, h, n = sums
                gain = g**2 / (h + ridge) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + ridge) - g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                gain[(n < least) | (n[:, -1:] - n < least)] = -1
                f, b = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[f, b] <= 1e-6 or b >= len(edges[f]):
                    continue
                feature[t, node], cut[t, node], left[t, node], right[t, node] = f, edges[f][b], 2 * node + 1, 2 * node + 2
                where[rows] = np.where(code[rows, f] <= b, 2 * node + 1, 2 * node + 2)
        g, h = np.bincount(where, weights=grad, minlength=nodes), np.bincount(where, weights=hess, minlength=nodes)
        value[t] = rate * g / (h + ridge)
        margin += value[t][where]
    return Forest(*made, base, depth)


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column, *, rows: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """Scores every whole text; learns from at most ``rows`` labelled documents that are not held out.

    docs needs doc_id and text, labels doc_id and quality; other columns are ignored. held_out: a Boolean column over
    doc_id; null counts as false. Null texts count as empty; every row, repeated ones too, gets a score from 0 to 1.
    Without labelled rows every score is 0.5. Returns doc_id, held_out, score, predicted; an empty table gives none.
    """
    spark = docs.sparkSession
    store = Scratch(spark, "quality")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    measured = store.save(docs.mapInArrow(tx.lean(_measure), "doc_id long, held_out boolean, x array<float>"))
    chosen = labelled(labels, "quality", held_out, rows)
    known = measured.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("x", "y").toArrow()
    x = known["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(STATISTICS)) if known.num_rows else np.empty((0, len(STATISTICS)))
    forest = spark.sparkContext.broadcast(grow(x.astype(np.float64), known["y"].to_numpy(), trees=80 if known.num_rows else 0))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(STATISTICS)).astype(np.float64)
            score = np.concatenate([1 / (1 + np.exp(-forest.value.margin(x[i : i + 4096]))) for i in range(0, len(x), 4096)]) if len(x) else np.empty(0)
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return store.finish(measured.mapInArrow(tx.lean(walk), "doc_id long, held_out boolean, score double, predicted int"))
