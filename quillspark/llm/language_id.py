"""Language identification by error-correcting output codes over byte trigrams.

Every language gets a codeword; for each of its bits a logistic regression on hashed trigrams, spaces included,
tells the languages with the bit from those without it. A text takes the language whose codeword has the least
summed logistic loss, bits weighted by how well their classifiers did on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm import text as tx
from quillspark.llm.store import Scratch

BUCKETS = 4096
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[~tx.LETTER] = 32  # digits, signs and white space all part words


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the trigram at each byte, and whether it is inside its text and has a letter."""
    part = _FOLD[data[offsets[0] : offsets[-1]]]
    if len(part) < 3:
        return np.zeros(len(part), np.uint16), np.zeros(len(part), bool)
    code = part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:]
    good = code != np.uint32(0x202020)
    code = (code * np.uint32(2654435761)) >> np.uint32(20)
    ends = offsets[1:] - offsets[0]
    for back in (1, 2):
        over = ends - back
        good[over[(over >= 0) & (over < len(good))]] = False
    return np.append(code, [0, 0]).astype(np.uint16), np.append(good, [False, False])


def codewords(classes: int) -> np.ndarray:
    """classes x bits of +1 and -1: of many seeded random codes the one whose nearest codewords are farthest apart."""
    bits = max(7, 4 * int(np.ceil(np.log2(max(classes, 2)))) + 3)
    rng, best, far = np.random.default_rng(3), None, -1
    for _ in range(200 if classes < 64 else 4):
        code = rng.choice([-1.0, 1.0], (classes, bits))
        if classes > 1:
            code[0, np.abs(code.sum(0)) == classes] *= -1  # a bit must part the classes
        alike = code @ code.T
        np.fill_diagonal(alike, -bits)
        apart = int((bits - alike.max()) / 2)
        if apart > far:
            best, far = code, apart
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest codeword of each row, its share of belief, and its lead over the next."""
        ones, zeros = (np.logaddexp(0, sign * margin) * self.trust for sign in (-1, 1))  # the loss of a bit of 1, of -1
        loss = ones @ (self.code > 0).T + zeros @ (self.code < 0).T
        order = np.argsort(loss, 1, kind="stable")
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        best = share[np.arange(len(loss)), order[:, 0]]
        lead = best - share[np.arange(len(loss)), order[:, 1]] if loss.shape[1] > 1 else best
        return order[:, 0], best, lead


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 100) -> Model:
    """x: rows of trigram shares; y: places in languages. All bits are fitted at once, by Adam."""
    code = codewords(len(languages))
    scale = 1 / (x.std(0) + np.float32(1e-4))
    x = x * scale
    target = ((code[y] + 1) / 2).astype(np.float32)
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    m, v = np.zeros((x.shape[1] + 1, code.shape[1]), np.float32), np.zeros((x.shape[1] + 1, code.shape[1]), np.float32)
    for t in range(1, steps + 1):
        miss = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - target) / np.float32(len(x))
        g = np.vstack((x.T @ miss + np.float32(1e-4) * w, miss.sum(0)))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    right = (((x @ w + b) > 0) == (target > 0.5)).mean(0)
    trust = np.log(np.clip(right, 0.501, 0.999) / (1 - np.clip(right, 0.501, 0.999)))
    return Model(languages, code, (w * scale[:, None]).astype(np.float32), b, trust / trust.max())


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tx.buffers(batch.column("text"))
        for i, j in tx.blocks(offsets):
            cut = offsets[i : j + 1]
            code, good = trigrams(data, cut)
            row = np.repeat(np.arange(j - i), np.diff(cut))[good]
            seen = np.bincount(row * BUCKETS + code[good], minlength=(j - i) * BUCKETS).reshape(j - i, BUCKETS)
            seen = (seen / np.maximum(seen.sum(1, keepdims=True), 1)).astype(np.float32)
            yield pa.record_batch([batch.column("lang").slice(i, j - i), batch.column("k").slice(i, j - i), pa.array([r.tobytes() for r in seen], pa.binary())], names=["lang", "k", "x"])


def identify(docs: DataFrame, held_out: Column, *, rows: int = 2500, lead: float = 0.2) -> DataFrame:
    """Predicts the language of every whole text.

    docs needs doc_id, text and lang; other columns are ignored. It learns from at most ``rows`` distinct documents with a
    lang that are not held out, dealt evenly over all languages (of more than ``rows`` languages the commonest) and
    taken by a hash of doc_id and text.
    held_out: a Boolean column; null counts as false. Texts that are null or have no letter get ``und`` and 0, as
    all do if there is nothing to learn from. Returns doc_id, held_out, lang_pred, score (0 to 1), ambiguous (the
    next codeword is nearer than ``lead``), for every row, repeated ones too; an empty table gives none.
    """
    spark = docs.sparkSession
    store = Scratch(spark, "language")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    train = docs.where(~F.col("held_out") & F.col("lang").isNotNull())
    train = train.where(letter)
    counts = train.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()
    quota = rows // max(len(counts), 1)
    # of a language about 1.2 times its quota and 20 are looked at, so that no task chooses from all rows
    shares = spark.createDataFrame([(r["lang"], float(min(1.0, (1.2 * quota + 20) / r["count"]))) for r in counts], "lang string, part double")
    named = train.select("text", "lang", F.xxhash64("doc_id", "text").alias("k")).join(F.broadcast(shares), "lang")
    few = named.where(F.pmod("k", F.lit(1 << 40)) < F.col("part") * (1 << 40)).dropDuplicates(["lang", "k"])
    got = few.select("lang", "k", "text").mapInArrow(tx.lean(_shares), "lang string, k long, x binary").toArrow().sort_by([("lang", "ascending"), ("k", "ascending")])
    model = None
    if got.num_rows:
        said = np.array(got["lang"].to_pylist(), object)
        begins = np.append(True, said[1:] != said[:-1])
        at = np.arange(len(said))
        chosen = np.flatnonzero(at - np.maximum.accumulate(np.where(begins, at, 0)) < quota)
        names = said[begins].tolist()
        x = np.frombuffer(b"".join(got["x"].take(chosen).to_pylist()), np.float32).reshape(-1, BUCKETS)
        model = fit(x, (np.cumsum(begins) - 1)[chosen], names)
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            said, score, unsure = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            if model is not None and batch.num_rows:
                data, offsets = tx.buffers(batch.column("text"))
                readable = batch.column("letter").to_numpy(zero_copy_only=False)
                for i, j in tx.blocks(offsets, 2_000_000):
                    cut = offsets[i : j + 1]
                    code, good = trigrams(data, cut)
                    n = np.diff(cut)
                    row = np.repeat(np.arange(j - i), n)[good]
                    code = code[good]
                    many = np.maximum(np.bincount(row, minlength=j - i), 1)
                    margin = np.column_stack([np.bincount(row, weights=model.weights[:, b][code], minlength=j - i) for b in range(model.code.shape[1])]) / many[:, None] + model.bias
                    best, share, ahead = model.decode(margin)
                    fine = readable[i:j]
                    said[i:j] = np.where(fine, np.array(model.languages, object)[best], "und")
                    score[i:j], unsure[i:j] = np.where(fine, share, 0.0), ~fine | (ahead < lead)
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(said, pa.string()), pa.array(score), pa.array(unsure)], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    ready = docs.select("doc_id", "held_out", "text", letter.alias("letter"))
    return store.finish(ready.mapInArrow(tx.lean(predict), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"))
