"""LM scoring: a hidden Markov language model with exact sequence likelihoods.

Words are 64-bit hashes. All words of the training texts are counted. The most frequent ones have an emission
probability of their own in every state; the rest share one emission symbol, and a rare word's share of it
depends on its count alone. A text's probability thus splits exactly into the forward recursion over symbols,
which needs a bounded model, and a sum over its rare words, which needs their counts: counts of the next most
frequent words are broadcast (bounded by ``count_table``), the others are joined by word.

Every text is hashed and looked up once; what the passes read is a table of its symbols. Baum-Welch: each partition runs
scaled forward-backward over its texts, emits expected counts, and Spark sums them by symbol. The first passes, from random
start values, are over growing shares of the training texts, by a hash of the text, so they grow with the corpus; then follow passes
over all of them until the likelihood hardly rises.
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

#: Tokens that one forward-backward block holds; a longer text is a block of its own.
TOKENS = 1_500_000


@dataclass
class Model:
    """start: K; move: K x K; emit: (symbols + 1) x K, the last row for all rare words."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def time_major(tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens ordered by position, then by text from the longest; how many texts reach each position; the texts' order."""
    n = np.diff(at)
    order = np.argsort(-n, kind="stable")
    longest = int(n.max()) if len(n) else 0
    active = np.searchsorted(np.sort(-n), -np.arange(longest), side="left")  # texts longer than t
    starts = at[:-1][order]
    index = np.empty(int(n.sum()), dtype=np.int64)
    to = np.concatenate(([0], np.cumsum(active)))
    sizes = n[order]
    # text r's token t goes to to[t] + r
    rank = np.repeat(np.arange(len(order)), sizes)
    step = np.arange(len(rank)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    index[to[step] + rank] = np.repeat(starts, sizes) + step
    return tokens[index], active, order


def forward(model: Model, tokens: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward probabilities, emissions and scales, all in time-major order."""
    emitted = model.emit[tokens]
    alpha = emitted.copy()
    scale = np.empty(len(tokens), np.float32)
    before, o = None, 0
    for m in active:
        a = alpha[o : o + m]
        a *= model.start if before is None else before[:m] @ model.move
        c = a.sum(1)
        a /= c[:, None]
        scale[o : o + m] = c
        before, o = a, o + m
    return alpha, emitted, scale


def expected(model: Model, tokens: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of starts, moves and emissions, from forward-backward, and the log10 likelihood."""
    k = len(model.start)
    alpha, emitted, scale = forward(model, tokens, active)
    likelihood = float(np.log10(scale.astype(np.float64)).sum())
    emitted /= scale[:, None]
    moves = np.zeros((k, k))
    to = np.concatenate(([0], np.cumsum(active)))
    back = None
    turned = np.ascontiguousarray(model.move.T)
    for t in range(len(active) - 1, -1, -1):
        o, m = to[t], active[t]
        if back is not None:
            p = len(back)
            moves += alpha[o : o + p].T @ back
            alpha[o : o + p] *= back @ turned
        back = emitted[o : o + m]
        if t:
            # beta of this position times its scaled emission; gamma is alpha * beta, so beta = gamma / alpha
            if t + 1 < len(active) and active[t + 1]:
                p = active[t + 1]
                back = back.copy()
                back[:p] *= later
            later = back @ turned
    counts = np.empty((len(model.emit), k))
    for j in range(k):
        counts[:, j] = np.bincount(tokens, weights=alpha[:, j], minlength=len(model.emit))
    return alpha[: active[0]].sum(0, dtype=np.float64), moves * model.move, counts, likelihood


def maximise(start: np.ndarray, moves: np.ndarray, emits: np.ndarray, prior: np.ndarray, weight: float) -> Model:
    """The model of expected counts, with the unigram law as prior so that all probabilities are positive."""
    k = len(start)
    start = (start + 1) / (start.sum() + k)
    moves = (moves + 1) / (moves.sum(1, keepdims=True) + k)
    emits = (emits + weight * prior[:, None]) / (emits.sum(0) + weight)
    return Model(start.astype(np.float32), moves.astype(np.float32), emits.astype(np.float32))


def with_end(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's words and then one end."""
    return np.insert(h, at[1:], tx.END), at + np.arange(len(at))


def look_up(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each hash in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    place = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return place, table[place] == h


def _batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Words of whole texts, with ends, in groups of rows of about TOKENS words at most."""
    for batch in batches:
        data, offsets = tx.buffers(batch.column(column))
        group, size, first = [], 0, 0
        for i, j in tx.blocks(offsets):
            h, at = tx.words(data, offsets[i : j + 1])
            h, at = with_end(h, at - at[0])
            if group and size + len(h) > TOKENS:
                yield batch.slice(first, i - first), *_join(group)
                group, size, first = [], 0, i
            group.append((h, at))
            size += len(h)
        if group:
            yield batch.slice(first), *_join(group)


def _join(group: list) -> tuple[np.ndarray, np.ndarray]:
    if len(group) == 1:
        return group[0]
    base = np.cumsum([0, *(len(h) for h, _ in group)])
    return np.concatenate([h for h, _ in group]), np.concatenate([[0], *(at[1:] + b for (_, at), b in zip(group, base))])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate(x) for x in zip(*held))
        unique, back = np.unique(keys, return_inverse=True)
        return unique, np.bincount(back, weights=n).astype(np.int64)

    def out() -> pa.RecordBatch:
        keys, n = merged()
        return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], names=["h", "c"])

    for _, h, _ in _batches(batches, "text"):
        keys, n = np.unique(h, return_counts=True)
        held.append((keys, n))
        size += len(keys)
        if size > 3_000_000:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Symbols of whole texts in groups of rows of TOKENS words at most, or of one row."""
    for batch in batches:
        data, offsets = tx.buffers(batch.column("symbols"))
        for i, j in tx.blocks(offsets, 4 * TOKENS):
            a, b = int(offsets[i]), int(offsets[j])
            yield batch.slice(i, j - i), np.frombuffer(data[a:b].tobytes(), np.int32).astype(np.int64), (offsets[i : j + 1] - a) // 4


def count_words(train: DataFrame) -> DataFrame:
    """(h, c): how often each word, and the end, is in the texts."""
    return train.select("text").mapInArrow(tx.lean(_count), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


#: Shares of the training texts that the first passes of Baum-Welch are over, and how many passes each has.
RAMP = ((1 / 16, 6), (1 / 4, 3))


def score_texts(docs: DataFrame, held_out: Column, *, states: int = 8, symbols: int = 1 << 16, count_table: int = 1 << 20, ramp: tuple = RAMP, passes: int = 4, gain: float = 0.002) -> DataFrame:
    """Scores every whole text by a model of the texts that are not held out.

    docs needs doc_id and text; other columns are ignored. held_out: a Boolean column over docs; null counts as
    false. Null and empty texts have one token, the end. Repeated rows, doc_ids included, are scored one by one.
    The ``symbols`` commonest words have emissions of their own in each state, all others their counts. Passes over all training
    texts end when the mean log10 likelihood of a token rises by less than ``gain``, after ``passes`` at the latest.
    Returns doc_id, held_out, n_tokens, n_known, train_tokens, vocabulary, base_score, score (log10). An empty
    table gives no rows. Without training texts every score is 0.
    """
    spark = docs.sparkSession
    store = Scratch(spark, "hmm")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = docs.where(~F.col("held_out"))
    vocabulary = store.save(count_words(train))
    steps = F.least("c", F.lit(1 << 16)).alias("step")
    sizes = vocabulary.groupBy(steps).agg(F.count("*").alias("n"), F.sum("c").alias("c")).orderBy(F.desc("step")).collect()
    total, distinct = sum(r["c"] for r in sizes), sum(r["n"] for r in sizes)
    least, room = (1 << 16) + 1, count_table
    for r in sizes:
        if r["n"] > room:
            break
        least, room = r["step"], room - r["n"]
    table = vocabulary.where(F.col("c") >= least).toArrow()
    keys, counts = table["h"].to_numpy().view(np.uint64), table["c"].to_numpy()
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    chosen = np.lexsort((keys, -counts))[:symbols]
    symbol = np.full(len(keys), -1, np.int32)
    symbol[np.sort(chosen)] = np.arange(len(chosen))
    in_symbols = counts[symbol >= 0]
    m = len(in_symbols)
    rare, rare_kinds = total - int(in_symbols.sum()), distinct - m
    prior = np.append(in_symbols + 1.0, rare + rare_kinds + 1.0) / (total + distinct + 1.0)
    rare_log = float(np.log10(rare + rare_kinds + 1.0))
    base_log = float(np.log10(total + distinct + 1.0))
    shared = spark.sparkContext.broadcast((keys, counts, symbol))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text's symbols, what its words' counts say, and its words beyond the table."""
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 36
        keys, counts, symbol = shared.value
        for batch, h, at in _batches(batches, "text"):
            n = np.diff(at)
            place, found = look_up(keys, h)
            tokens = np.full(len(h), m, np.int32)
            known = np.zeros(len(h), np.int64)
            if len(keys):
                known = np.where(found, counts[place], 0)
                got = np.where(found, symbol[place], -1)
                tokens = np.where(got < 0, m, got).astype(np.int32)
            text = np.repeat(np.arange(len(n)), n)
            counted = np.log10(known + 1.0)
            # words beyond the table count as unseen here; the join adds what their counts say
            base = np.bincount(text, weights=counted - base_log, minlength=len(n))
            share = np.bincount(text, weights=np.where(tokens == m, counted - rare_log, 0.0), minlength=len(n))
            rest = ~found
            pairs = np.lexsort((h[rest], text[rest]))
            left_text, left = text[rest][pairs], h[rest][pairs]
            first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (left_text[1:] != left_text[:-1]))) if len(left) else np.empty(0, np.int64)
            many = np.diff(first, append=len(left))
            cuts = np.searchsorted(left_text[first], np.arange(len(n) + 1)).astype(np.int32)
            yield pa.record_batch(
                [
                    pa.array(row + np.arange(len(n))), *(batch.column(c) for c in ("doc_id", "held_out", "dealt")), pa.array(n.astype(np.int64)), pa.array(np.bincount(text, weights=found, minlength=len(n)).astype(np.int64)), pa.array(base), pa.array(share),
                    pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(4 * at.astype(np.int64)), pa.py_buffer(tokens)]).cast(pa.binary()),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(left[first].view(np.int64))), pa.ListArray.from_arrays(pa.array(cuts), pa.array(many.astype(np.int32))),
                ],
                names=["row", "doc_id", "held_out", "dealt", "n_tokens", "n_known", "base", "share", "symbols", "rest", "many"],
            )
            row += len(n)

    named = docs.withColumn("dealt", F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 20)).cast("int"))
    encoded = store.save(named.mapInArrow(tx.lean(encode), "row long, doc_id long, held_out boolean, dealt int, n_tokens long, n_known long, base double, share double, symbols binary, rest array<long>, many array<int>"))
    shared.unpersist()
    model, weight, before = _random_start(prior, states), 50.0, -np.inf
    # each share is a table of its own, so that a pass reads no more than it works on
    shares = {1.0: encoded.where(~F.col("held_out")).select("dealt", "symbols")}
    for part in sorted({f for f, _ in ramp}, reverse=True):
        shares[part] = store.save(shares[min(shares)].where(F.col("dealt") < int(part * (1 << 20))))
    for part in [f for f, times in ramp for _ in range(times)] + [1.0] * passes if total else []:
        now = spark.sparkContext.broadcast(model)

        def gather(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            model, sums = now.value, None
            for _, tokens, at in _stored(batches):
                tokens, active, _ = time_major(tokens, at)
                got = expected(model, tokens, active)
                sums = got if sums is None else tuple(a + b for a, b in zip(sums, got))
            if sums is not None:
                k = len(model.start)
                grid = np.vstack((sums[2], sums[0][None], sums[1], np.full((1, k), sums[3])))
                some = np.flatnonzero(grid.any(1))
                yield pa.record_batch([pa.array(some.astype(np.int32)), *(pa.array(grid[some, j]) for j in range(k))], names=["row", *(f"s{j}" for j in range(k))])

        got = shares[part].select("symbols").mapInArrow(tx.lean(gather), "row int, " + ", ".join(f"s{j} double" for j in range(states))).groupBy("row").agg(*(F.sum(f"s{j}").alias(f"s{j}") for j in range(states))).toArrow()
        now.unpersist()
        grid = np.zeros((m + 3 + states, states))
        grid[got["row"].to_numpy()] = np.column_stack([got[f"s{j}"].to_numpy() for j in range(states)]) if got.num_rows else 0
        model = maximise(grid[m + 1], grid[m + 2 : m + 2 + states], grid[: m + 1], prior, weight)
        if part == 1.0:
            mean = grid[-1, 0] / total
            if mean - before < gain:
                break
            before = mean
    final = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens, at in _stored(batches):
            moved, active, order = time_major(tokens, at)
            _, _, scale = forward(final.value, moved, active)
            text_of = order[np.arange(len(moved)) - np.repeat(np.cumsum(active) - active, active)]
            logs = np.bincount(text_of, weights=np.log10(scale.astype(np.float64)), minlength=batch.num_rows)
            yield pa.record_batch([*(batch.column(c) for c in ("row", "doc_id", "held_out", "n_tokens", "n_known", "base")), pa.array(logs + batch.column("share").to_numpy())], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model"])

    columns = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "share", "symbols"]
    scored = store.save(encoded.select(columns).mapInArrow(tx.lean(score), "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double"))
    rest = encoded.select("row", F.explode(F.arrays_zip("rest", "many")).alias("x")).select("row", F.col("x.rest").alias("h"), F.col("x.many").alias("many"))
    rare_words = vocabulary.where(F.col("c") < least)
    more = rest.join(rare_words, "h").groupBy("row").agg(F.sum("many").alias("more_known"), F.sum(F.col("many") * F.log10(F.col("c") + 1)).alias("more"))
    out = scored.join(more, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return store.finish(
        out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), F.lit(distinct).cast("long").alias("vocabulary"), (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"))
    )


def _random_start(prior: np.ndarray, states: int) -> Model:
    """The unigram law with noise in each state, and states that tend to stay."""
    emit = prior[:, None] * np.random.default_rng(11).gamma(2.0, 1.0, (len(prior), states))
    move = np.full((states, states), 0.4 / states) + 0.6 * np.eye(states)
    return Model(np.full(states, 1 / states, np.float32), move.astype(np.float32), (emit / emit.sum(0)).astype(np.float32))
