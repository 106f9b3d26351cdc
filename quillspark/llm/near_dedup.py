"""MinHash near-duplicate detection, exact on the candidate pairs and without all pairs of a group.

1. Each text gives its distinct shingles' count, a digest of the set and many universal hash minima. Texts with the
   same set are one class; only one representative of a class goes on.
2. Bands of minima give buckets. In each bucket the least class is the pivot.
3. Candidate pairs are tested in three rounds: each class with its least pivot, then with its other pivots, then,
   in buckets that still hold several components, every pair across components whose sizes allow a link, in blocks of sets
   with a prefix filter. Pairs inside one component need no test, so a group of copies costs about one test a copy. In the first
   two rounds signatures that agree too little are refused; every link is confirmed on the full sets.
4. Links go to connected components by large-star and small-star.

With 32 bands of 4 minima a pair at a similarity of 0.85 shares no bucket with a probability of 6e-11, at 0.80 of 5e-8.
Verification refuses a pair at the bound with a probability of at most 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import text as tx
from quillspark.llm.components import components
from quillspark.llm.store import Scratch, if_small

BANDS, ROWS = 32, 4
_rng = np.random.Generator(np.random.PCG64(5))
_A = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
#: Buckets whose pivots are broadcast; executors keep such tables for a while after the join.
FEW = 100_000
#: Members of an unresolved bucket that one task compares with as many others.
BLOCK = 512


def signatures(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Minima of universal hashes a * x + b (the high 32 bits) over each row's shingles; rows must not be empty."""
    out = np.empty((len(at) - 1, BANDS * ROWS), np.uint32)
    for i, j in tx.blocks(at, 50_000):
        part, cuts = x[at[i] : at[j]], at[i:j] - at[i]
        for k in range(BANDS * ROWS):
            out[i:j, k] = np.minimum.reduceat(part * _A[k] + _B[k], cuts) >> np.uint64(32)
    return out


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows i to j, their distinct shingles, sorted in each row, and where each row's begin."""
    data, offsets = tx.buffers(batch.column("text"))
    for i, j in tx.blocks(offsets):
        h, at = tx.words(data, offsets[i : j + 1])
        x, to = tx.shingles(h, at - at[0], k)
        parts = [np.unique(x[a:b]) for a, b in zip(to[:-1], to[1:])]
        n = np.array([len(p) for p in parts], dtype=np.int64)
        yield i, j, np.concatenate(parts) if parts else x, np.concatenate(([0], np.cumsum(n)))


def _digests(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each row's set; rows must not be empty."""
    return np.add.reduceat(tx.mix(x), at[:-1]), np.add.reduceat(tx.mix(x ^ tx.END), at[:-1])


def _node(d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    return tx.mix(d1 ^ tx.mix(d2)).view(np.int64)


def _describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, x, at in _sets(batch, k):
                n = np.diff(at)
                full = n > 0
                node = np.zeros(len(n), np.int64)
                marks: list = [None] * len(n)
                if full.any():
                    cuts = np.append(at[:-1][full], at[-1])
                    node[full] = _node(*_digests(x, cuts))
                    for row, mark in zip(np.flatnonzero(full), signatures(x, cuts)):
                        marks[row] = mark.tobytes()
                yield pa.record_batch([batch.column("doc_id").slice(i, j - i), batch.column("uid").slice(i, j - i), pa.array(n), pa.array(node, mask=~full), pa.array(marks, pa.binary())], names=["doc_id", "uid", "n_shingles", "node", "mark"])

    return run


def _band_keys(marks: list[bytes]) -> np.ndarray:
    """Rows x BANDS: a key of each band's place and minima."""
    marks = np.frombuffer(b"".join(marks), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.zeros(marks.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = tx.mix(key * np.uint64(31) ^ marks[:, :, r])
    return key


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = _band_keys(batch.column("mark").to_pylist())
        yield pa.record_batch([pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(batch.column("node").to_numpy(), BANDS))], names=["bucket", "node"])


def _shingle_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, x, at in _sets(batch, k):
                full = np.diff(at) > 0
                if full.any():
                    cuts = np.append(at[:-1][full], at[-1])
                    yield pa.record_batch([pa.array(_node(*_digests(x, cuts))), tx.binary([x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])])], names=["node", "members"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                a, b = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _likely(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("mark_a", "mark_b"))
                yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(1) >= least))

    return run


def refusal(percent: int, chance: float = 1e-9) -> int:
    """Of all minima the least number of equal ones that a pair must have: one at the bound has fewer with this chance at most."""
    n, p, total = BANDS * ROWS, percent / 100, 0.0
    for k in range(n + 1):
        total += comb(n, k) * p**k * (1 - p) ** (n - k)
        if total > chance:
            return k
    return n


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks become keys of their bands."""
    for batch in batches:
        keys = [r.tobytes() for r in _band_keys(batch.column("mark").to_pylist())]
        at = batch.schema.get_field_index("mark")
        yield batch.set_column(at, "keys", pa.array(keys, pa.binary()))


def _across(percent: int):
    """Of two blocks of a bucket: for each pair of components the best linked pair of texts.

    A pair is looked at only in the first bucket that both texts share. Of each set the members that are rarest in the blocks
    are looked up; two sets that are alike enough share one of those.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        found: dict[tuple[int, int], tuple[float, int, int]] = {}
        if len(left) and len(right):
            keys = [np.frombuffer(b"".join(x["keys"]), np.uint64).reshape(len(x), -1) for x in (left, right)]
            here = np.uint64(int(pdf["bucket"].iloc[0]) % 2**64)
            sets = [np.frombuffer(x, np.uint64) for x in [*left["members"], *right["members"]]]
            sizes = np.array([len(x) for x in sets])
            owner = np.repeat(np.arange(len(sets)), sizes)
            value, back, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            order = np.lexsort((back, many[back], owner))
            rank = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            early = rank < (sizes - -(-percent * sizes // 100) + 1)[owner[order]]
            token, whose = back[order][early], owner[order][early]
            old = whose >= len(left)
            by = np.argsort(token[old], kind="stable")
            theirs, whom = token[old][by], whose[old][by]
            mine, who = token[~old], whose[~old]
            low, high = np.searchsorted(theirs, mine, "left"), np.searchsorted(theirs, mine, "right")
            n = high - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            pair = np.unique(np.repeat(who, n) * len(sets) + whom[at])
            x, y = pair // len(sets), pair % len(sets)
            nodes, parts = (np.concatenate((left[c].to_numpy(), right[c].to_numpy())) for c in ("node", "component"))
            fine = (100 * np.minimum(sizes[x], sizes[y]) >= percent * np.maximum(sizes[x], sizes[y])) & (parts[x] != parts[y])
            x, y = x[fine], y[fine]
            if len(x):
                shared = keys[0][x] == keys[1][y - len(left)]
                first = keys[0][x, shared.argmax(1)] == here
                x, y = x[first], y[first]
            for i, j in zip(x.tolist(), y.tolist()):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                either = sizes[i] + sizes[j] - both
                if 100 * both >= percent * either:
                    two = (min(parts[i], parts[j]), max(parts[i], parts[j]))
                    if two not in found or both / either > found[two][0]:
                        found[two] = (both / either, min(nodes[i], nodes[j]), max(nodes[i], nodes[j]))
        return pd.DataFrame([f[1:] for f in found.values()], columns=["a", "b"], dtype="int64")

    return run


def link_documents(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """Near-duplicate components of whole texts by the Jaccard similarity of their sets of ``words``-word shingles.

    Two documents are linked if 100 * intersection >= percent * union. A text of fewer words has its whole sequence
    as one shingle; null texts and texts without words have none and are linked with nothing. Texts of the same set
    are one class however many they are; doc_ids may repeat. Returns a row per input row: doc_id, uid (names doc_id and text),
    n_shingles, class_id (least doc_id of the same set), component_id (least doc_id reachable), group (a name of the component;
    null without shingles), kept (doc_id = component_id; of
    rows that repeat a doc_id and a set all are kept or none). A null doc_id never stands for a component; such
    rows are kept only if their component has no doc_id. An empty table gives no rows.
    """
    store = Scratch(docs.sparkSession, "near_dedup")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("uid"))
    described = store.save(docs.mapInArrow(tx.lean(_describe(words)), "doc_id long, uid long, n_shingles long, node long, mark binary"))
    classes = store.save(described.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("class_id"), F.min("uid").alias("text_of"), F.first("mark").alias("mark"), F.first("n_shingles").alias("n")))

    banded = classes.select("node", "mark").mapInArrow(tx.lean(_bands), "bucket long, node long")
    # stored apart, so that the join has two plain sides and a bucket of very many classes can be split
    pivots = store.save(banded.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("size")).where("size > 1"))
    buckets = store.save(banded.join(if_small(pivots, FEW), "bucket"))

    agree = refusal(percent)
    candidates = store.save(buckets.select("node").distinct().join(classes.select("node", "text_of"), "node"))
    names = if_small(store.save(candidates.select(F.col("text_of").alias("uid")).distinct()))
    fetched = docs.join(names, "uid", "left_semi").select("text").mapInArrow(tx.lean(_shingle_sets(words)), "node long, members binary")
    wanted = if_small(candidates.select("node"))
    sets = store.save(fetched.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("members").alias("members")))
    marks = classes.select("node", "mark")

    def links(pairs: DataFrame) -> DataFrame:
        marked = pairs.join(marks.select(F.col("node").alias("a"), F.col("mark").alias("mark_a")), "a").join(marks.select(F.col("node").alias("b"), F.col("mark").alias("mark_b")), "b")
        pairs = marked.mapInArrow(tx.lean(_likely(agree)), "a long, b long")
        full = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("left")), "a").join(sets.select(F.col("node").alias("b"), F.col("members").alias("right")), "b")
        return store.save(full.select("a", "b", "left", "right").mapInArrow(tx.lean(_confirm(percent)), "a long, b long"))

    def named(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Components of both ends; a node without links is its own."""
        a, b = (labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
        return pairs.join(a, "a", "left").join(b, "b", "left").select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))

    starred = buckets.where("node != pivot").select(F.col("node").alias("b"), F.col("pivot").alias("a")).distinct()
    found = links(starred.groupBy("b").agg(F.min("a").alias("a")))
    labels = store.save(components(store, found))
    more = links(named(starred, labels).where("ca != cb").select("a", "b"))
    found = found.union(more)
    labels = store.save(components(store, found))

    member = buckets.select("bucket", "node").join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    parts = member.groupBy("bucket", "component").agg(F.count("*").alias("n")).groupBy("bucket")
    spread = parts.agg(F.max_by("component", F.struct("n", "component")).alias("large"), F.sum("n").alias("size"), (F.sum("n") - F.max("n")).alias("others")).where("others > 0 and size > 2").select("bucket", "large")
    spread = if_small(store.save(spread), FEW)
    # the bucket's members outside its largest component are compared with those of its members whose sizes are near, block by block:
    # sizes fall into bands, and a set can be linked only to sets of its band and the two beside it
    band = F.floor(F.log(F.col("n")) / (F.log(F.lit(100 / percent)) * 1.000001)).cast("int")
    open_ = store.save(member.join(spread, "bucket").join(classes.select("node", "n"), "node").select("bucket", "node", "component", "large", band.alias("band")))
    if not open_.isEmpty():
        near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band")
        asking = open_.where("component != large").select("bucket", "node", "component", near)
        blocks = lambda: F.ceil(F.count("*") / BLOCK).cast("int")
        sizes = store.save(open_.groupBy("bucket", "band").agg(blocks().alias("blocks")).join(asking.groupBy("bucket", "band").agg(blocks().alias("left_blocks")), ["bucket", "band"]))
        full = open_.select("node").distinct().join(marks, "node").join(sets, "node").mapInArrow(tx.lean(_keyed), "node long, keys binary, members binary")
        full = store.save(full)
        left = asking.join(sizes, ["bucket", "band"]).select("bucket", "band", F.pmod(F.hash("node"), "left_blocks").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(0).alias("side"), "node", "component")
        right = open_.join(sizes, ["bucket", "band"]).select("bucket", "band", F.explode(F.sequence(F.lit(0), F.col("left_blocks") - 1)).alias("i"), F.pmod(F.hash("node"), "blocks").alias("j"), F.lit(1).alias("side"), "node", "component")
        found = found.union(store.save(left.union(right).join(full, "node").groupBy("bucket", "band", "i", "j").applyInPandas(_across(percent), "a long, b long").distinct()))
        labels = store.save(components(store, found))

    least = classes.join(labels, "node", "left").select("node", "class_id", F.coalesce("component", "node").alias("component"))
    heads = least.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named_nodes = store.save(least.join(heads, "component").select("node", "class_id", "component_id", F.col("component").alias("group")))
    out = described.select("doc_id", "uid", "n_shingles", "node").join(named_nodes, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id"))
    out = out.select("doc_id", "uid", "n_shingles", F.coalesce("class_id", own).alias("class_id"), F.coalesce("component_id", own).alias("component_id"), "group")
    return store.finish(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
