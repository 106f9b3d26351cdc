"""Best-fit packing of tokenised documents into sequences of fixed length.

Each partition packs its pieces online by best fit into a fixed number of open bins, kept by free space in a bitset:
the lowest set bit at or above a piece's length is the fullest bin that still has room. When all bins are open and
none has room, the fullest one closes. Bins that end nearly full are final. The others travel on as single items,
lengths and names only, and a second pass packs them in the same way, until few partitions remain.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import text as tx
from quillspark.llm.store import Scratch


#: A control sign that stands alone between words and is one id.
MARK = b"\x01"


class OpenBins:
    """At most ``most`` open bins of a capacity; a bit for each free space that some bin has."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.at, self.count = 0, {}, 0

    def add(self, length: int, item: object) -> list[tuple[int, list]]:
        """Puts one item into a bin; returns the bins that this closes, each as its free space and items."""
        if length >= self.capacity:
            return [(0, [item])]
        closed = []
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            held = self._take(free)
        else:
            if self.count >= self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                closed.append((fullest, self._take(fullest)))
            free, held = self.capacity, []
        held.append(item)
        free -= length
        if free:
            self.at.setdefault(free, []).append(held)
            self.bits |= 1 << free
            self.count += 1
        else:
            closed.append((0, held))
        return closed

    def _take(self, free: int) -> list:
        bins = self.at[free]
        held = bins.pop()
        if not bins:
            del self.at[free]
            self.bits &= ~(1 << free)
        self.count -= 1
        return held

    def rest(self) -> list[tuple[int, list]]:
        """All open bins, the fullest first; none stays open."""
        out = [(free, held) for free in sorted(self.at) for held in self.at[free]]
        self.bits, self.at, self.count = 0, {}, 0
        return out


class Encoder:
    """Token ids of whole texts. Words between ASCII white space are encoded alone, as the tokenizer's own rules never
    join them, and kept in a bounded cache."""

    def __init__(self, path: str, words: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism here
        from tokenizers import Tokenizer

        self.tokenizer, self.words = Tokenizer.from_file(path), words
        mark = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids, self.many, self.used = np.empty(1 << 16, np.uint32), np.empty(1 << 14, np.int64), 0
        self.starts = np.empty(1 << 14, np.int64)

    def _ids(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some words, and how many each has; words travel together, parted by a mark that none holds."""
        text = [w.decode("utf-8", "replace") for w in new]
        if self.mark is None:
            got = [e.ids for e in self.tokenizer.encode_batch(text, add_special_tokens=False)]
            return np.array([i for x in got for i in x], np.uint32), np.array([len(x) for x in got], np.int64)
        between = f" {MARK.decode()} "
        flat = [i for e in self.tokenizer.encode_batch_fast([between.join([*text[i : i + 128], ""]) for i in range(0, len(text), 128)], add_special_tokens=False) for i in e.ids]
        ids = np.array(flat, np.uint32)
        marks = np.flatnonzero(ids == self.mark)
        return np.delete(ids, marks), np.diff(marks, prepend=-1) - 1

    def _learn(self, new: list[bytes]) -> None:
        plain = [w for w in new if MARK not in w and b"<|" not in w]
        for words in (plain, *([w] for w in set(new).difference(plain))):
            if not words:
                continue
            if words is plain:
                ids, many = self._ids(plain)
            else:
                ids = np.array(self.tokenizer.encode(words[0].decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)
                many = np.array([len(ids)])
            first, n = len(self.place), len(words)
            if self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.empty(max(len(ids), len(self.ids)), np.uint32)))
            if first + n > len(self.many):
                self.many, self.starts = (np.concatenate((x, np.empty(max(n, len(x)), np.int64))) for x in (self.many, self.starts))
            self.ids[self.used : self.used + len(ids)] = ids
            self.many[first : first + n], self.starts[first : first + n] = many, self.used + np.cumsum(many) - many
            self.place.update(zip(words, range(first, first + n)))
            self.used += len(ids)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and where each text's begin (n + 1)."""
        if len(self.place) > self.words:
            self._clear()
        # the tokenizer folds case itself; its special tokens are spelt in lower case and must not be made here
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        flat = list(chain.from_iterable(split))
        place = np.fromiter(map(self.place.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(place < 0).tolist()
        if missing:
            words = [flat[i] for i in missing]
            self._learn(list(set(words)))
            place[missing] = [self.place[w] for w in words]
        many = self.many[place]
        ends = np.cumsum(many)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[place] - (ends - many), many) + np.arange(total)]
        words = np.cumsum([0, *map(len, split)])
        return ids, np.concatenate(([0], ends))[words]


#: Encoders that outlive a task, one a Python worker.
_KEPT: dict[str, Encoder] = {}


def encoder_of(path: str, words: int, reuse: bool) -> Encoder:
    if not reuse:
        return Encoder(path, words)
    if path not in _KEPT or _KEPT[path].words != words:
        _KEPT[path] = Encoder(path, words)
    return _KEPT[path]


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end: int = 1, open_bins: int = 256, full: float = 0.997, cache_words: int = 1_500_000, reuse: bool = True) -> DataFrame:
    """Packs the token ids of every whole text, then ``end``, into sequences of at most ``capacity`` ids.

    docs needs doc_id and text; other columns are ignored. tokenizer: the path of a tokenizers file that every
    executor can open. cache_words, reuse: how many words' ids a Python worker keeps, and whether from task to task;
    they change memory and time only. Null and empty texts are one id, the end. Only longer documents are cut, into pieces of
    capacity ids and a rest. Repeated rows and doc_ids are packed one by one. Returns a row per piece: doc_id, piece,
    start, length, ids_crc32, sequence_id, offset; offsets of a sequence are gapless. An empty table gives no rows.
    """
    store = Scratch(docs.sparkSession, "packing")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder, bins, made = encoder_of(tokenizer, cache_words, reuse), OpenBins(capacity, open_bins), 0
        ending = np.array([end], np.uint32)

        def out(closed: list[tuple[int, list]]) -> pa.RecordBatch:
            nonlocal made
            rows = []
            for free, held in closed:
                offset = 0
                for item in held:
                    rows.append((*item, (task << 32) + made, offset, capacity - free))
                    offset += item[3]
                made += 1
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), *[pa.int64()] * 6))], names=["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "used"])

        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            _, offsets = tx.buffers(column)
            for i, j in tx.blocks(offsets):
                ids, at = encoder.encode([t or b"" for t in column.slice(i, j - i).to_pylist()])
                closed = []
                for doc, a, b in zip(batch.column("doc_id").slice(i, j - i).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    whole = np.concatenate((ids[a:b], ending))
                    for piece, start in enumerate(range(0, len(whole), capacity)):
                        part = whole[start : start + capacity]
                        closed += bins.add(len(part), (doc, piece, start, len(part), zlib.crc32(part.astype("<u4").tobytes())))
                if closed:
                    yield out(closed)
        if left := bins.rest():
            yield out(left)

    encoded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = store.save(encoded.mapInArrow(tx.lean(first), "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, used long"))
    loose = placed.where((F.col("used") < full * capacity) & (F.col("offset") == 0)).select("bin", "used")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, 1 << 12)

        def out(closed: list[tuple[int, list]]) -> pa.RecordBatch:
            rows = []
            for _, held in closed:
                base = 0
                for name, used in held:
                    rows.append((name, held[0][0], base))
                    base += used
            return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=["bin", "sequence_id", "base"])

        for batch in batches:
            closed = []
            for name, used in zip(batch.column("bin").to_pylist(), batch.column("used").to_pylist()):
                closed += bins.add(used, (name, used))
            if closed:
                yield out(closed)
        if left := bins.rest():
            yield out(left)

    # at most open_bins loose bins a task; a second task for each 50,000 of them, the fullest and the emptiest mixed
    tasks = max(1, loose.count() // 50_000)
    joined = store.save(loose.repartition(tasks, F.pmod(F.xxhash64("bin"), F.lit(tasks))).sortWithinPartitions(F.desc("used"), "bin").mapInArrow(tx.lean(again), "bin long, sequence_id long, base long"))
    moved = placed.join(joined, "bin", "left")
    return store.finish(moved.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("sequence_id", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset")))
