"""Passages that repeat across documents, exactly or nearly: k-mer seeds, collinear chains, alignment.

1. Seeds are k-word windows, thinned to the least of every w in a row, so any run of k + w - 1 equal words shares one.
2. Each seed's places in later documents are linked to those in its first one, by doc_id, not to each other. A task links
   what it has to its own first holder and sends that holder's places on, packed in buckets, so a passage that a third of
   the corpus holds costs a place a task in the shuffle; there the first holder of all is found, and the task's links are moved to it by a
   join on seed and task's holder, which no passage makes large. So links don't depend on how rows lie in tasks.
3. A document's links with one partner are chained: blocks in order in both texts, scored by length less gap costs,
   with the best predecessor found in a Fenwick tree of prefix maxima.
4. Chains are extended and aligned on the words themselves, fetched once for each distinct span; spans that very many
   chains ask for are copied as often as needed. A chain that is not
   alike enough as a whole is split at its widest gaps, so passages around differing words are found each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import text as tx
from quillspark.llm.store import Scratch, free_name, if_small

LINK = "doc_id long, uid long, pos int, partner_id long, partner_uid long, partner_pos int"
#: Seeds that a task holds before it links and sends them on, and parts in which it does so: sorting takes many times the memory of what is sorted.
HELD, PARTS = 1_000_000, 8
#: Bytes of text that are scanned at once; hashing takes about fifty times as much.
SCANNED = 250_000
#: Words beyond a chain's ends that alignment looks at.
MARGIN = 16
#: Spans of a document in one list, and chains that one copy of a partner's span serves.
ASKED, SHARED = 1000, 2000
#: Bytes of words in an Arrow batch of slices.
SLICES = 4_000_000
#: Words between two spans that still count together.
TOUCH = 3


def _slide(x: np.ndarray, w: int, best) -> np.ndarray:  # noqa: ANN001
    """best of every w values in a row, by doubling."""
    size, out = 1, x
    while 2 * size <= w:
        out = best(out[:-size], out[size:])
        size *= 2
    if size < w:
        out = best(out[: len(out) - (w - size)], out[w - size :])
    return out


def seeds(h: np.ndarray, at: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in h where chosen k-mers begin, and their hashes; none crosses two rows."""
    if len(h) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    value = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        value += h[j : len(h) - k + 1 + j] * tx._SALT[j]
    value = tx.mix(value)
    inside = np.ones(len(value), bool)
    for cut in range(1, k):  # a window that begins within k - 1 words before a row's end crosses it
        over = at[1:] - cut
        inside[over[(over >= 0) & (over < len(value))]] = False
    n = np.diff(at)
    for row in np.flatnonzero(n < k):
        inside[at[row] : min(at[row + 1], len(value))] = False
    top = np.uint64(2**64 - 1)
    order = np.where(inside, value, top)
    padded = np.concatenate((np.full(w - 1, top), order, np.full(w - 1, top)))
    least = _slide(padded, w, np.minimum)
    chosen = (_slide(least, w, np.maximum)[: len(order)] == order) & inside
    place = np.flatnonzero(chosen)
    return place, value[place]


def _runs_of(*keys: np.ndarray) -> np.ndarray:
    """Whether a new run of equal keys begins at each place."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _number(new: np.ndarray) -> np.ndarray:
    """Places within runs, from 0."""
    at = np.arange(len(new))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _sorted(h: np.ndarray, doc: np.ndarray, uid: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """By seed, document and place; a document that repeats is one."""
    order = np.lexsort((pos, uid, doc, h))
    h, doc, uid, pos = h[order], doc[order], uid[order], pos[order]
    keep = _runs_of(h, uid, pos)
    return h[keep], doc[keep], uid[keep], pos[keep]


#: Of the shuffle: first holders' places, a row a bucket of seeds with their columns packed, and links within a task, dealt by document.
FOUND = "bucket long, h binary, doc binary, uids binary, places binary, seed long, doc_id long, uid long, pos int, number int, partner_id long, partner_uid long, partner_pos int"
#: Seeds that a bucket should hold; it is sorted in a worker's memory.
BUCKET = 200_000
#: What comes out: links within a task, and for each seed the places of a task's holder and of the first of all.
PAIRS = "seed long, doc_id long, uid long, pos int, number int, partner_id long, partner_uid long, partner_pos int, places array<int>, partner_places array<int>"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _scan(k: int, w: int, buckets: int):
    def flush(held: list[list]) -> Iterator[pa.RecordBatch]:
        """Empties held. All places of a seed are in one part."""
        columns = []
        for x in held:
            columns.append(np.concatenate(x))
            x.clear()
        part = (columns[0] % np.uint64(buckets) % np.uint64(PARTS)).astype(np.uint8)
        for p in range(PARTS):
            here = np.flatnonzero(part == p)
            if len(here):
                yield from linked(*_sorted(*(x[here] for x in columns)))

    def linked(h: np.ndarray, doc: np.ndarray, uid: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.arange(len(h))
        first = np.maximum.accumulate(np.where(_runs_of(h), at, 0))
        number = _number(_runs_of(h, uid))
        own = uid == uid[first]
        of = (h[own] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        cuts = np.flatnonzero(_runs_of(of[order]))
        ends = np.append(cuts, len(order))
        packed = [pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(x.itemsize * ends), pa.py_buffer(np.ascontiguousarray(x[own][order]))]).cast(pa.binary()) for x in (h, doc, uid, pos)]
        names = _names(FOUND)
        none = [pa.nulls(len(cuts), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())]
        rows = pa.record_batch([pa.array(of[order][cuts]), *packed, *none], names=names)
        for at in range(0, len(cuts), 1024):
            yield rows.slice(at, 1024)
        mine = np.flatnonzero(~own)
        if len(mine):  # the n-th place goes to the holder's n-th, counted round, so a text that repeats itself keeps its order
            many = np.bincount(first[own], minlength=len(h))
            to = first[mine] + number[mine] % many[first[mine]]
            none = [pa.nulls(len(mine), pa.binary())] * 4
            links = (h[mine].view(np.int64), doc[mine], uid[mine], pos[mine], number[mine].astype(np.int32), doc[to], uid[to], pos[to])
            rows = pa.record_batch([pa.array(-1 - uid[mine] % buckets), *none, *(pa.array(x) for x in links)], names=names)
            for at in range(0, len(mine), 50_000):
                yield rows.slice(at, 50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [[], [], [], []], 0
        for batch in batches:
            data, offsets = tx.buffers(batch.column("text"))
            docs, uids = batch.column("doc_id").to_numpy(), batch.column("uid").to_numpy()
            for i, j in tx.blocks(offsets, SCANNED):
                h, at = tx.words(data, offsets[i : j + 1])
                place, value = seeds(h, at, k, w)
                row = np.searchsorted(at, place, side="right") - 1
                for x, y in zip(held, (value, docs[i:j][row], uids[i:j][row], (place - at[row]).astype(np.int32))):
                    x.append(y)
                size += len(place)
                if size > HELD:
                    yield from flush(held)
                    size = 0
        if size:
            yield from flush(held)

    return run


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket by bucket: for each task's holder of a seed its places and those of the first holder of all; links pass through."""
    links = _names(PAIRS)[:8]

    def pairs(h: np.ndarray, doc: np.ndarray, uid: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.arange(len(h))
        first = np.maximum.accumulate(np.where(_runs_of(h), at, 0))
        starts = np.flatnonzero(_runs_of(h, uid))
        n = np.diff(starts, append=len(h))
        later = uid[starts] != uid[first[starts]]
        if not later.any():
            return
        size_of = np.zeros(len(h), np.int64)
        size_of[starts] = n
        a, m = starts[later], n[later]
        g = first[a]
        gm = size_of[g]
        lists = []
        for begin, many in ((a, m), (g, gm)):
            cuts = np.concatenate(([0], np.cumsum(many)))
            lists.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(pos[np.repeat(begin - cuts[:-1], many) + np.arange(cuts[-1])])))
        none = pa.nulls(len(a), pa.int32())
        yield pa.record_batch([pa.array(h[a].view(np.int64)), pa.array(doc[a]), pa.array(uid[a]), none, none, pa.array(doc[g]), pa.array(uid[g]), none, *lists], names=_names(PAIRS))

    held: list[tuple] = []
    last = None
    for batch in batches:
        made = batch.column("seed").is_valid()
        done = batch.filter(made)
        if done.num_rows:
            none = pa.nulls(done.num_rows, pa.list_(pa.int32()))
            yield pa.record_batch([*(done.column(c) for c in links), none, none], names=_names(PAIRS))
        rest = batch.filter(pc.invert(made))
        bucket = rest.column("bucket").to_numpy()
        packed = [(*tx.buffers(rest.column(c)), t) for c, t in (("h", np.uint64), ("doc", np.int64), ("uids", np.int64), ("places", np.int32))]
        cuts = np.append(np.flatnonzero(_runs_of(bucket)), len(bucket)) if len(bucket) else []
        for i, j in pairwise(cuts):
            if held and bucket[i] != last:
                yield from pairs(*_sorted(*(np.concatenate(x) for x in zip(*held))))
                held = []
            last = bucket[i]
            held.append(tuple(np.frombuffer(data[at[i] : at[j]].tobytes(), t) for data, at, t in packed))
    if held:
        yield from pairs(*_sorted(*(np.concatenate(x) for x in zip(*held))))


class Fenwick:
    """Prefix maxima of (score, place)."""

    def __init__(self, n: int):
        self.best = [(-1e18, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def get(self, i: int) -> tuple[float, int]:
        """The best of places below i."""
        out = (-1e18, -1)
        while i > 0:
            if self.best[i] > out:
                out = self.best[i]
            i -= i & -i
        return out


def chain(blocks: list[tuple[int, int, int, int]], gap: float = 0.25) -> list[tuple[int, int, int, int, int, list]]:
    """Collinear chains of blocks (start, end, partner start, partner end), as spans, matched words and the blocks in order, the best first.

    A chain's score is its words less ``gap`` for each word skipped in either text.
    """
    if len(blocks) == 1:
        return [(*blocks[0], blocks[0][1] - blocks[0][0], blocks)]
    ends = sorted({b[3] for b in blocks})
    rank = {e: i for i, e in enumerate(ends)}
    tree = Fenwick(len(ends))
    score, back = [0.0] * len(blocks), [-1] * len(blocks)
    events = sorted([(b[0], 1, i) for i, b in enumerate(blocks)] + [(b[1], 0, i) for i, b in enumerate(blocks)])
    from bisect import bisect_right

    for _, begins, i in events:
        s, e, ps, pe = blocks[i]
        if begins:
            value, j = tree.get(bisect_right(ends, ps))
            value -= gap * (s + ps)
            score[i] = e - s
            if j >= 0 and value > 0:
                score[i], back[i] = e - s + value, j
        else:
            tree.put(rank[pe], (score[i] + gap * (e + pe), i))
    out, used = [], set()
    for i in sorted(range(len(blocks)), key=lambda i: -score[i]):
        path = []
        while i >= 0 and i not in used:
            path.append(i)
            used.add(i)
            i = back[i]
        if path:
            parts = [blocks[j] for j in reversed(path)]
            out.append((parts[0][0], parts[-1][1], parts[0][2], parts[-1][3], sum(b[1] - b[0] for b in parts), parts))
    return out


def _blocks(pos: np.ndarray, other: np.ndarray, k: int, reach: int) -> list[tuple[int, int, int, int]]:
    """Seeds on one diagonal that are near each other, as blocks that don't overlap their neighbours."""
    lean = other - pos
    order = np.lexsort((pos, lean))
    p, d = pos[order], lean[order]
    cut = np.append(True, (d[1:] != d[:-1]) | (p[1:] - p[:-1] > reach))
    starts = np.flatnonzero(cut)
    lasts = np.append(starts[1:], len(p)) - 1
    out = [(int(p[a]), int(p[b]) + k, int(p[a] + d[a]), int(p[b] + d[a]) + k) for a, b in zip(starts, lasts)]
    out.sort()
    for i, (x, y) in enumerate(pairwise(out)):  # seeds of neighbouring diagonals may share a few words
        over = max(x[1] - y[0], x[3] - y[2])
        if 0 < over < k and y[1] - y[0] > over:
            out[i + 1] = (y[0] + over, y[1], y[2] + over, y[3])
    return out


def touching(spans: list[tuple[int, int]], slack: int, least: int) -> list[bool]:
    """Which spans lie in a run of at least ``least`` words, when spans parted by at most ``slack`` words are united."""
    out, run, end, start = [False] * len(spans), [], 0, 0
    for i in [*sorted(range(len(spans)), key=lambda i: spans[i]), -1]:
        if run and (i < 0 or spans[i][0] - end > slack):
            if end - start >= least:
                for j in run:
                    out[j] = True
            run = []
        if i >= 0:
            start, end = (min(start, spans[i][0]), max(end, spans[i][1])) if run else spans[i]
            run.append(i)
    return out


def _chains(k: int, w: int, least: int):
    """Chains with each partner. Short ones stay if a document's chains with all partners may make up ``least`` words:
    alignment moves an end by MARGIN words at most, and spans TOUCH words apart count together. Equal words go on for
    less than w words beyond a chain's seeds, so chains farther apart than that on both sides don't touch."""
    slack = 2 * w + TOUCH
    names = ["doc_id", "uid", "start", "end", "partner_id", "partner_uid", "partner_start", "partner_end", "parts"]

    def of(table: pa.Table) -> list[tuple]:
        doc, uid, pos, pdoc, puid, ppos = (table[c].to_numpy() for c in _names(LINK))
        once = _runs_of(uid, puid, pos, ppos)  # rows that repeat a document link it again
        doc, uid, pos, pdoc, puid, ppos = (x[once] for x in (doc, uid, pos, pdoc, puid, ppos))
        pos, ppos = pos.astype(np.int64), ppos.astype(np.int64)
        cuts = np.flatnonzero(np.append(True, (uid[1:] != uid[:-1]) | (puid[1:] != puid[:-1])))
        ends = np.append(cuts[1:], len(uid))
        # the reach of all links with a partner holds every chain with it, whatever gaps the chain bridges
        group = np.cumsum(np.append(False, uid[cuts[1:]] != uid[cuts[:-1]])) << 40
        low, high = group + pos[cuts], group + pos[ends - 1] + k
        order = np.argsort(low, kind="stable")
        reach = np.maximum.accumulate(high[order])
        new = np.append(True, low[order][1:] > reach[:-1] + slack)
        first = np.flatnonzero(new)
        long = reach[np.append(first[1:], len(cuts)) - 1] - low[order][first] >= least - 2 * MARGIN
        keep = np.empty(len(cuts), bool)
        keep[order] = long[np.cumsum(new) - 1]
        out, mine = [], []
        for n, (a, b) in enumerate(zip(cuts, ends)):
            if keep[n]:
                for s, e, ps, pe, _, parts in chain(_blocks(pos[a:b], ppos[a:b], k, 4 * w)):
                    mine.append((doc[a], uid[a], s, e, pdoc[a], puid[a], ps, pe, [x for b in parts for x in (b[0], b[2], b[1] - b[0])]))
            if mine and (n + 1 == len(cuts) or uid[cuts[n + 1]] != uid[a]):
                good = touching([r[2:4] for r in mine], slack, least - 2 * MARGIN)
                out += [r for r, g in zip(mine, good) if g]
                mine = []
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None  # the last document's links may go on in the next batch

        def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if rows:
                kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            now = pa.Table.from_batches([batch])
            kept = now if kept is None else pa.concat_tables([kept, now]).combine_chunks()
            uid = kept["uid"].to_numpy()
            if not len(uid):
                continue
            cut = int(np.flatnonzero(uid == uid[-1])[0])
            if cut:
                yield from out(of(kept.slice(0, cut)))
                kept = kept.slice(cut)
        if kept is not None and kept.num_rows:
            yield from out(of(kept))

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes, 32 bits each, of the asked spans; a text comes once for each list of spans asked of it."""

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["uid", "from", "to", "words"])

    for batch in batches:
        data, offsets = tx.buffers(batch.column("text"))
        spans = batch.column("spans").to_pylist()
        out, size = [], 0
        for i, j in tx.blocks(offsets):
            h, at = tx.words(data, offsets[i : j + 1])
            short = (h >> np.uint64(32)).astype(np.uint32)
            for r in range(i, j):
                mine = short[at[r - i] : at[r - i + 1]]
                uid = batch.column("uid")[r].as_py()
                for s in spans[r]:
                    out.append((uid, s["from"], s["to"], mine[max(0, s["from"]) : s["to"]].tobytes()))
                    size += len(out[-1][3])
                    if size > SLICES:
                        yield made(out)
                        out, size = [], 0
        if out:
            yield made(out)


def common(a: list[int], b: list[int], wide: int = 4096) -> int:
    """Length of the longest common subsequence, by bits (Hyyro, 2004); ``wide`` words of a at a time, whose carries go on to the
    next ones, so that memory stays small for long spans."""
    carries, total = bytearray(len(b)), 0
    for at in range(0, len(a), wide):
        part = a[at : at + wide]
        where: dict[int, int] = {}
        for i, x in enumerate(part):
            where[x] = where.get(x, 0) | 1 << i
        full = (1 << len(part)) - 1
        row = full
        for j, x in enumerate(b):
            hit = row & where.get(x, 0)
            if hit or carries[j]:
                added = row + hit + carries[j]
                carries[j] = added >> len(part)
                row = (added | (row - hit)) & full
        total += len(part) - row.bit_count()
    return total


def _runs(a: np.ndarray, b: np.ndarray, parts: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The runs of equal words in blocks (start in a, start in b, length), in order and apart in both texts."""
    out, x, y = [], 0, 0
    for s, ps, n in parts:
        skip = max(0, x - s, y - ps)
        s, ps, n = s + skip, ps + skip, n - skip
        if n <= 0:
            continue
        same = np.concatenate(([False], a[s : s + n] == b[ps : ps + n], [False]))
        edge = np.flatnonzero(same[1:] != same[:-1]).tolist()
        out += [(s + i, ps + i, j - i) for i, j in zip(edge[::2], edge[1::2])]
        x, y = s + n, ps + n
    return out


def _ahead(same: np.ndarray) -> int:
    """How far to go on: to where equal words outweigh four times the differing ones by most."""
    if not len(same):
        return 0
    score = np.cumsum(np.where(same, 1, -4))
    best = int(score.argmax())
    return best + 1 if score[best] > 0 else 0


def aligned_parts(a: np.ndarray, b: np.ndarray, parts: list[tuple[int, int, int]], identity: float) -> list[tuple[int, int, int, int, int]]:
    """Spans of a and b with their common words, at least ``identity`` of the longer: the chain as a whole if it is
    alike enough, else what is left of it when it is split at its widest gap, again and again, down to single runs of
    equal words. A chain's ends are extended as far as words are equal, and beyond differing words if enough equal ones follow."""

    def span(i: int, j: int) -> tuple[int, int, int, int]:
        s, ps = runs[i][:2]
        e, pe = runs[j][0] + runs[j][2], runs[j][1] + runs[j][2]
        low, plow = (runs[i - 1][0] + runs[i - 1][2], runs[i - 1][1] + runs[i - 1][2]) if i else (0, 0)
        high, phigh = runs[j + 1][:2] if j + 1 < len(runs) else (len(a), len(b))
        while s > low and ps > plow and a[s - 1] == b[ps - 1]:
            s, ps = s - 1, ps - 1
        while e < high and pe < phigh and a[e] == b[pe]:
            e, pe = e + 1, pe + 1
        # beyond differing words, if enough equal ones follow
        n = min(MARGIN, s - low, ps - plow)
        more = _ahead(a[s - n : s][::-1] == b[ps - n : ps][::-1])
        s, ps = s - more, ps - more
        n = min(MARGIN, high - e, phigh - pe)
        more = _ahead(a[e : e + n] == b[pe : pe + n])
        return s, e + more, ps, pe + more

    def matched(i: int, j: int, s: int, e: int, ps: int, pe: int) -> int:
        """Common words in order: the runs, and the longest common subsequences between them and at the ends."""
        same = sum(r[2] for r in runs[i : j + 1])
        x, y = s, ps
        for t, u, n in [*runs[i : j + 1], (e, pe, 0)]:
            if t > x and u > y:
                same += common(a[x:t].tolist(), b[y:u].tolist())
            x, y = t + n, u + n
        return same

    runs = _runs(a, b, parts)
    out, left = [], [(0, len(runs) - 1)] if runs else []
    while left:
        i, j = left.pop()
        s, e, ps, pe = span(i, j)
        longer = max(e - s, pe - ps)
        if min(e - s, pe - ps) >= identity * longer:
            same = matched(i, j, s, e, ps, pe)
            if same >= identity * longer:
                out.append((s, e, ps, pe, same))
                continue
        widest = max(range(i, j), key=lambda t: max(runs[t + 1][0] - runs[t][0], runs[t + 1][1] - runs[t][1]) - runs[t][2])
        left += [(widest + 1, j), (i, widest)]
    return out


def _align(identity: float, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                a, b = np.frombuffer(r["left"], np.uint32), np.frombuffer(r["right"], np.uint32)
                base, other = max(0, r["start"] - MARGIN), max(0, r["partner_start"] - MARGIN)
                flat = r["parts"]
                parts = [(s - base, ps - other, n) for s, ps, n in zip(flat[::3], flat[1::3], flat[2::3])]
                for s, e, ps, pe, same in aligned_parts(a, b, parts, identity):
                    if e - s >= least:
                        out.append((r["doc_id"], r["uid"], base + s, base + e, r["partner_id"], other + ps, other + pe, same, same / max(e - s, pe - ps)))
            if out:
                kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["doc_id", "uid", "doc_start", "doc_end", "partner_id", "partner_start", "partner_end", "matched", "identity"])

    return run


def uid_of() -> F.Column:
    """Names a document by its doc_id and text; rows that repeat both are one document."""
    return F.xxhash64("doc_id", "text")


def repeated_passages(docs: DataFrame, *, k: int = 6, w: int = 6, min_words: int = 50, identity: float = 0.8) -> DataFrame:
    """Passages of at least ``min_words`` words that an earlier document (by doc_id) also has.

    docs needs doc_id and text; other columns are ignored. Words are runs without ASCII white space, A-Z folded. A
    document's spans with several partners count together where they touch. Returns doc_id, uid, doc_start and
    doc_end (words, end exclusive), partner_id, partner_start, partner_end, matched (words in the longest common
    subsequence), identity (matched by the longer span, at least ``identity``). The first holder of a passage stands
    as partner only. Rows with a null doc_id or text, and texts of fewer than k words, take no part; rows that repeat
    doc_id and text are one document. Repeats within a document are not passages, but every copy in it of an earlier
    document's passage is one. An empty table gives no rows.
    """
    spark = docs.sparkSession
    store = Scratch(spark, "substring")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null").withColumn("uid", uid_of())
    # about a word for every six bytes, and two seeds for every w + 1 words
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, size // (3 * (w + 1) * BUCKET), 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = docs.mapInArrow(tx.lean(_scan(k, w, buckets)), FOUND)
    ordered = found.repartition(F.col("bucket")).sortWithinPartitions("bucket")
    mixed = store.save(ordered.mapInArrow(tx.lean(_resolve), PAIRS))
    pairs, local = mixed.where("places is not null"), mixed.where("places is null")
    nth = lambda n: F.get("partner_places", n % F.size("partner_places"))
    across = pairs.select("doc_id", "uid", F.posexplode("places").alias("number", "pos"), "partner_id", "partner_uid", "partner_places")
    across = across.select("doc_id", "uid", "pos", "partner_id", "partner_uid", nth(F.col("number")).alias("partner_pos"))
    to = pairs.select("seed", F.col("uid").alias("holder"), F.col("partner_id").alias("first_id"), F.col("partner_uid").alias("first_uid"), "partner_places")
    moved = local.drop("places", "partner_places").withColumn("holder", F.col("partner_uid")).join(to, ["seed", "holder"], "left")
    moved = moved.select("doc_id", "uid", "pos", *(F.coalesce(x, y).alias(y) for x, y in (("first_id", "partner_id"), ("first_uid", "partner_uid"))), F.coalesce(nth(F.col("number")), "partner_pos").alias("partner_pos"))
    links = across.union(moved)
    chains = links.repartition(F.col("uid")).sortWithinPartitions("uid", "partner_uid", "pos", "partner_pos").mapInArrow(tx.lean(_chains(k, w, min_words)), "doc_id long, uid long, start int, end int, partner_id long, partner_uid long, partner_start int, partner_end int, parts array<int>")
    chains = store.save(chains)

    sides = [chains.select(F.col(u).alias("uid"), F.greatest(F.lit(0), F.col(s) - MARGIN).alias("from"), (F.col(e) + MARGIN).alias("to")) for u, s, e in (("uid", "start", "end"), ("partner_uid", "partner_start", "partner_end"))]
    asked = sides[0].union(sides[1]).distinct()
    asked = store.save(asked)
    # lists of at most about ASKED spans; a document that is asked for more is read several times
    many = if_small(store.save(asked.groupBy("uid").count().where(F.col("count") > ASKED).select("uid", F.ceil(F.col("count") / ASKED).alias("lists"))))
    dealt = asked.join(many, "uid", "left").withColumn("list", F.pmod(F.xxhash64("from", "to"), F.coalesce("lists", F.lit(1))))
    wanted = store.save(dealt.groupBy("uid", "list").agg(F.collect_list(F.struct("from", "to")).alias("spans")).drop("list"))
    uids = if_small(store.save(asked.select("uid").distinct()))
    texts = docs.select("uid", "text").join(uids, "uid", "left_semi").groupBy("uid").agg(F.first("text").alias("text"))
    slices = store.save(texts.join(wanted, "uid").mapInArrow(tx.lean(_slices), "uid long, from int, to int, words binary"))
    mine = slices.select(F.col("uid"), F.col("from"), F.col("to"), F.col("words").alias("left"))
    both = chains.withColumn("from", F.greatest(F.lit(0), F.col("start") - MARGIN)).withColumn("to", F.col("end") + MARGIN).join(mine, ["uid", "from", "to"]).drop("from", "to")
    # a partner's span that more than SHARED chains have is copied, once for every SHARED of them
    span = ["partner_uid", "partner_from", "partner_to"]
    both = both.withColumn("partner_from", F.greatest(F.lit(0), F.col("partner_start") - MARGIN)).withColumn("partner_to", F.col("partner_end") + MARGIN)
    ends = chains.select("partner_uid", F.greatest(F.lit(0), F.col("partner_start") - MARGIN).alias("partner_from"), (F.col("partner_end") + MARGIN).alias("partner_to"))
    hot = if_small(store.save(ends.groupBy(*span).count().where(F.col("count") > SHARED).select(*span, F.ceil(F.col("count") / SHARED).cast("int").alias("copies"))))
    copies = F.coalesce("copies", F.lit(1))
    theirs = slices.select(F.col("uid").alias(span[0]), F.col("from").alias(span[1]), F.col("to").alias(span[2]), F.col("words").alias("right"))
    theirs = theirs.join(hot, span, "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")
    both = both.join(hot, span, "left").withColumn("copy", F.pmod(F.xxhash64("uid", "start"), copies).cast("int")).join(theirs, [*span, "copy"])
    both = both.select("doc_id", "uid", "start", "end", "partner_id", "partner_start", "partner_end", "parts", "left", "right")
    aligned = store.save(both.mapInArrow(tx.lean(_align(identity, k)), "doc_id long, uid long, doc_start int, doc_end int, partner_id long, partner_start int, partner_end int, matched int, identity double"))

    from pyspark.sql import Window

    along = Window.partitionBy("uid").orderBy("doc_start", "doc_end", "partner_id", "partner_start")
    reach = F.max("doc_end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    marked = aligned.withColumn("fresh", (F.coalesce(reach, F.lit(-9)) + TOUCH < F.col("doc_start")).cast("int")).withColumn("run", F.sum("fresh").over(along))
    whole = Window.partitionBy("uid", "run")
    kept = marked.withColumn("words", F.max("doc_end").over(whole) - F.min("doc_start").over(whole)).where(F.col("words") >= min_words)
    return store.finish(kept.select("doc_id", "uid", "doc_start", "doc_end", "partner_id", "partner_start", "partner_end", "matched", "identity"))


def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the words of their spans; white space before a span stays, that after its words goes."""
    out = []
    for text, cuts in zip(texts, spans):
        raw = np.frombuffer(text.encode(), np.uint8)
        starts, _, _ = tx.runs(raw, np.array([0, len(raw)]))
        keep = np.ones(len(raw), bool)
        edge = np.append(starts, len(raw))
        for a, b in cuts:
            keep[edge[min(a, len(starts))] : edge[min(b, len(starts))]] = False
        out.append(raw[keep].tobytes().decode("utf-8", "replace"))
    return pd.Series(out, dtype=object)


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """docs without the passages that repeated_passages found in them: texts are cut, n_chars follows if it is there,
    and a document with no word left goes. All columns stay; documents without passages are untouched."""
    name, cuts = free_name(docs, "_q_uid"), free_name(docs, "_q_spans")
    spans = passages.groupBy(F.col("uid").alias(name)).agg(F.collect_set(F.array("doc_start", "doc_end")).alias(cuts))
    spans = if_small(Scratch(docs.sparkSession, "spans").save(spans))
    named = docs.withColumn(name, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    cut = F.pandas_udf(_cut, "string").asNondeterministic()  # else the filter below gets a call of its own, in workers of its own
    hit = named.join(spans, name).withColumn("text", cut(F.col("text").cast("string"), cuts))
    if "n_chars" in docs.columns:
        hit = hit.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    hit = hit.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return named.join(spans, name, "left_anti").select(docs.columns).union(hit.select(docs.columns))
