"""Exact top-k inner-product search with a pivot-distance index.

Vectors get one more component so that all have the same length; the nearest of these in Euclidean distance then has
the largest inner product. Pivots are fitted on a bounded sample. The index keys every vector by its nearest pivot
and its distance to it; sorted by that key it is cut into blocks, each an annulus around one pivot.

A query first searches the annuli around its nearest pivot that are nearest to its own distance, which gives a bound on its
k-th score and so a radius. Then annuli are expanded on both sides of its distance to every pivot, and only rows
whose distance differs from the query's by no more than the radius are scored: by the triangle inequality no other
row can be nearer. Scores are exact integers. Queries travel in blocks, so that no side has to be small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm import text as tx
from quillspark.llm.learn import by_hash
from quillspark.llm.store import Scratch, if_small

#: Rows of an index block and of a query block.
BLOCK, QUERIES = 2048, 1024
#: Index blocks of a part, and query blocks that one copy of a part serves.
PART, WAVES = 32, 128


def _unpack(rows: list, width: int, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(b"".join(rows), kind).reshape(-1, width)


def distances(x: np.ndarray, longest: float, pivots: np.ndarray) -> np.ndarray:
    """Distances of lengthened vectors to the pivots, which have one component more."""
    x = x.astype(np.float64)
    more = np.sqrt(np.maximum(longest - (x * x).sum(1), 0))
    dot = x @ pivots[:, :-1].T + more[:, None] * pivots[:, -1]
    return np.sqrt(np.maximum(longest + (pivots * pivots).sum(1) - 2 * dot, 0))


def query_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """A query's further component is 0."""
    x = x.astype(np.float64)
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * x @ pivots[:, :-1].T, 0))


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; doubles hold them if they are small enough."""
    if len(q) and len(x) and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores, ties to the smaller id."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= least)
        score, ids = score[near], ids[near]
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


def fit_pivots(x: np.ndarray, longest: float, pivots: int) -> np.ndarray:
    """A few rounds of k-means from spread-out seeds, over lengthened sample vectors."""
    x = x.astype(np.float64)
    x = np.column_stack((x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0))))
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(1)
    chosen = x[rng.choice(len(x), min(pivots, len(x)), replace=False)]
    for _ in range(8):
        near = np.argmin((chosen * chosen).sum(1) - 2 * x @ chosen.T, 1)
        n = np.bincount(near, minlength=len(chosen))
        sums = np.column_stack([np.bincount(near, weights=c, minlength=len(chosen)) for c in x.T])
        chosen = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], chosen)
    return chosen


def widest(width: int) -> float:
    """Components below this have inner products below 2^62, so that longs and distances in doubles serve."""
    return float(int((2.0**62 / width) ** 0.5))


def search(vectors: DataFrame, is_query: Column, *, scale: int = 64, k: int = 20, pivots: int = 48, sample: int = 4096) -> DataFrame:
    """Each query's k best rows, its own row apart, by the inner product of floor(scale * x).

    vectors needs vec_id and embedding; other columns are ignored. is_query: a Boolean column over vec_id. Rows whose
    vec_id or vector is null, empty, or holds a null or non-finite component take no part. Rows with a component so
    large (2^28 for 64 components) that sums of products may pass 2^62 are not indexed: they meet all others in
    blocks, with integers of any size; a scaled component counts as at most the largest double, and a score beyond
    the range of a long as the nearest long. A query meets vectors of its own length only. Rows that repeat a
    vec_id stay several candidates, and queries of the same vec_id are one query if their vectors are equal; a
    candidate is a query's own row if it has its vec_id. Equal scores go to the smaller vec_id. Returns query_id,
    rank (from 1), vec_id, score; fewer than k rows where there are fewer candidates. An empty table gives none.
    pivots are fitted on at most ``sample`` distinct rows; every row is indexed.
    """
    store = Scratch(vectors.sparkSession, "pivot_search")
    top = float(np.finfo(np.float64).max)

    def scaled(v: Column) -> Column:
        x = F.greatest(F.lit(-top), F.least(F.lit(top), F.lit(float(scale)) * v.cast("double")))
        return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)  # larger doubles are whole

    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) <= top))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where((F.size("embedding") > 0) & F.coalesce(fine, F.lit(False)))
    clean = usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("is_query"), F.size("embedding").alias("width"), F.transform("embedding", scaled).alias("x"))
    most = F.floor(F.sqrt(F.lit(2.0**62) / F.col("width")))
    clean = store.save(clean.withColumn("far", F.array_max(F.transform("x", F.abs)) >= most))
    square = F.max(F.when(~F.col("far"), F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)))
    parts = []
    for r in clean.groupBy("width").agg(F.count_if(~F.col("far")).alias("near"), F.count_if("far").alias("far"), F.count_if(F.col("is_query")).alias("asked"), square.alias("longest")).orderBy("width").collect():
        rows = clean.where(F.col("width") == r["width"]).select("vec_id", "is_query", "far", "x")
        near, far = rows.where("not far"), rows.where("far")
        if r["near"]:
            parts.append(_search(store, near, r["width"], k, pivots, sample, r["near"], r["longest"]))
        if r["far"]:
            parts.append(_in_blocks(rows.where("is_query"), far, r["width"], k, r["far"]))
            parts.append(_in_blocks(far.where("is_query"), near, r["width"], k, r["near"]))
    if not parts:
        return store.finish(vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long"))
    hits = parts[0]
    for more in parts[1:]:
        hits = hits.union(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return store.finish(hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def _in_blocks(queries: DataFrame, rows: DataFrame, width: int, k: int, many: int) -> DataFrame:
    """(query_id, vec_id, score): each query's k best of each block of rows, by integers of any size."""

    def pack(size: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, size):
                    part = batch.slice(at, size)
                    yield pa.record_batch([pa.array([part.column("vec_id").to_numpy().tobytes()], pa.binary()), pa.array([part.column("x").flatten().to_numpy().tobytes()], pa.binary())], names=["ids", "x"])

        return run

    def whole(raw: bytes) -> np.ndarray:
        return np.array([int(v) for v in np.frombuffer(raw)], object).reshape(-1, width)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                qids, ids, x = np.frombuffer(r["qids"], np.int64), np.frombuffer(r["ids"], np.int64), whole(r["x"])
                found = []
                for qid, q in zip(qids, whole(r["q"])):
                    got = sorted(((-max(-(2**63), min(2**63 - 1, int(s))), int(i)) for s, i in zip(x @ q, ids) if i != qid))[:k]
                    found += [(int(qid), i, -s) for s, i in got]
                if found:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], names=["query_id", "vec_id", "score"])

    groups = -(-many // (16 * BLOCK))
    left = queries.select("vec_id", "x").distinct().mapInArrow(tx.lean(pack(64)), "ids binary, x binary").select(F.col("ids").alias("qids"), F.col("x").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    right = rows.select("vec_id", "x").mapInArrow(tx.lean(pack(512)), "ids binary, x binary").withColumn("part", F.pmod(F.hash("ids"), F.lit(groups)))
    return left.join(right, "part").drop("part").mapInArrow(tx.lean(meet), "query_id long, vec_id long, score long")


def _search(store: Scratch, rows: DataFrame, width: int, k: int, pivots: int, sample: int, total: int, longest: float) -> DataFrame:
    """(query_id, vec_id, score) of rows without far ones, the k best of every query among them."""
    spark = rows.sparkSession
    few = by_hash(rows.select(F.xxhash64("vec_id", "x").alias("o"), "x"), "o", sample, total).select("x").toArrow()
    centres = fit_pivots(few["x"].combine_chunks().flatten().to_numpy().reshape(-1, width), longest, pivots)
    shared = spark.sparkContext.broadcast((centres, longest))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, longest = shared.value
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().astype(np.int64).reshape(-1, width)
            d = distances(x, longest, centres)
            near = np.argmin(d, 1) if len(d) else np.empty(0, np.int64)
            yield pa.record_batch([batch.column("vec_id"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())], names=["vec_id", "pivot", "distance", "x"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows become blocks, none across two pivots; PART blocks in a row, of one pivot, are a part."""
        from pyspark import TaskContext

        name, last, held = TaskContext.get().partitionId() << 32, None, 0
        for batch in batches:
            pivot = batch.column("pivot").to_numpy()
            at = 0
            while at < len(pivot):
                to = min(int(np.searchsorted(pivot, pivot[at], side="right")), at + BLOCK)
                d = batch.column("distance").slice(at, to - at).to_numpy()
                if pivot[at] != last or held == PART:
                    name, last, held = name + 1, pivot[at], 0
                held += 1
                yield pa.record_batch([pa.array([name], pa.int64()), pa.array([pivot[at]], pa.int32()), pa.array([d[0]]), pa.array([d[-1]]), pa.array([d.tobytes()], pa.binary()), pa.array([batch.column("vec_id").slice(at, to - at).to_numpy().tobytes()], pa.binary()), pa.array([b"".join(batch.column("x").slice(at, to - at).to_pylist())], pa.binary())], names=["part", "pivot", "low", "high", "distances", "ids", "x"])
                at = to

    keyed = rows.select("vec_id", "x").mapInArrow(tx.lean(key), "vec_id long, pivot int, distance double, x binary")
    index = store.save(keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id").mapInArrow(tx.lean(pack), "part long, pivot int, low double, high double, distances binary, ids binary, x binary"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, _ = shared.value
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().astype(np.int64).reshape(-1, width)
            near = np.argmin(query_distances(x, centres), 1) if len(x) else np.empty(0, np.int64)
            yield pa.record_batch([batch.column("vec_id"), pa.array(near.astype(np.int32)), pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())], names=["query_id", "home", "q"])

    asked = store.save(rows.where("is_query").select("vec_id", "x").distinct().mapInArrow(tx.lean(ask), "query_id long, home int, q binary"))

    def probe(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        """Around a query's nearest pivot, the blocks whose annuli are nearest to its distance."""
        centres, _ = shared.value
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            q, ids = _unpack(left["q"].to_pylist(), width), left["query_id"].to_numpy()
            d = query_distances(q, centres)[:, keys[0].as_py()]
            low, high = right["low"].to_numpy(), right["high"].to_numpy()
            gap = np.maximum(np.maximum(low[None] - d[:, None], d[:, None] - high[None]), 0)
            nearest = np.argsort(gap, 1, kind="stable")[:, :2]
            for b in np.unique(nearest):
                mine = np.flatnonzero((nearest == b).any(1))
                row = right.slice(int(b), 1)
                others = np.frombuffer(row["ids"][0].as_py(), np.int64)
                got = scores(q[mine], _unpack(row["x"].to_pylist(), width))
                for i, s in zip(mine, got):
                    s, _ = best(s[others != ids[i]], others[others != ids[i]], k)
                    out.append((ids[i], left["q"][int(i)].as_py(), s.tolist()))
        return pa.table({"query_id": pa.array([o[0] for o in out], pa.int64()), "q": pa.array([o[1] for o in out], pa.binary()), "found": pa.array([o[2] for o in out], pa.list_(pa.int64()))})

    # a pivot's queries are dealt in groups, each with a few of the pivot's blocks around their distances
    homes = asked.groupBy("home").count()
    counted = homes.select(F.col("home").alias("of"), F.ceil(F.col("count") / QUERIES).alias("n_groups"))
    # homes and sizes have a row a pivot
    dealt = asked.join(F.broadcast(homes), "home").withColumn("part", F.pmod(F.xxhash64("query_id", "q"), F.ceil(F.col("count") / QUERIES))).select("home", "part", "query_id", "q")
    groups = F.broadcast(counted)
    # about 16 blocks of each pivot are enough to bound the k-th score
    sizes = index.groupBy("pivot").count().select(F.col("pivot").alias("of_pivot"), (F.col("count") / 16).cast("long").alias("step"))
    spaced = index.join(F.broadcast(sizes), F.col("pivot") == F.col("of_pivot")).where(F.pmod(F.xxhash64("ids"), F.greatest(F.lit(1), "step")) == 0)
    around = spaced.join(groups, F.col("pivot") == F.col("of")).select(F.col("of").alias("home"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_groups") - 1)).alias("part"), "low", "high", "ids", "x")
    seen = dealt.groupBy("home", "part").cogroup(around.groupBy("home", "part")).applyInArrow(probe, "query_id long, q binary, found array<long>")
    kth = seen.groupBy("query_id", "q").agg(F.sort_array(F.flatten(F.collect_list("found")), asc=False).alias("found"))
    bounded = store.save(asked.join(kth, ["query_id", "q"], "left").select("query_id", "q", F.when(F.size("found") >= k, F.get("found", F.lit(k - 1))).alias("bound")))

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of queries, once for each pivot that their radii reach."""
        centres, longest = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                part = batch.slice(at, QUERIES)
                q = _unpack(part.column("q").to_pylist(), width)
                ids = part.column("query_id").to_numpy()
                bound = part.column("bound").cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                norm = (q.astype(np.float64) ** 2).sum(1)
                radius = np.where(np.isfinite(bound), np.sqrt(np.maximum(norm + longest - 2 * np.where(np.isfinite(bound), bound, 0), 0)) * (1 + 1e-9) + 1e-6 * np.sqrt(longest + 1), np.inf)
                d = query_distances(q, centres)
                for p in range(len(centres)):
                    yield pa.record_batch([pa.array([p], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([q.tobytes()], pa.binary()), pa.array([(d[:, p] - radius).tobytes()], pa.binary()), pa.array([(d[:, p] + radius).tobytes()], pa.binary()), pa.array([float((d[:, p] - radius).min())]), pa.array([float((d[:, p] + radius).max())])], names=["pivot", "qids", "q", "from", "to", "least", "most"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for r in batch.to_pylist():
                d, ids, x = np.frombuffer(r["distances"]), np.frombuffer(r["ids"], np.int64), _unpack([r["x"]], width)
                qids, q = np.frombuffer(r["qids"], np.int64), _unpack([r["q"]], width)
                a, b = np.searchsorted(d, np.frombuffer(r["from"]), side="left"), np.searchsorted(d, np.frombuffer(r["to"]), side="right")
                live = np.flatnonzero(a < b)
                if not len(live):
                    continue
                first, last = a[live].min(), b[live].max()
                got = scores(q[live], x[first:last])
                for i, s in zip(live, got):
                    s, near = s[a[i] - first : b[i] - first], ids[a[i] : b[i]]
                    other = near != qids[i]
                    s, near = best(s[other], near[other], k)
                    found.append((np.full(len(s), qids[i]), near, s))
            if found:
                yield pa.record_batch([pa.array(np.concatenate([f[c] for f in found])) for c in range(3)], names=["query_id", "vec_id", "score"])

    # a wave of queries meets the parts of a pivot that its annulus touches, so that no key holds a pivot's whole rows;
    # a part that very many waves touch is copied, once for every WAVES of them
    waves = store.save(bounded.repartition(F.col("query_id")).mapInArrow(tx.lean(group), "pivot int, qids binary, q binary, `from` binary, `to` binary, least double, most double"))
    parts = store.save(index.groupBy("part").agg(F.first("pivot").alias("pivot"), F.min("low").alias("part_low"), F.max("high").alias("part_high")))
    touched = waves.join(if_small(parts), "pivot").where("part_low <= most and part_high >= least").drop("pivot", "part_low", "part_high")
    touched = store.save(touched.withColumn("copy", F.xxhash64("qids", "q")))
    copies = if_small(store.save(touched.groupBy("part").agg(F.ceil(F.count("*") / WAVES).cast("int").alias("copies"))))
    left = touched.join(copies, "part").withColumn("copy", F.pmod("copy", "copies").cast("int")).drop("copies")
    right = index.join(copies, "part").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies", "pivot")
    joined = left.join(right, ["part", "copy"]).where("low <= most and high >= least").drop("least", "most", "low", "high", "part", "copy")
    return joined.mapInArrow(tx.lean(expand), "query_id long, vec_id long, score long")
