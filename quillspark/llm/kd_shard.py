"""Sharding by a k-d tree over document metadata, cut at distributed weighted medians.

Rows of equal text are one group, and a group is one point: its weight is its bytes, its coordinates are metadata.
At each level every node is cut along its widest dimension where half of its bytes lie on either side, or as near to that as
whole points allow, until 2^depth leaves have their share or all leaves are down to the target bytes. Points that weigh more
than a small part of a leaf are dealt into pieces by a hash of doc_id first, rows that repeat all columns one by one, so a
group of any size is split no finer than balance needs, and every other group stays whole.

A cut is found by narrowing: a key of a point is its coordinate and then its text's digest, and three rounds of
histograms over 14 bits of the key each find the point where half of the weight is reached. Only histograms, at most
leaves x 16,384 rows, come to the driver; all nodes of a level share a round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.store import Scratch, if_small

BITS, ROUNDS = 14, 3
#: Keys have as many bits: a coordinate of 16 and a digest of 26.
DIGEST = 26


def _cuts(points: DataFrame, nodes: dict[int, tuple[str, float, float]], weights: dict[int, float]) -> dict[int, int]:
    """For each node the key up to which its points have nearest to half of its weight."""
    start = {n: 0 for n in nodes}
    before = {n: 0.0 for n in nodes}
    for r in range(ROUNDS):
        shift = BITS * (ROUNDS - 1 - r)
        inside = F.lit(False)
        for n, low in start.items():
            inside = inside | ((F.col("node") == n) & (F.shiftright("key", shift + BITS) == low))
        found = points.where(inside).groupBy("node", F.shiftright("key", shift).alias("bin")).agg(F.sum("weight").alias("weight")).orderBy("node", "bin").collect()
        for n in nodes:
            mine = [(x["bin"], x["weight"]) for x in found if x["node"] == n]
            half, so_far, chosen, w = weights[n] / 2, before[n], None, 0.0
            for b, w in mine:
                chosen = b
                if so_far + w >= half:
                    break
                so_far += w
            start[n] = chosen if chosen is not None else start[n] << BITS
            before[n] = so_far
            if not shift and 0 < so_far and half - so_far < so_far + w - half:
                start[n] -= 1  # without the point that crosses the half it is nearer
    return start


def shard(docs: DataFrame, *, depth: int = 4, target_bytes: int | None = None, dimensions: dict[str, Column] | None = None, grain: float = 0.005) -> DataFrame:
    """Puts all rows into 2^depth shards, 0 up, of nearly equal bytes; a row weighs its text's UTF-8 bytes plus 1.
    With target_bytes nodes are split until none holds more, unless a single point does; meant for up to some thousand shards.

    docs needs doc_id, text, lang and source; other columns are ignored. dimensions: named columns of docs that are
    numbers (default: log of the size, hashes of source and of lang, doc_id); a group takes the least of its rows',
    nulls count as 0. A group heavier than grain times a shard's share is dealt into pieces of at most about that
    weight by a hash of doc_id, lang and source, and by their place in the table if they repeat all of these; its pieces
    are neighbours in the tree, so it ends in two or more shards only where a cut falls between them. Any other group lies in one shard.
    Null texts have size 1 and are a group, as empty texts are another. Repeated rows are placed one by one. Returns
    doc_id, size, text_crc32 (null text: that of an empty text), law ('bytes'), shard, slot (gapless from 0 in each
    shard), grown_shard (null). An empty table gives no rows.
    """
    store = Scratch(docs.sparkSession, "kd_shard")
    dims = dimensions or {"x_size": F.log2(F.octet_length("text") + F.lit(2)), "x_source": F.pmod(F.xxhash64("source"), F.lit(1 << 16)), "x_lang": F.pmod(F.hash("lang"), F.lit(1 << 16)), "x_doc": F.col("doc_id")}
    payload = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = store.save(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(payload) + 1).cast("long").alias("size"), F.crc32(payload).alias("text_crc32"), F.xxhash64(payload, F.col("text").isNull()).alias("digest"), F.xxhash64("doc_id", "lang", "source").alias("mark"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_key"), F.monotonically_increasing_id().alias("place"),
            *(F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"_{k}") for k, c in dims.items()),
        )
    )
    names = [f"_{k}" for k in dims]
    groups = rows.groupBy("digest", "text_crc32").agg(F.sum("size").alias("bytes"), *(F.min(x).alias(x) for x in names))
    total = rows.agg(F.sum("size"), *(f(x) for x in names for f in (F.min, F.max))).first()
    all_bytes = total[0] or 0
    span = {x: (total[1 + 2 * i], total[2 + 2 * i]) for i, x in enumerate(names)}
    limit = max(1.0, grain * (target_bytes or all_bytes / 2**depth))
    heavy = store.save(groups.where(F.col("bytes") > limit).select("digest", "text_crc32", F.ceil(F.col("bytes") / limit).cast("long").alias("pieces")))
    # rows that repeat all columns are told apart by their place in the stored table
    same = ["digest", "text_crc32", "mark", "doc_key"]
    again = if_small(store.save(rows.groupBy(*same).count().where("count > 1").select(*same, F.lit(1).alias("again"))))
    marked = rows.join(again, same, "left").withColumn("copy", F.when(F.col("again") == 1, F.col("place")).otherwise(F.lit(0).cast("long")))
    piece = F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("mark", "doc_id", "copy"), F.coalesce("pieces", F.lit(1))))
    # at most all bytes / limit groups can be heavy
    placed = store.save(marked.join(if_small(heavy), ["digest", "text_crc32"], "left").withColumn("piece", piece).drop("pieces", "again", "place", "doc_key"))
    keep = ["digest", "text_crc32", "piece"]
    points = placed.groupBy(*keep).agg(F.sum("size").cast("double").alias("weight"), *(F.min(x).alias(x) for x in names))
    corner = points.groupBy("digest", "text_crc32").agg(*(F.min(x).alias(f"g{x}") for x in names))
    # the pieces of a group share its coordinates and so lie side by side
    points = store.save(points.join(corner, ["digest", "text_crc32"]).select(*keep, "weight", *(F.col(f"g{x}").alias(x) for x in names)))
    # with a target nodes are named by their path after a leading 1
    points = points.withColumn("node", F.lit(1 if target_bytes else 0).cast("long"))
    for _ in range(depth if target_bytes is None else 40):
        after = _split(store, points, names, span, target_bytes or 0)
        if after is None:
            break
        points = after
    leaf = points.select(*keep, "node")
    if target_bytes is None:
        leaf = leaf.withColumnRenamed("node", "shard")
    else:  # nodes are cut to different depths: number the leaves in order
        leaves = sorted((r["node"] for r in leaf.select("node").distinct().collect()), key=bin)
        numbers = docs.sparkSession.createDataFrame([(n, i) for i, n in enumerate(leaves)], "node long, shard int")
        leaf = leaf.join(F.broadcast(numbers), "node").drop("node")
    sharded = store.save(placed.join(leaf, keep).select("doc_id", "size", "text_crc32", "mark", "copy", "shard"))
    return store.finish(_slots(sharded))


def _split(store: Scratch, points: DataFrame, names: Sequence[str], span: dict, target: int) -> DataFrame | None:
    """One level of the tree: the points, each with its child node; None if no node of several points is over the target."""
    about = points.groupBy("node").agg(F.sum("weight").alias("weight"), F.count("*").alias("points"), *(f(x) for x in names for f in (F.min, F.max))).collect()
    nodes, weights = {}, {}
    for r in about:
        if target and (r["weight"] <= target or r["points"] == 1):
            continue
        widths = []
        for i, x in enumerate(names):
            low, high = r[3 + 2 * i], r[4 + 2 * i]
            whole = span[x][1] - span[x][0]
            widths.append(((high - low) / whole if whole else 0.0, -i, x, low, high))
        _, _, x, low, high = max(widths)
        nodes[r["node"]], weights[r["node"]] = (x, low, high), r["weight"]
    if not nodes:
        return None if target else points
    place = F.lit(0.0)
    for n, (x, low, high) in nodes.items():
        place = F.when(F.col("node") == n, F.least(F.lit(1.0), (F.col(x) - low) / (high - low)) if high > low else F.lit(0.0)).otherwise(place)
    fine = F.floor(place * ((1 << (BITS * ROUNDS - DIGEST)) - 1)).cast("long")
    # a group's digest decides among equal coordinates, and its pieces follow each other
    inner = F.shiftright(F.xxhash64("digest", "text_crc32").bitwiseAND((1 << 62) - 1), 62 - DIGEST + 10) * 1024 + F.pmod("piece", F.lit(1024))
    keyed = store.save(points.withColumn("key", F.shiftleft(fine, DIGEST) + inner))
    cuts = _cuts(keyed, nodes, weights)
    child = F.col("node") if target else F.col("node") * 2
    for n, cut in cuts.items():
        child = F.when(F.col("node") == n, F.col("node") * 2 + F.when(F.col("key") > cut, 1).otherwise(0)).otherwise(child)
    return keyed.withColumn("node", child).drop("key")


def _slots(sharded: DataFrame, rows: int = 20_000) -> DataFrame:
    """Numbers each shard's rows in two steps, buckets of about ``rows`` rows and places in them, so that no task holds a shard."""
    spark = sharded.sparkSession
    buckets = max(1, sharded.count() // (16 * rows))
    dealt = sharded.withColumn("bucket", F.pmod(F.xxhash64("mark", "doc_id", "text_crc32", "copy", F.lit(7)), F.lit(buckets)))
    sizes = dealt.groupBy("shard", "bucket").count().orderBy("shard", "bucket").collect()
    offsets, so_far = [], {}
    for r in sizes:
        offsets.append((r["shard"], r["bucket"], so_far.get(r["shard"], 0)))
        so_far[r["shard"]] = so_far.get(r["shard"], 0) + r["count"]
    from pyspark.sql import Window

    table = spark.createDataFrame(offsets, "shard int, bucket long, before long")
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "mark", "text_crc32", "size", "copy")) - 1
    out = dealt.withColumn("shard", F.col("shard").cast("int")).withColumn("inside", inside).join(F.broadcast(table), ["shard", "bucket"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("inside")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
