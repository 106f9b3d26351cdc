"""Operators of the corpus build: who is accepted, what is joined to it, and what its lists and pages show."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import fold
from quillspark.operators.relational import dense_ids

UNKNOWN = "Unknown"


def accepted(rows: DataFrame, key: str, decision: str, poster: str, withdrawn: DataFrame) -> DataFrame:
    """Rows with a key and a poster number that are neither marked ``Withdrawn``, exactly, nor listed in ``withdrawn`` (key).
    Poster numbers become integers; one that isn't a number is an error."""
    kept = rows.where(F.col(key).isNotNull() & ~F.col(decision).eqNullSafe("Withdrawn")).join(withdrawn.select(key), key, "left_anti").where(F.coalesce(poster, F.lit("")) != "")
    number = F.when(F.col(poster).rlike("^[0-9]+$"), F.col(poster).cast("int")).otherwise(F.raise_error(F.concat(F.lit("poster number is no number: "), poster)).cast("int"))
    return kept.withColumn(poster, number)


def not_withdrawn(rows: DataFrame, decision: str) -> DataFrame:
    """Rows whose decision, trimmed and whatever its case, isn't withdrawn; a missing decision is none."""
    return rows.where(F.lower(F.trim(F.coalesce(decision, F.lit("")))) != "withdrawn")


def saved_scope(items: DataFrame, corpus: DataFrame) -> DataFrame:
    """(kind, id, shown): saved items, each with whether the corpus (kind, id) has it. An item saved twice counts once."""
    return items.select("kind", "id").distinct().join(corpus.select("kind", "id").distinct().withColumn("_there", F.lit(True)), ["kind", "id"], "left").select("kind", "id", F.coalesce("_there", F.lit(False)).alias("shown"))


def hidden_summary(scope: DataFrame) -> DataFrame:
    """(hidden, kinds): how many saved items aren't shown, and of which kinds."""
    gone = scope.where("not shown")
    return gone.agg(F.count("*").alias("hidden"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"))


def pick_list(rows: DataFrame, cluster: str, titles: DataFrame, query: str = "") -> DataFrame:
    """(cluster, title, n): clusters with their rows counted whose title holds the query, accents and case apart; the largest
    first, then by title. titles: (cluster, title)."""
    n = rows.groupBy(cluster).agg(F.count("*").alias("n"))
    named = F.broadcast(n).join(titles, cluster)
    return named.where(fold(F.col("title")).contains(fold(F.lit(query)))).select(cluster, "title", "n").orderBy(F.desc("n"), "title")


def backdrop(rows: DataFrame, year: str, years: tuple[int, int] | None, cluster: str, clusters: list | None, shown: bool = True) -> DataFrame:
    """Rows of a backdrop: years from and to, both included, and clusters, None for any; nothing if its switch is off."""
    if not shown:
        return rows.limit(0)
    if years is not None:
        rows = rows.where(F.col(year).between(*years))
    return rows if clusters is None else rows.where(F.col(cluster).isin(clusters))


def up_to_level(points: DataFrame, level: str, cap: int) -> DataFrame:
    """Points of the levels up to the cap, and those without a level."""
    return points.where((F.col(level) <= cap) | F.col(level).isNull())


def category_records(rows: DataFrame, key: str, decision: str, title: str, categories: str) -> DataFrame:
    """(key, decision, title, parent, exact) of posters and talks; categories is an array of the category and its subcategory."""
    kept = rows.where(F.col(key).isNotNull()).withColumn(decision, F.trim(decision)).where(F.col(decision).isin("Poster", "Oral"))
    part = lambda i: F.coalesce(F.nullif(F.get(categories, F.lit(i)), F.lit("")), F.lit(UNKNOWN))
    return kept.select(key, decision, F.trim(F.coalesce(title, F.lit(""))).alias("title"), part(0).alias("parent"), F.concat_ws(" :: ", part(0), part(1)).alias("exact"))


def topic_parent(values: Column) -> Column:
    return F.coalesce(F.get(values, F.lit(0)), F.lit(UNKNOWN))


def topic_subcategory(values: Column) -> Column:
    """The second value, else the first."""
    return F.coalesce(F.get(values, F.lit(1)), F.get(values, F.lit(0)), F.lit(UNKNOWN))


def facet_values(first: Column, second: Column) -> Column:
    """Distinct values of a primary and a secondary topic, missing ones left out, in order."""
    return F.array_distinct(F.array_compact(F.array(first, second)))


def with_defaults(rows: DataFrame, key: str, parts: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rows with a column from each part (key, value); a key that a part doesn't have gets the part's default. parts: name ->
    (table, default). Tables have a row a key at most."""
    for name, (table, default) in parts.items():
        rows = rows.join(table.select(F.col(key), F.col("value").alias(name)), key, "left").withColumn(name, F.coalesce(F.col(name), default))
    return rows


def members(rows: DataFrame, key: str, accepted_ids: DataFrame) -> DataFrame:
    """Rows that belong to an accepted id."""
    return rows.join(accepted_ids.select(key).distinct(), key, "left_semi")


def labels_in_use(rows: DataFrame, cluster: str, labels: DataFrame) -> DataFrame:
    """The clusters that rows have, with their labels if the label table has them."""
    return rows.where(F.col(cluster).isNotNull()).select(cluster).distinct().join(labels, cluster, "left")


def cells(ids: DataFrame, key: str, wide: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each id with the columns of its wide row, -1 where it has none."""
    return ids.join(wide.select(key, *columns), key, "left").select(key, *(F.coalesce(c, F.lit(-1)).alias(c) for c in columns))


def rollup_all(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Every table (key, value) side by side, a column each; a key that any table has gets a row. Tables are united first, so
    keys are shuffled once however many tables there are."""
    every = reduce(DataFrame.union, [t.select(key, F.lit(n).alias("_name"), F.col("value").cast("double").alias("_value")) for n, t in tables.items()])
    return every.groupBy(key).agg(*(F.max(F.when(F.col("_name") == n, F.col("_value"))).alias(n) for n in tables))


def mean_vectors(tables: list[DataFrame], key: str, vector: str) -> DataFrame:
    """(key, vector, parts): the mean of a key's vectors over the tables that have it, scaled to length 1, and how many have it."""
    flat = reduce(DataFrame.union, [t.where(F.col(vector).isNotNull()).select(key, F.posexplode(vector).alias("pos", "x")) for t in tables])
    mean = flat.groupBy(key, "pos").agg(F.avg("x").alias("x"), F.count("*").alias("n")).groupBy(key)
    out = mean.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("m"), F.max("n").alias("parts"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("size"))
    return out.select(key, F.transform("m", lambda x: x / F.when(F.col("size") == 0, 1.0).otherwise(F.col("size"))).alias(vector), "parts")


def label_of(clusters: DataFrame, cluster: str, sources: list[DataFrame]) -> DataFrame:
    """(cluster, label): from the first source (cluster, label) that has one that isn't blank."""
    out = clusters.select(cluster).distinct()
    for i, s in enumerate(sources):
        out = out.join(F.broadcast(s.select(cluster, F.nullif(F.trim("label"), F.lit("")).alias(f"_{i}"))), cluster, "left")
    return out.select(cluster, F.coalesce(*(f"_{i}" for i in range(len(sources)))).alias("label"))


def state_mismatches(left: DataFrame, right: DataFrame) -> DataFrame:
    """(artifact, left, right) where two tables (artifact, state) don't agree; a missing one is null."""
    both = left.select("artifact", F.col("state").alias("left")).join(right.select("artifact", F.col("state").alias("right")), "artifact", "full_outer")
    return both.where(~F.col("left").eqNullSafe(F.col("right")))


def by_author(rows: DataFrame, authors: str, chips: list[str]) -> DataFrame:
    """Rows with an author whose name is one of the chips, accents, case and outer spaces apart; no chips, no filter."""
    if not chips:
        return rows
    wanted = F.array(*(F.trim(fold(F.lit(c))) for c in chips))
    return rows.where(F.arrays_overlap(F.transform(authors, lambda a: F.trim(fold(a))), wanted))


def cluster_labels(rows: DataFrame, cluster: str, topics: DataFrame) -> DataFrame:
    """Rows with the label of their cluster: its title, else its first three keywords, else its number. topics: (cluster, title,
    keywords). Rows of other clusters are dropped."""
    words = F.when(F.size("keywords") > 0, F.array_join(F.slice("keywords", 1, 3), ", "))
    label = F.coalesce(F.nullif("title", F.lit("")), words, F.concat(F.lit("cluster "), F.col(cluster)))
    return rows.join(F.broadcast(topics.select(cluster, label.alias("label"))), cluster)


def most_similar(rows: DataFrame, key: str, neighbours: str, corpus: DataFrame, most: int = 10) -> DataFrame:
    """(key, place, id, title): of a row's first ``most`` neighbours those that the corpus (id, title) has, in order."""
    near = rows.select(key, F.posexplode(F.slice(neighbours, 1, most)).alias("place", "id"))
    return near.join(corpus.select("id", "title"), "id").select(key, "place", "id", "title")


def recounted(references: DataFrame, uses: DataFrame, key: str) -> DataFrame:
    """References that something uses, with the number of their distinct users; uses: (key, user)."""
    return references.drop("uses").join(uses.groupBy(key).agg(F.countDistinct("user").alias("uses")), key)


def related(cells: DataFrame, focus: int, corpus: DataFrame, farthest: bool = False) -> DataFrame:
    """(id, least, mean, cells) of a focused row's neighbours over all cells (cell, id, neighbour, distance) that the corpus (id)
    has: the nearest by their least distance, the farthest by their mean one, then by the number of cells."""
    mine = cells.where(F.col("id") == focus).groupBy(F.col("neighbour").alias("id")).agg(F.min("distance").alias("least"), F.avg("distance").alias("mean"), F.count("*").alias("cells"))
    order = [F.desc("mean")] if farthest else [F.asc("least")]
    return mine.join(corpus.select("id"), "id", "left_semi").orderBy(*order, F.desc("cells"), "id")


def discoverability(rows: DataFrame, label: str, session: str, pairs: DataFrame) -> DataFrame:
    """(session, outside, paired, found): of a session's rows the mean number of rows of their label outside the session and in
    the session paired with it, and the share of rows whose label the paired session has. pairs: (session, paired)."""
    here = rows.groupBy(label, session).agg(F.count("*").alias("n"))
    total = here.groupBy(label).agg(F.sum("n").alias("total"))
    there = here.select(label, F.col(session).alias("paired"), F.col("n").alias("there"))
    each = here.join(total, label).join(F.broadcast(pairs), session).join(there, [label, "paired"], "left").withColumn("there", F.coalesce("there", F.lit(0)))
    mean = lambda c: F.sum(F.col("n") * c) / F.sum("n")
    return each.groupBy(session).agg(mean(F.col("total") - F.col("n")).alias("outside"), mean(F.col("there")).alias("paired"), mean((F.col("there") > 0).cast("int")).alias("found"))


def session_summary(rows: DataFrame, session: str, label: str, sessions: DataFrame) -> DataFrame:
    """(session, label, n): rows of each session by label; a session without rows has one row, without a label and 0."""
    counts = rows.groupBy(session, label).agg(F.count("*").alias("n"))
    return sessions.select(session).distinct().join(counts, session, "left").select(session, label, F.coalesce("n", F.lit(0)).alias("n"))


def telemetry(runs: DataFrame, component: str, sums: list[str], failed: str, most: float) -> DataFrame:
    """(component, runs, sums..., failures, rate, over): totals of a run's components, and whether too many of them failed."""
    out = runs.groupBy(component).agg(F.count("*").alias("runs"), *(F.sum(c).alias(c) for c in sums), F.count_if(failed).alias("failures"))
    return out.withColumn("rate", F.col("failures") / F.col("runs")).withColumn("over", F.col("rate") > most)


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only one of two sets has, missing or extra; equal sets give none."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("missing")).union(b.exceptAll(a).withColumn("side", F.lit("extra")))


def selected(corpora: dict[str, DataFrame], kind: str, value: int) -> DataFrame:
    """The one row that a click on (kind, id) means, of its own corpus; nothing for another kind or id."""
    first = next(iter(corpora.values()))
    return corpora[kind].where(F.col("id") == value).limit(1) if kind in corpora else first.limit(0)


def shuffled(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in an order that the seed alone decides, with a place by which it can be repeated."""
    return rows.withColumn("rank", F.xxhash64(F.col(key), F.lit(seed))).orderBy("rank", key)


def first_author(rows: DataFrame, authors: str) -> list[Column]:
    """Sort keys: surname and given name of the first author, without regard to case; no author comes first."""
    return [F.coalesce(F.lower(F.get(authors, F.lit(0))[part]), F.lit("")) for part in ("last_name", "first_name")]


#: Orders of a book by name, as sort keys; others can be added.
SORTS = {
    "poster_id": lambda rows: [F.col("poster_id")],
    "title": lambda rows: [F.lower("title"), F.col("poster_id")],
    "first_author": lambda rows: [*first_author(rows, "authors"), F.lower("title"), F.col("poster_id")],
}


def sorted_book(rows: DataFrame, order: str) -> DataFrame:
    """Rows with their place, from 0, in the order of that name."""
    keys = {f"_k{i}": c for i, c in enumerate(SORTS[order](rows))}
    return dense_ids(rows.withColumns(keys), list(keys), "place").drop(*keys)
