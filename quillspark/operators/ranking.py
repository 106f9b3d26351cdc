"""Ranked lists: sources one after another, the older weighted search, and scores of runs that are compared with each other."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.evaluation import min_max
from quillspark.operators.relational import dense_ids


def append_semantic(lexical: DataFrame, semantic: DataFrame) -> DataFrame:
    """(kind, id, section, place): lexical matches (kind, id, place) in their order, then the semantic ones (kind, id, distance)
    that aren't among them, by distance; section 0 and 1. Places count from 0 through both."""
    rest = semantic.join(lexical.select("kind", "id"), ["kind", "id"], "left_anti")
    keyed = lexical.select("kind", "id", F.lit(0).alias("section"), F.col("place").cast("double").alias("_by")).union(rest.select("kind", "id", F.lit(1), F.col("distance").cast("double")))
    return dense_ids(keyed, ["section", "_by", "kind", "id"], "place").select("kind", "id", "section", "place")


def sort_keys(kind: str, exact: Column | None, key: Column, year: Column | None = None) -> tuple[Column, Column]:
    """The two ascending keys by which corpora are merged. exact: of a lexical match; None for an empty query."""
    if year is None:  # an overlay: exact matches and late ids first; without a query before all others, by id
        return (-exact.cast("double"), -key.cast("double")) if exact is not None else (F.lit(-1.0), key.cast("double"))
    when = -F.coalesce(year, F.lit(0)).cast("double")
    return (-exact.cast("double"), when) if exact is not None else (when, F.coalesce(key, F.lit(0)).cast("double"))


def seed_list(scores: DataFrame, years: DataFrame, most: int = 25) -> DataFrame:
    """(id, score, year): the matches with most words, the later year first, then by id."""
    return scores.join(years.select("id", "year"), "id", "left").orderBy(F.desc("score"), F.desc_nulls_last("year"), "id").limit(most)


@dataclass
class Group:
    must: list[str] = field(default_factory=list)
    never: list[str] = field(default_factory=list)


def parse(query: str) -> list[Group]:
    """The older grammar: or in any case parts groups, a minus forbids a term, quotes keep spaces; terms are in lower case."""
    groups, now = [], Group()
    for token in [*re.findall(r'-?"[^"]+"|-?\S+', query), "or"]:
        if token.lower() == "or":
            groups += [now] if now.must or now.never else []
            now = Group()
            continue
        sign, term = token.startswith("-"), token.removeprefix("-")
        if term.startswith('"') and term.endswith('"'):
            term = term[1:-1]
        if term := term.strip().lower():
            (now.never if sign else now.must).append(term)
    return groups


@dataclass
class Record:
    """Columns of a record: its title and whole text in lower case, and arrays of tokens by field with their weights."""

    title: Column
    text: Column
    fields: list[tuple[Column, float]]

    def holds(self, term: str) -> Column:
        if re.search(r"\s", term):
            return F.coalesce(self.text.contains(term), F.lit(False))
        return reduce(lambda a, b: a | b, [F.coalesce(F.array_contains(words, term), F.lit(False)) for words, _ in self.fields])

    def score(self, term: str) -> Column:
        """A phrase counts 24 in the title and 10 in the text; a word its field's weight each time."""
        if re.search(r"\s", term):
            return F.when(self.title.contains(term), 24.0).otherwise(0.0) + F.when(self.text.contains(term), 10.0).otherwise(0.0)
        return reduce(lambda a, b: a + b, [F.coalesce(F.size(F.filter(words, lambda x: x == term)), F.lit(0)) * F.lit(weight) for words, weight in self.fields])


def weighted_score(record: Record, groups: list[Group]) -> Column:
    """The best group's score; 1 for a group of forbidden terms only; 0 where no group fits."""
    scores = []
    for g in groups:
        fits = reduce(lambda a, b: a & b, [*(record.holds(t) for t in g.must), *(~record.holds(t) for t in g.never)])
        scores.append(F.when(fits, reduce(lambda a, b: a + b, [record.score(t) for t in g.must]) if g.must else F.lit(1.0)).otherwise(0.0))
    return F.greatest(*scores, F.lit(0.0)) if scores else F.lit(0.0)


def ranked(rows: DataFrame, score: Column, least: float | None = None) -> DataFrame:
    """Rows with a score above 0, or of at least ``least`` if that is given; the best first, then by title."""
    scored = rows.withColumn("score", score)
    return scored.where(F.col("score") > 0 if least is None else F.col("score") >= least).orderBy(F.desc("score"), "title")


def options_with_selected(rows: DataFrame, values: str, selected: list[str]) -> DataFrame:
    """(value, n): counts of a facet's values, and the selected ones that no row has with 0; by value, whatever its case."""
    counts = rows.select(F.explode(values).alias("value")).groupBy("value").agg(F.count("*").alias("n"))
    wanted = rows.sparkSession.createDataFrame([(s,) for s in dict.fromkeys(selected)], "value string").join(counts, "value", "left_anti").select("value", F.lit(0).cast("long").alias("n"))
    return counts.union(wanted).orderBy(F.lower("value"), "value")


def composite(runs: DataFrame, weights: dict[str, tuple[float, bool]], valid: str) -> DataFrame:
    """Runs with the weighted sum of their measures, each scaled over the valid runs to 0..1 (a constant one counts as 1), turned
    where less is better; -1 for a run that isn't valid. weights: measure -> (weight, whether more is better)."""
    ends = runs.where(valid).agg(*(f(c).alias(f"_{k}_{c}") for c in weights for k, f in (("low", F.min), ("high", F.max))))
    rows = runs.crossJoin(F.broadcast(ends))  # a single row
    total = F.lit(0.0)
    for c, (weight, more) in weights.items():
        low, high, x = F.col(f"_low_{c}"), F.col(f"_high_{c}"), F.col(c)
        scaled = (x - low) / (high - low)
        total = total + weight * F.when(x.isNull() | low.isNull(), 0.0).when(high <= low, 1.0).otherwise(scaled if more else 1.0 - scaled)
    return rows.withColumn("composite", F.when(F.expr(valid), total).otherwise(-1.0)).drop(*ends.columns)


#: Measures of a benchmark of clusterings; more is better, but for the spread within clusters and the largest one's share.
BENCHMARK = {"silhouette": (0.30, True), "ratio": (0.20, True), "calinski_harabasz": (0.15, True), "davies_bouldin": (0.15, False), "entropy": (0.10, True), "largest": (0.10, False)}


def comparison_score(silhouette: Column, agreement: Column, ratio: Column, modularity: Column) -> Column:
    """0.3, 0.3, 0.2 and 0.2 of four measures; a missing one is 0."""
    return sum((F.coalesce(c, F.lit(0.0)) * w for c, w in ((silhouette, 0.30), (agreement, 0.30), (ratio, 0.20), (modularity, 0.20))), F.lit(0.0))


def band(count: Column, bands: list[tuple[str, int, int]]) -> Column:
    """The first band, from and to included, that a count lies in."""
    out = F.lit("outside_target_band")
    for name, low, high in reversed(bands):
        out = F.when(count.between(low, high), name).otherwise(out)
    return out




def best_by_band(runs: DataFrame, *partition: str) -> DataFrame:
    """Of each band, and of each of the other columns given, the run with the best comparison, silhouette and agreement, then
    with the fewest labels."""
    order = [F.desc(c) for c in ("comparison", "silhouette", "agreement")] + [F.asc("labels"), F.asc("name")]
    return runs.withColumn("_n", F.row_number().over(Window.partitionBy(*partition, "band").orderBy(*order))).where("_n = 1").drop("_n")


def cross_rollup(runs: DataFrame, baseline: str) -> DataFrame:
    """Every evaluation's band winners with their gains over its baseline run, ranked over all evaluations in their band, the
    best of its evaluation and the best of all marked.

    runs: (evaluation, name, band, labels, comparison, silhouette, agreement, modularity); the run named baseline is no winner.
    """
    base = runs.where(F.col("name") == baseline).select("evaluation", *(F.col(c).alias(f"_{c}") for c in ("silhouette", "agreement", "modularity")))
    winners = best_by_band(runs.where(F.col("name") != baseline), "evaluation").join(base, "evaluation")
    gained = winners.withColumns({f"{c}_gain": F.col(c) - F.col(f"_{c}") for c in ("silhouette", "agreement", "modularity")}).drop("_silhouette", "_agreement", "_modularity")
    order = [F.desc(c) for c in ("comparison", "silhouette", "agreement", "labels", "evaluation", "name")]
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    out = gained.withColumn("band_rank", place("band")).withColumn("best_of_evaluation", place("evaluation") == 1)
    top = out.where("best_of_evaluation").select(F.max_by(F.struct("evaluation", "band"), F.struct("comparison", "silhouette", "agreement", "labels", "evaluation", "name")).alias("_top"))
    return out.crossJoin(F.broadcast(top)).withColumn("best", F.struct("evaluation", "band") == F.col("_top")).drop("_top")


#: Measures of communities with their weights and whether more is better.
COMMUNITY = {"coverage": (0.35, True), "density": (0.20, True), "conductance": (0.30, False), "clustering": (0.15, True)}


def rank_score(runs: DataFrame, key: str, degenerate: str) -> DataFrame:
    """Runs (few) scored by the places that their measures take, 1 for the first and 0 for the last, weighted; a degenerate run
    loses 1. Ranked with degenerate runs last. Equal measures go by the key."""
    n = F.count("*").over(Window.partitionBy())
    total = F.lit(0.0)
    for c, (weight, more) in COMMUNITY.items():
        place = F.row_number().over(Window.orderBy(F.desc(c) if more else F.asc(c), key)) - 1
        total = total + weight * F.when(n == 1, 1.0).otherwise(1.0 - place / (n - 1))
    scored = runs.withColumn("score", total - F.col(degenerate).cast("int"))
    order = [F.asc(degenerate), F.desc(F.round("score", 9)), F.asc("conductance"), F.desc("coverage"), F.desc("density"), F.desc("clustering"), F.asc(key)]
    return scored.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def elbow(sweep: DataFrame) -> DataFrame:
    """The entry of a sweep (resolution, communities, modularity) after which a further community gains less than the median gain
    for the first time; the last one if that never happens."""
    along = Window.orderBy("communities", "resolution")
    steps = F.col("communities") - F.lag("communities").over(along)
    gain = F.when(steps > 0, (F.col("modularity") - F.lag("modularity").over(along)) / steps).when(steps.isNotNull(), 0.0)
    rows = sweep.withColumn("_gain", gain).withColumn("_place", F.row_number().over(along))
    middle = rows.agg(F.median("_gain").alias("_median"), F.max("_place").alias("_last"))
    marked = rows.crossJoin(F.broadcast(middle)).withColumn("_elbow", F.min(F.when(F.col("_gain") < F.col("_median"), F.col("_place"))).over(Window.partitionBy()))
    return marked.where(F.col("_place") == F.coalesce("_elbow", "_last")).drop("_gain", "_place", "_median", "_last", "_elbow")


def noise_plateau(sweep: DataFrame, most: float = 0.5, change: float = 0.05) -> DataFrame:
    """The least size of a sweep (size, noise) with noise of at most ``most`` that the next size changes by less than ``change``;
    else the size with least noise."""
    rows = sweep.withColumn("_next", F.lead("noise").over(Window.orderBy("size")))
    flat = (F.col("noise") <= most) & (F.abs(F.col("noise") - F.col("_next")) < change)
    return rows.agg(F.coalesce(F.min(F.when(flat, F.col("size"))), F.min_by("size", F.struct("noise", "size"))).alias("size"))


__all__ = ["BENCHMARK", "Group", "Record", "append_semantic", "band", "best_by_band", "comparison_score", "composite", "cross_rollup", "elbow", "min_max", "noise_plateau", "options_with_selected", "parse", "rank_score", "ranked", "seed_list", "sort_keys", "weighted_score"]
