"""Lexical search: a small query language over an inverted index, with a ladder of typo thresholds.

A query is a disjunction (upper-case OR) of groups; a group is a conjunction of words, quoted phrases and negations.
Words of fewer than 4 characters must match exactly, of 4 to 6 within one edit, longer ones within two; swapping two
neighbours is one edit. The parser runs on the driver; everything else is a plan over the tables of an index: its
vocabulary, and its postings in folders by a hash of the token, of which a query reads those of the tokens that it hits.
A query's words meet the vocabulary once and the postings once, whatever the number of its clauses.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions.text import fold_text, tokens
from quillspark.operators.relational import dense_ids
from quillspark.sources.tables import stored


@dataclass(frozen=True)
class Clause:
    words: tuple[str, ...]
    negated: bool = False


@dataclass
class Query:
    groups: list[list[Clause]] = field(default_factory=list)

    def words(self) -> list[str]:
        return [w for g in self.groups for c in g if not c.negated for w in c.words]

    def without_operators(self) -> str:
        """What a semantic encoder should see."""
        return " ".join(self.words())


def split_words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", fold_text(text)) if len(w) >= 2]


def parse(text: str) -> Query:
    """An unclosed quote counts as words, a phrase of one word as that word; groups without clauses vanish."""
    out, group = Query(), []
    for sign, quoted, plain in re.findall(r'(-?)(?:"([^"]*)"|([^\s"]+))', text):
        if plain == "OR" and not sign:
            out.groups.append(group)
            group = []
            continue
        words = tuple(split_words(quoted or plain))
        if quoted and len(words) > 1:
            group.append(Clause(words, bool(sign)))
        else:
            group += [Clause((w,), bool(sign)) for w in words]
    out.groups = [g for g in [*out.groups, group] if g]
    return out


def threshold(word: str) -> int:
    return 0 if len(word) < 4 else 1 if len(word) < 7 else 2


def osa(a: str, b: str, most: int) -> int:
    """Optimal string alignment distance, or most + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    older, old = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(old[j] + 1, new[-1] + 1, old[j - 1] + (x != y))
            if older is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            new.append(d)
        if min(new) > most and min(old) > most:
            return most + 1
        older, old = old, new
    return min(old[-1], most + 1)


#: The distance of the columns word and token as osa gives it.
_OSA = """aggregate(sequence(1, length(word)), named_struct('older', sequence(0, length(token)), 'old', sequence(0, length(token))),
  (s, i) -> named_struct('older', s.old, 'old', aggregate(sequence(1, length(token)), array(i), (row, j) -> concat(row, array(least(
    s.old[j] + 1, row[j - 1] + 1, s.old[j - 1] + if(substr(word, i, 1) = substr(token, j, 1), 0, 1),
    if(i > 1 and j > 1 and substr(word, i, 1) = substr(token, j - 1, 1) and substr(word, i - 1, 1) = substr(token, j, 1), s.older[j - 2] + 1, 1000)))))),
  s -> s.old[length(token)])"""
#: Folders of the postings; a large corpus needs thousands.
FOLDERS = 64


@dataclass
class Index:
    """postings: (folder, token, id, pos); vocabulary: (folder, token, letters, df, n), letters in order; ids: all ids."""

    postings: DataFrame
    vocabulary: DataFrame
    ids: DataFrame


def build_index(docs: DataFrame, key: str, text: str, *, folders: int = FOLDERS) -> Index:
    """Tokenises the corpus once and stores the index in the cluster's shared folder. Null texts have no tokens."""
    ids = stored(docs.select(F.col(key).alias("id")), "ids")
    # AQE sizes the tasks, so a token that a third of all documents have is dealt over several
    found = docs.select(F.col(key).alias("id"), F.posexplode(tokens(F.col(text))).alias("pos", "token"))
    placed = found.withColumn("folder", F.pmod(F.hash("token"), F.lit(folders))).hint("rebalance", F.col("folder"))
    postings = stored(placed.sortWithinPartitions("folder", "token", "id", "pos"), "postings", ["folder"])
    each = postings.groupBy("folder", "token", "id").agg(F.count("*").alias("n"))
    vocabulary = stored(each.groupBy("folder", "token").agg(F.count("*").alias("df"), F.sum("n").alias("n")).withColumn("letters", _letters(F.col("token"))).coalesce(8), "vocabulary")
    return Index(postings, vocabulary, ids)


def _letters(word: Column) -> Column:
    return F.array_join(F.array_sort(F.split(word, "")), "")


def word_hits(index: Index, words: list[str]) -> DataFrame:
    """(folder, token, word, exact): the vocabulary within each word's threshold.

    Plain edits decide most pairs. A pair that they refuse may need a swap, which leaves the letters as they are and costs two
    plain edits; so only pairs whose letters differ by the other edits alone, two places each at most, get the exact distance.
    """
    spark = index.ids.sparkSession
    wanted = spark.createDataFrame([(w, threshold(w), "".join(sorted(w))) for w in sorted(set(words))], "word string, most int, sorted string")
    apart = F.abs(F.length("token") - F.length("word"))
    # the lengths that can match; a filter on this side also lets Spark skip folders of the postings
    low, high = min(len(w) - threshold(w) for w in words), max(len(w) + threshold(w) for w in words)
    near = index.vocabulary.where(F.length("token").between(low, high)).join(F.broadcast(wanted), (apart <= F.col("most")) & ((F.col("token") == F.col("word")) | ((F.col("most") > 0) & (F.levenshtein("token", "word") <= 2 * F.col("most")))))
    swapped = F.levenshtein("letters", "sorted") <= 2 * (F.col("most") - 1)
    good = F.when(F.levenshtein("token", "word") <= F.col("most"), F.lit(True)).when(swapped, F.expr(_OSA) <= F.col("most")).otherwise(F.lit(False))
    return near.where(good).select("folder", "token", "word", (F.col("word") == F.col("token")).cast("int").alias("exact"))


def _hits(index: Index, words: list[str]) -> DataFrame:
    """Postings of the words; those of other folders are not read."""
    return index.postings.join(F.broadcast(word_hits(index, words)), ["folder", "token"])


def _exactness(clause: Clause, name: str) -> tuple[list[Column], Column]:
    """Aggregates over a document's hits, and from them: null without a match; for a word whether it occurs exactly, for a
    phrase how many words of its first place do."""
    if len(clause.words) == 1:
        return [F.max(F.when(F.col("word") == clause.words[0], F.col("exact"))).alias(name)], F.col(name)
    found = [F.collect_set(F.when(F.col("word") == w, F.struct((F.col("pos") - i).alias("start"), "exact"))).alias(f"{name}_{i}") for i, w in enumerate(clause.words)]
    places = [F.col(f"{name}_{i}") for i in range(len(clause.words))]
    first = F.array_min(reduce(F.array_intersect, [F.transform(p, lambda x: x["start"]) for p in places]))
    total = reduce(lambda a, b: a + b, [F.array_max(F.transform(F.filter(p, lambda x: x["start"] == first), lambda x: x["exact"])) for p in places])
    return found, F.when(first.isNotNull(), total)


def search(index: Index, query: Query) -> tuple[DataFrame, DataFrame]:
    """(id, exactness) of the matches and (id) of what a negation blocks.

    Exactness adds up over a group's clauses; the best group counts. A negation that stands after the clause which
    left a group empty is not evaluated, so it blocks nothing. A group of negations only starts from all ids.
    """
    spark = index.ids.sparkSession
    if not query.groups:
        nothing = spark.createDataFrame([], "id long, exactness long")
        return nothing, nothing.select("id")
    clauses = sorted({(c.words,) for g in query.groups for c in g})
    name = {words: f"c{i}" for i, (words,) in enumerate(clauses)}
    parts = {words: _exactness(Clause(words), name[words]) for (words,) in clauses}
    found = _hits(index, [w for (words,) in clauses for w in words]).groupBy("id").agg(*(a for aggregates, _ in parts.values() for a in aggregates))
    found = found.select("id", *(parts[words][1].cast("long").alias(name[words]) for (words,) in clauses))
    if any(all(c.negated for c in g) for g in query.groups):
        found = index.ids.distinct().join(found, "id", "left")
    score = []
    for group in query.groups:
        fits = reduce(lambda a, b: a & b, [F.col(name[c.words]).isNull() if c.negated else F.col(name[c.words]).isNotNull() for c in group])
        score.append(F.when(fits, reduce(lambda a, b: a + b, [F.col(name[c.words]) for c in group if not c.negated], F.lit(0).cast("long"))))
    matched = found.select("id", (F.greatest(*score) if len(score) > 1 else score[0]).alias("exactness")).where("exactness is not null")
    return matched, _blocked(found, query, name)


def _blocked(found: DataFrame, query: Query, name: dict) -> DataFrame:
    """Ids that an evaluated negation holds: one before which the clauses of its group still have a match somewhere."""
    hit, needs = [], []
    for group in query.groups:
        for i, clause in enumerate(group):
            if clause.negated:
                before = [F.col(name[c.words]).isNotNull() for c in group[:i] if not c.negated]
                hit.append(F.col(name[clause.words]).isNotNull())
                needs.append(F.max(reduce(lambda a, b: a & b, before)) if before else F.lit(True))
    if not hit:
        return found.select("id").limit(0)
    flags = found.agg(*(n.alias(f"n{i}") for i, n in enumerate(needs)))  # a single row
    held = reduce(lambda a, b: a | b, [h & F.coalesce(f"n{i}", F.lit(False)) for i, h in enumerate(hit)])
    return found.crossJoin(F.broadcast(flags)).where(held).select("id")


def seeds(index: Index, query: Query) -> DataFrame:
    """(id, score): how many of the query's words, repeats included, each document has."""
    words = query.words()
    if not words:
        return index.ids.sparkSession.createDataFrame([], "id long, score long")
    times = F.create_map(*(x for w in sorted(set(words)) for x in (F.lit(w), F.lit(words.count(w)))))
    return _hits(index, words).groupBy("id").agg(F.collect_set("word").alias("words")).select("id", F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + times[w]).alias("score"))


def typo_variants(word: str) -> list[str]:
    """A word with a letter lost, changed, doubled and swapped with the next, at its middle, as far as the ladder forgives it."""
    i = len(word) // 2
    made = [word[:i] + word[i + 1 :], word[:i] + chr((ord(word[i]) - 96) % 26 + 97) + word[i + 1 :], word[:i] + word[i] + word[i:], word[: i - 1] + word[i] + word[i - 1] + word[i + 1 :]]
    return [v for v in dict.fromkeys(made) if v != word and osa(v, word, threshold(v)) <= threshold(v)]


def typo_recall(index: Index, words: list[str]) -> DataFrame:
    """(recall): the share of misspelt words whose search meets the word itself. words: a list to test, of the vocabulary."""
    pairs = [(w, v) for w in words for v in typo_variants(w)]
    asked = index.ids.sparkSession.createDataFrame(pairs, "wanted string, word string")
    hits = word_hits(index, [v for _, v in pairs]).select("word", F.col("token").alias("wanted"), F.lit(1).alias("hit")).distinct()
    return asked.join(hits, ["word", "wanted"], "left").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def id_prefix(docs: DataFrame, key: str, query: str, limit: int = 10) -> DataFrame:
    """id:NNN finds ids by their first digits, the least first; exact only if there is a single match."""
    digits = re.sub(r"\D", "", query).lstrip("0")
    found = docs.where(F.col(key).cast("string").startswith(digits) if digits else F.lit(False)).orderBy(key).limit(limit)
    return found.select(F.col(key).alias("id"), (F.count("*").over(Window.partitionBy()) == 1).alias("exact"))


def merge(lexical: DataFrame, semantic: DataFrame, blocked: DataFrame) -> DataFrame:
    """Lexical matches and those semantic ones that no negation blocks."""
    return lexical.select("id").union(semantic.select("id").join(blocked, "id", "left_anti")).distinct()


def compose(universe: DataFrame, parts: list[DataFrame | None]) -> DataFrame:
    """Ids in every given set; None is no constraint, an empty set is one."""
    for part in parts:
        if part is not None:
            universe = universe.join(part.select("id").distinct(), "id", "left_semi")
    return universe


def rank(matches: DataFrame, scores: DataFrame) -> DataFrame:
    """Exactness first, then semantic score, missing scores last, then id."""
    joined = matches.join(scores, "id", "left").withColumn("_less", -F.coalesce("score", F.lit(float("-inf")))).withColumn("_worse", -F.col("exactness"))
    return dense_ids(joined, ["_worse", "_less", "id"], "place").withColumn("place", (F.col("place") + 1).cast("int")).drop("_less", "_worse")


__all__ = ["Clause", "Index", "Query", "SparkSession", "build_index", "compose", "id_prefix", "merge", "osa", "parse", "rank", "search", "seeds", "word_hits"]
