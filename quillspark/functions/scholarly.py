"""Scholarly references: what a line of a reference list says, and how alike two titles are."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from quillspark.functions.text import year as any_year

#: How DOIs, PubMed ids and years are written.
DOI = r"(?i)\b10\.[0-9]{4,9}/[^\s\"<>]+"
PMID = r"(?i)\bPMID:?\s*([0-9]{4,9})\b"
YEAR = r"\b((?:19|20)[0-9]{2})\b"


def _spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def pmid(text: Column) -> Column:
    """The first PubMed id, or null."""
    return F.nullif(F.regexp_extract(text, PMID, 1), F.lit(""))


def guessed_title(text: Column) -> Column:
    """The second sentence if it has three words or more, else the first; DOIs and PubMed ids apart."""
    bare = F.regexp_replace(F.regexp_replace(text, DOI, ""), PMID, "")
    parts = F.filter(F.transform(F.split(bare, r"\.\s+"), lambda s: F.regexp_replace(s, r"^[ .]+|[ .]+$", "")), lambda s: s != "")
    second = F.get(parts, F.lit(1))
    return F.when(F.size(F.split(_spaces(second), " ")) >= 3, second).otherwise(F.coalesce(F.get(parts, F.lit(0)), _spaces(text)))


def year(text: Column) -> Column:
    """The first year beside the title, DOIs and PubMed ids, else the first one anywhere, or null."""
    bare, title = F.regexp_replace(F.regexp_replace(text, DOI, ""), PMID, ""), guessed_title(text)
    beside = F.when(title != "", F.replace(bare, title, F.lit(" "))).otherwise(bare)
    return F.coalesce(any_year(beside), any_year(text))


def entries(text: Column) -> Column:
    """The entries of a reference list in Markdown: a numbered or dashed line begins one, other lines go on with it."""
    lines = F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    mark = r"^([0-9]+\.\s+|-+\s+)"
    start = F.array().cast("array<string>")

    def add(found: Column, line: Column) -> Column:
        body = F.regexp_replace(line, mark, "")
        begins = line.rlike(mark) | (F.size(found) == 0)
        last = F.get(found, F.size(found) - 1)
        return F.when(begins, F.concat(found, F.array(body))).otherwise(F.concat(F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))), F.array(F.concat_ws(" ", last, line))))

    return F.filter(F.transform(F.aggregate(F.coalesce(lines, start), start, add), _spaces), lambda x: x != "")


def covers(source: Column, parts: Column, least: float = 0.6) -> Column:
    """Whether all parts occur in the source, in order and apart, and make up ``least`` of its characters; case and spaces apart."""
    plain = F.lower(_spaces(source))
    state = F.struct(F.lit(1).alias("at"), F.lit(0).alias("n"))

    def step(s: Column, part: Column) -> Column:
        place = F.when((s["at"] > 0) & (part != ""), F.call_function("locate", part, plain, s["at"])).otherwise(F.lit(0))
        return F.struct(F.when(place > 0, place + F.length(part)).otherwise(F.lit(0)).alias("at"), (s["n"] + F.length(part)).alias("n"))

    end = F.aggregate(F.transform(parts, lambda p: F.lower(_spaces(p))), state, step)
    return F.coalesce((F.length(plain) > 0) & (F.size(parts) > 0) & (end["at"] > 0) & (end["n"] / F.length(plain) >= least), F.lit(False))


def _plain(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip()


@F.pandas_udf(DoubleType())
def title_similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Matching blocks of two titles by their length, from 0 to 1; 0 if either has no letter or digit. Spark has no such measure."""
    out = []
    for a, b in zip(left.fillna(""), right.fillna("")):
        a, b = _plain(a), _plain(b)
        out.append(difflib.SequenceMatcher(a=a, b=b).ratio() if a and b else 0.0)
    return pd.Series(out, dtype="float64")


def candidate_score(title: Column, candidate: Column, year: Column, candidate_year: Column) -> Column:
    """Similarity of titles, and 0.03 if both years are there and agree."""
    return title_similarity(title, candidate) + F.when(year == candidate_year, 0.03).otherwise(0.0)


def reference_score(reference: Column, candidate: Column, year: Column, candidate_year: Column) -> Column:
    """As candidate_score, but 1 for a title that the reference holds, case and spaces apart."""
    plain = F.lower(_spaces(candidate))
    held = (plain != "") & F.lower(_spaces(reference)).contains(plain)
    return F.when(held, 1.0).otherwise(title_similarity(reference, candidate)) + F.when(year == candidate_year, 0.03).otherwise(0.0)


@F.pandas_udf(ArrayType(StringType()))
def closest_sentences(quote: pd.Series, text: pd.Series) -> pd.Series:
    """The three sentences most like a quote, at a similarity of 0.6 or more; none if the text has the quote itself."""
    out = []
    for q, t in zip(quote.fillna(""), text.fillna("")):
        sentences = [s.strip() for s in re.split(r"(?<=[.!?])\s+", t) if s.strip()]
        out.append([] if q and q in t else difflib.get_close_matches(q, sentences, n=3, cutoff=0.6))
    return pd.Series(out, dtype=object)


def vocabulary_hits(needle: Column, label: Column, definition: Column) -> Column:
    """Whether a code's label or definition holds the words looked up, whatever the case; blank words find nothing."""
    plain = F.lower(F.trim(needle))
    return (plain != "") & (F.lower(label).contains(plain) | F.lower(definition).contains(plain))


def parallel(references: Column) -> Column:
    """A struct of arrays dois, urls and titles of references (doi, url, title): a missing piece is empty, a missing address
    follows from the DOI, and a reference without any goes."""
    filled = F.transform(
        F.coalesce(references, F.array().cast("array<struct<doi:string,url:string,title:string>>")),
        lambda r: F.struct(F.coalesce(r["doi"], F.lit("")).alias("doi"), F.coalesce(F.nullif(r["url"], F.lit("")), F.concat(F.lit("https://doi.org/"), F.nullif(r["doi"], F.lit(""))), F.lit("")).alias("url"), F.coalesce(r["title"], F.lit("")).alias("title")),
    )
    kept = F.filter(filled, lambda r: (r["doi"] != "") | (r["url"] != "") | (r["title"] != ""))
    return F.struct(*(kept[n].alias(f"{n}s") for n in ("doi", "url", "title")))
