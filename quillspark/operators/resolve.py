"""References to the works that they mean: by DOI, else by PubMed id, else by the most similar title of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.scholarly import candidate_score

WORK = "id string, doi string, ids struct<pmid:string>, display_name string, publication_year int, publication_date string, primary_location struct<source:struct<display_name:string>>, type string, type_crossref string, cited_by_count int, referenced_works array<string>"


def normal_doi(doi: Column) -> Column:
    """In lower case, without an address before it; blank is null."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(doi)), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", ""), F.lit(""))


def work(raw: Column) -> Column:
    """A struct of what a work's record (JSON) says, flat: ids, title, year, journal, kind, whether it is a review, citations."""
    w = F.from_json(raw, WORK)
    return F.struct(
        w["id"].alias("work"), normal_doi(w["doi"]).alias("doi"), F.nullif(F.regexp_extract(w["ids"]["pmid"], r"(\d+)", 1), F.lit("")).alias("pmid"), w["display_name"].alias("title"), w["publication_year"].alias("year"), w["primary_location"]["source"]["display_name"].alias("journal"), w["type"].alias("type"),
        ((F.lower(F.coalesce(w["type"], F.lit(""))) == "review") | (F.lower(F.coalesce(w["type_crossref"], F.lit(""))) == "review-article")).alias("is_review"), w["cited_by_count"].alias("cited"), F.coalesce(w["referenced_works"], F.array().cast("array<string>")).alias("references"),
    )


def resolve(references: DataFrame, works: DataFrame, candidates: DataFrame, least: float = 0.8) -> DataFrame:
    """(id, work, how, score) of references (id, doi, pmid, title, year) that a work (work, doi, pmid, title, year) answers.

    A reference takes the work with its DOI, else with its PubMed id, else, of its candidates (id, work), the one with the best
    score of at least ``least``; ties go to the smaller work. Each step looks at what the one before left.
    """

    def by(left: DataFrame, column: str) -> DataFrame:
        known = works.where(F.col(column).isNotNull()).groupBy(column).agg(F.min("work").alias("work"))
        return left.where(F.col(column).isNotNull()).join(known, column).select("id", "work", F.lit(column).alias("how"), F.lit(1.0).alias("score"))

    first = by(references, "doi")
    rest = references.join(first.select("id"), "id", "left_anti")
    second = by(rest, "pmid")
    rest = rest.join(second.select("id"), "id", "left_anti").where("title is not null")
    theirs = works.select("work", F.col("title").alias("_title"), F.col("year").alias("_year"))
    scored = rest.join(candidates.select("id", "work"), "id").join(theirs, "work").select("id", "work", candidate_score(F.col("title"), F.col("_title"), F.col("year"), F.col("_year")).alias("score"))
    third = scored.groupBy("id").agg(F.max(F.struct("score", (-F.col("work")).alias("less"))).alias("b")).where(F.col("b.score") >= least).select("id", (-F.col("b.less")).alias("work"), F.lit("title").alias("how"), F.col("b.score").alias("score"))
    return first.union(second).union(third)
