"""Papers selected from a metadata index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bare_doi, last_segment


@dataclass(frozen=True)
class Criteria:
    min_year: int = 2015
    min_citations: int = 10
    language: str = "en"
    max_papers: int = 0  # 0: all


def located(best: Column, other: Column) -> Column:
    """Any location names a file, even an empty one: what an index can decide before rows are read."""
    return F.coalesce(F.exists(best, lambda x: x["pdf_url"].isNotNull()), F.lit(False)) | F.coalesce(F.exists(other, lambda x: x["pdf_url"].isNotNull()), F.lit(False))


def first_location(best: Column, other: Column) -> Column:
    """(pdf_url, display_name) of the first location with a non-empty file, the best ones first; null if none."""

    def usable(locations: Column) -> Column:
        named = F.transform(locations, lambda x: F.struct(x["pdf_url"].alias("pdf_url"), x["display_name"].alias("display_name")))
        return F.coalesce(F.filter(named, lambda x: x["pdf_url"] != ""), F.array().cast("array<struct<pdf_url:string,display_name:string>>"))

    return F.get(F.concat(usable(best), usable(other)), F.lit(0))


def author_names(authors: Column) -> Column:
    return F.coalesce(F.filter(F.transform(authors, lambda a: a["display_name"]), lambda n: n != ""), F.array().cast("array<string>"))


def discover(works: DataFrame, criteria: Criteria = Criteria()) -> DataFrame:
    """Papers of the raw metadata table that meet the criteria and have a file, most cited first (ties by id).

    The bounds are inclusive. Rows without an id or a usable file are dropped before the limit is taken.
    """
    c = criteria
    wanted = works.where((F.col("publication_year") >= c.min_year) & (F.col("cited_by_count") >= c.min_citations) & (F.col("language") == c.language))
    wanted = wanted.where(located(F.col("best_locations"), F.col("locations")))
    at = first_location(F.col("best_locations"), F.col("locations"))
    papers = wanted.select(
        last_segment(F.col("work_id")).alias("work_id"),
        bare_doi(F.col("doi")).alias("doi"),
        F.coalesce("title", F.lit("")).alias("title"),
        author_names(F.col("authors")).alias("authors"),
        F.col("publication_year").try_cast("int").alias("year"),
        F.coalesce(F.col("cited_by_count").try_cast("int"), F.lit(0)).alias("citation_count"),
        at.alias("at"),
    )
    papers = papers.where((F.col("work_id") != "") & F.col("at").isNotNull())
    papers = papers.select("work_id", "doi", "title", "authors", "year", "citation_count", F.col("at.pdf_url").alias("pdf_url"), F.col("at.display_name").alias("journal"))
    papers = papers.orderBy(F.desc("citation_count"), "work_id")
    return papers.limit(c.max_papers) if c.max_papers else papers


def estimate(works: DataFrame, criteria: Criteria = Criteria()) -> int:
    """How many rows the pushed-down part of the criteria selects."""
    c = criteria
    return works.where((F.col("publication_year") >= c.min_year) & (F.col("cited_by_count") >= c.min_citations) & (F.col("language") == c.language)).where(located(F.col("best_locations"), F.col("locations"))).count()
