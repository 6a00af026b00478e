"""Settings of a session: fields of a dataclass, each from ``spark.sparkfolio.<field>``, else from ``SPARKFOLIO_<FIELD>``, else its default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

from .operators.chunk import CHARS
from .operators.discovery import Criteria
from .operators.embed import WIDTH


@dataclass(frozen=True)
class Settings:
    store: str = "sparkfolio-store"
    width: int = WIDTH
    chunk_chars: int = CHARS
    buckets: int = 64
    min_year: int = Criteria.min_year
    min_citations: int = Criteria.min_citations
    language: str = Criteria.language
    max_papers: int = 100_000

    @classmethod
    def of(cls, spark: SparkSession, environment: Mapping[str, str] = os.environ) -> Settings:
        """ValueError for a value that is not of its field's type."""
        given = {}
        for f in fields(cls):
            value = spark.conf.get(f"spark.sparkfolio.{f.name}", None) or environment.get(f"SPARKFOLIO_{f.name.upper()}")
            if value is not None:
                given[f.name] = int(value) if f.type == "int" else value
        return cls(**given)

    def criteria(self) -> Criteria:
        return Criteria(self.min_year, self.min_citations, self.language, self.max_papers)
