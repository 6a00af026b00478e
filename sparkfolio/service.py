"""The search service's four questions, as methods that return DataFrames or plain values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .operators.embed import Embedder
from .operators.search import Request, paper_chunks, results, search, stats
from .operators.store import Points


class Service:
    def __init__(self, points: Points, embedder: Embedder):
        self.points, self.embedder = points, embedder

    def query_vector(self, text: str) -> list[float]:
        one = self.points.spark.createDataFrame([(text,)], "text string")
        return list(self.embedder.embed(one, "text").first()["embedding"])

    def search(self, query: str | Sequence[float], request: Request = Request()) -> DataFrame:
        vector = self.query_vector(query) if isinstance(query, str) else query
        return results(search(self.points.read(), vector, request))

    def paper(self, paper_id: str) -> DataFrame:
        return paper_chunks(self.points.read(), paper_id)

    def stats(self) -> DataFrame:
        return stats(self.points.read())

    def health(self) -> dict[str, str]:
        """Errors are a status, never an exception."""
        try:
            self.points.read().limit(1).count()
        except Exception as e:
            return {"status": "degraded", "store": f"error: {e}"}
        return {"status": "healthy", "store": "ok"}
