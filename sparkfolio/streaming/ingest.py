"""Sections as a stream: each micro-batch is chunked and upserted, so that a repeated batch changes nothing; only buckets of its papers are rewritten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.embed import Embedder
from ..operators.store import Points, payload
from ..plans.ingest import chunks_of


def stream_points(sections: DataFrame, papers: DataFrame, embedder: Embedder, points: Points, checkpoint: str, mode: str = "replace", **trigger) -> StreamingQuery:
    """Run ``sections`` (a stream) into ``points``; ids are functions of their content's place, which makes it idempotent.

    Ranking and limits have no meaning on an unbounded input; they belong to the reads of the table.
    """

    def one(batch: DataFrame, _: int) -> None:
        points.merge(payload(embedder.embed(chunks_of(batch), "chunk_text"), papers), mode)

    return sections.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
