"""Filtered vector search with one result a paper."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import cosine, doubles

OVERFETCH = 5
#: Of the query vectors that go to all tasks at once; hits of their queries that a task keeps; decimal digits of scores.
BLOCK_BYTES, BLOCK_HITS, DIGITS = 16 << 20, 1 << 19, 12
#: Scores that a task computes at once, and the queries among them.
CELLS, TILE = 1 << 21, 512


@dataclass(frozen=True)
class Request:
    limit: int = 10
    year_min: int | None = None
    year_max: int | None = None
    min_citations: int | None = None
    sections: Sequence[str] | None = None

    def __post_init__(self):
        if not 1 <= self.limit <= 100:
            raise ValueError("limit must be from 1 to 100")

    def filter(self) -> Column:
        """Bounds hold where given (0 is a bound); ``sections`` are section types. Null fields meet no bound."""
        out = F.lit(True)
        for column, bound, kind in (("year", self.year_min, "ge"), ("year", self.year_max, "le"), ("citation_count", self.min_citations, "ge")):
            if bound is not None:
                out = out & ((F.col(column) >= bound) if kind == "ge" else (F.col(column) <= bound))
        return out & F.col("section_type").isin(list(self.sections)) if self.sections else out


def top_points(points: DataFrame, query: Sequence[float] | Column, k: int, vector: str = "embedding", id: str = "point_id") -> DataFrame:
    """The k points nearest to one query by cosine, with ``score``; ties by id. One pass and a heap a task."""
    q = query if isinstance(query, Column) else F.array(*[F.lit(float(x)) for x in query])
    return points.withColumn("score", cosine(F.col(vector), q)).where("score is not null").orderBy(F.desc("score"), id).limit(k)


def best_per(hits: DataFrame, keys: Sequence[str], id: str = "point_id") -> DataFrame:
    """Of the hits of each paper the best (ties by id)."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), id)
    return hits.withColumn("best", F.row_number().over(order)).where("best = 1").drop("best")


def search(points: DataFrame, query: Sequence[float] | Column, request: Request = Request(), where: Column | None = None) -> DataFrame:
    """Papers for one query: the best 5 x limit chunks that pass the filter, then the best chunk of each paper.

    Fewer than ``limit`` papers return if few papers hold all of those chunks.
    """
    hits = top_points(points.where(request.filter() if where is None else where), query, OVERFETCH * request.limit)
    return best_per(hits, ["paper_id"]).orderBy(F.desc("score"), "point_id").limit(request.limit)


RESULT = {"paper_id": "''", "doi": "''", "title": "''", "authors": "array()", "year": None, "citation_count": "0", "journal": "''", "section": "''", "section_type": "''", "chunk_text": "''"}
_RENAMED = {"section": "matching_section", "chunk_text": "matching_text"}


def results(found: DataFrame) -> DataFrame:
    """The fields of a search result, with defaults for what is missing."""
    fields = [(F.coalesce(F.col(c), F.expr(d).cast(found.schema[c].dataType)) if d else F.col(c)).alias(_RENAMED.get(c, c)) for c, d in RESULT.items() if c in found.columns]
    return found.select(*fields, "score")


def _unit_points(table: pa.Table, width: int) -> tuple[pa.Table, np.ndarray]:
    """The points that have a score with vectors of ``width`` components, and their unit vectors."""
    table = table.filter(pc.equal(pc.list_value_length(table.column("embedding")), width))
    x = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    norm = np.linalg.norm(x, axis=1)
    fine = norm > 0
    x = x[fine] / norm[fine][:, None]
    known = ~np.isnan(x).any(1)
    return table.select(["point_id", "paper_id"]).filter(pa.array(fine)).filter(pa.array(known)), x[known]


def _block_scores(ids: pa.Array, vectors: np.ndarray, k: int, skip_own: bool):
    """For mapInArrow over (point_id, paper_id, embedding): the k best points of a task for each of a block of queries.

    Tiles of queries and points meet as matrix products; no more than ``CELLS`` scores are held, however many queries there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, pa.Table] = {}
        least = np.full(len(vectors), -np.inf)  # the score of the k-th best so far
        for batch in batches:
            for start in range(0, batch.num_rows, CELLS // TILE):
                points, x = _unit_points(pa.Table.from_batches([batch.slice(start, CELLS // TILE)]), vectors.shape[1])
                if not len(x):
                    continue
                own = pc.fill_null(pc.index_in(points.column("point_id"), ids), -1).to_numpy() if skip_own else None
                for first in range(0, len(vectors), TILE):
                    scores, cut = vectors[first : first + TILE] @ x.T, least[first : first + TILE]
                    if own is not None:
                        at = np.flatnonzero((own >= first) & (own < first + TILE))
                        scores[own[at] - first, at] = -np.inf
                    near = scores >= cut[:, None] - 10.0**-DIGITS
                    if scores.shape[1] > k and near.sum() > 4 * k * len(cut):
                        cut = np.maximum(cut, np.partition(scores, -k, axis=1)[:, -k])
                        near = scores >= cut[:, None] - 10.0**-DIGITS
                    q, row = np.nonzero(near & (scores > -np.inf))
                    if not len(q):
                        continue
                    some = points.take(pa.array(row)).append_column("q", pa.array(q)).append_column("score", pa.array(np.round(scores[q, row], DIGITS)))
                    best = held[first] = _best(pa.concat_tables([held[first], some]) if first in held else some, k)
                    n = np.bincount(best.column("q").to_numpy(), minlength=len(cut))
                    full = np.flatnonzero(n == k)
                    least[first + full] = best.column("score").to_numpy()[np.cumsum(n)[full] - 1]
        for first in sorted(held):
            best = held.pop(first)
            named = ids.take(pa.array(best.column("q").to_numpy() + first))
            yield from pa.table({"query_id": named, "point_id": best.column("point_id"), "paper_id": best.column("paper_id"), "score": best.column("score")}).combine_chunks().to_batches()

    return run


def _best(rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of each q, sorted; ties by point_id."""
    rows = rows.take(pc.sort_indices(rows, [("q", "ascending"), ("score", "descending"), ("point_id", "ascending")]))
    q = rows.column("q").to_numpy()
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return rows.filter(pa.array(rank < k))


def top_points_by_query(queries: DataFrame, points: DataFrame, k: int, skip_own: bool = False) -> DataFrame:
    """(query_id, point_id, paper_id, score, rank) for many queries at once: ``queries`` is (query_id, query).

    Queries go to all tasks in blocks of about ``BLOCK_BYTES`` and ``BLOCK_HITS`` hits at most; for each block the points are scanned once, and a task keeps
    the k best of each query. Scores have ``DIGITS`` digits; ties by point_id. Queries and points that are null, zero, or of
    another length than a block's first query have no score. ``skip_own`` leaves out the point whose id is the query's.
    """
    q = queries.select("query_id", doubles(F.col("query")).alias("query")).where("query_id is not null and query is not null and size(query) > 0")
    facts = q.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("query")).alias("d")).first()
    blocks = max(-(-facts["n"] * 8 * (facts["d"] or 1) // BLOCK_BYTES), -(-facts["n"] * k // BLOCK_HITS))
    kinds = {f.name: f.dataType.simpleString() for f in points.schema}
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, point_id {kinds['point_id']}, paper_id {kinds['paper_id']}, score double"
    own = points.select("point_id", "paper_id", doubles(F.col("embedding")).alias("embedding")).where("embedding is not null and forall(embedding, x -> x is not null)")
    scored = points.sparkSession.createDataFrame([], schema)
    for block in range(blocks):
        some = q.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        for d in sorted({int(x) for x in pc.unique(pc.list_value_length(some.column("query"))).to_pylist()}):
            same = some.filter(pc.equal(pc.list_value_length(some.column("query")), d))
            x = same.column("query").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            norm = np.linalg.norm(x, axis=1)
            fine = norm > 0
            if fine.any():
                ids = same.column("query_id").combine_chunks().filter(pa.array(fine))
                scored = scored.unionByName(own.mapInArrow(_block_scores(ids, x[fine] / norm[fine][:, None], k, skip_own), schema))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "point_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_papers(queries: DataFrame, points: DataFrame, k: int, skip_own: bool = False) -> DataFrame:
    """(query_id, paper_id, score, rank): for each query the k best papers among its 5k best points."""
    hits = top_points_by_query(queries, points, OVERFETCH * k, skip_own).drop("rank")
    papers = hits.groupBy("query_id", "paper_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "paper_id")
    return papers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def paper_scroll(points: DataFrame, paper_id, cap: int = 1000, vectors: bool = False, vector: str = "embedding") -> DataFrame:
    """Chunks of a paper as stored: by id, at most ``cap``, with their vectors if asked for. Unknown papers have none."""
    some = points.where(F.col("paper_id") == paper_id).orderBy("point_id").limit(cap)
    return some if vectors else some.drop(vector)


def paper_chunks(points: DataFrame, paper_id, cap: int = 1000) -> DataFrame:
    """Chunks of a paper in reading order; of more than ``cap``, those of the smallest ids."""
    return paper_scroll(points, paper_id, cap, vectors=True).orderBy(F.coalesce("section_order", F.lit(0)), F.coalesce("chunk_index", F.lit(0)))


def sample_chunks(points: DataFrame, papers: int = 50, chunks: int = 20) -> DataFrame:
    """The first ``chunks`` chunks, by id, of each of the first ``papers`` papers."""
    some = points.select("paper_id").distinct().orderBy("paper_id").limit(papers)
    order = Window.partitionBy("paper_id").orderBy("point_id")
    own = points.join(F.broadcast(some), "paper_id")  # as many ids as asked for
    return own.withColumn("place", F.row_number().over(order)).where(F.col("place") <= chunks).drop("place")


def stats(points: DataFrame) -> DataFrame:
    return points.agg(F.count(F.lit(1)).alias("points_count"), F.count("embedding").alias("vectors_count"), F.lit("green").alias("status"))


def paper_ids(points: DataFrame) -> DataFrame:
    return points.select("paper_id").distinct().orderBy("paper_id")


def width(points: DataFrame, vector: str = "embedding") -> int:
    """The length of a collection's vectors; -1 if it has none."""
    one = points.where(F.col(vector).isNotNull()).select(F.size(vector).alias("n")).first()
    return one["n"] if one else -1


def width_note(found: int, wanted: int) -> str:
    """What a collection's width means for a comparison; valid only where both are equal."""
    if found == wanted:
        return f"both collections have vectors of {wanted} components: comparison valid"
    if found > 0:
        return f"the other collection has vectors of {found} components, not {wanted}: comparison skipped"
    return "the other collection's width is unknown: comparison skipped"


def paper_of(payload_paper: Column, payload_work: Column) -> Column:
    """The id of a paper in a collection that names it either way, as a bare id; null if empty."""
    given = F.coalesce(F.nullif(payload_paper, F.lit("")), payload_work)
    return F.nullif(F.element_at(F.split(given, "/"), -1), F.lit(""))
