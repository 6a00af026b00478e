"""Evaluation of a collection: retrieval of the papers that queries come from, comparison with another collection, geometry of the vectors."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.embed import Embedder
from ..operators.evaluate import benchmark_queries, compare, cross_similarity, length_stats, mean_similarity, not_compared, rank_of_source, retrieval_metrics, separation, separation_label
from ..operators.search import paper_of, ranked_papers, sample_chunks, stats, width, width_note
from ..sources.files import hadoop_path


class Evaluation:
    """Measures of ``points``; queries are sentences of the collection itself, embedded by ``embedder``."""

    def __init__(self, points: DataFrame, embedder: Embedder | None = None, per_paper: int = 3, top_k: int = 10, seed: int = 42):
        self.points, self.embedder, self.per_paper, self.top_k, self.seed = points, embedder, per_paper, top_k, seed

    def queries(self) -> DataFrame:
        """(query_id, query_type, source, query_text, query): the vectors under ``query``."""
        own = benchmark_queries(self.points, self.per_paper, self.seed)
        own = own.select(F.xxhash64("paper_id", "slot", "query_text").alias("query_id"), "query_type", F.col("paper_id").alias("source"), "query_text")
        return self.embedder.embed(own, "query_text").withColumnRenamed("embedding", "query")

    def retrieval(self, queries: DataFrame) -> DataFrame:
        ranked = ranked_papers(queries.select("query_id", "query"), self.points, self.top_k)
        return retrieval_metrics(rank_of_source(queries.select("query_id", "query_type", "source"), ranked), self.top_k)

    def _hits(self, queries: DataFrame, points: DataFrame, name: str) -> DataFrame:
        ranked = ranked_papers(queries.select("query_id", "query"), points, self.top_k)
        return rank_of_source(queries.select("query_id", "query_type", "source"), ranked).select("query_id", F.col("rank").isNotNull().alias(name))

    def comparison(self, queries: DataFrame, other: DataFrame | None) -> tuple[DataFrame, str]:
        """(row, note): which collection finds the queries' papers. ``other`` has point_id, embedding and paper_id or work_id, bare or URL-shaped.

        Without another collection, or with one of another width, only this one's recall is known.
        """
        found = -1 if other is None else width(other)
        note, own = width_note(found, width(self.points)), self._hits(queries, self.points, "in_a")
        if other is None or found != width(self.points):
            return not_compared(own), note
        return compare(own.join(self._hits(queries, named(other), "in_b"), "query_id")), note

    def intrinsic(self, papers: int = 50, chunks: int = 20) -> tuple[DataFrame, DataFrame]:
        """(one row of sizes, lengths, similarities and their ratio; one row a section type) of the first chunks of the first papers."""
        sample = sample_chunks(self.points, papers, chunks)
        sizes = sample.agg(F.countDistinct("paper_id").alias("total_papers"), F.count(F.lit(1)).alias("total_chunks"))
        text = sample.withColumn("chunk_text", F.coalesce("chunk_text", F.lit(""))).withColumn("section_type", F.coalesce("section_type", F.lit("unknown")))
        intra = mean_similarity(sample, "paper_id").agg(F.coalesce(F.bround(F.avg("sim"), 3), F.lit(0.0)).alias("intra_similarity"))
        inter = cross_similarity(sample, "paper_id").select(F.bround("sim", 3).alias("inter_similarity"))
        one = sizes.crossJoin(length_stats(text, [], "chunk_text").drop("n")).crossJoin(intra).crossJoin(inter)  # one row each
        one = one.withColumn("separation_ratio", separation(F.col("intra_similarity"), F.col("inter_similarity"))).withColumn("label", separation_label(F.col("separation_ratio")))
        types = text.groupBy("section_type").agg(F.bround(F.avg(F.length("chunk_text")), 1).alias("avg_len"))
        near = mean_similarity(text, "section_type").select("section_type", F.bround("sim", 3).alias("similarity"))
        return one, types.join(near, "section_type", "left").orderBy(F.desc_nulls_last("similarity"), "section_type")


def named(other: DataFrame) -> DataFrame:
    """A collection's points under bare paper ids; those without one are left out."""
    columns: dict[str, Column] = {c: F.col(c) if c in other.columns else F.lit(None).cast("string") for c in ("paper_id", "work_id")}
    return other.select("point_id", paper_of(columns["paper_id"], columns["work_id"]).alias("paper_id"), "embedding").where("paper_id is not null")


def evaluate(name: str, evaluation: Evaluation, what: str = "all", other: DataFrame | None = None, papers: int = 50, chunks: int = 20) -> dict:
    """The measures asked for ("retrieval", "compare", "intrinsic" or "all") as plain values."""
    rows = lambda df: [r.asDict(True) for r in df.collect()]  # noqa: E731  # a few rows of measures
    out: dict = {"run_at": datetime.now(UTC).isoformat(), "collection": name, "points": stats(evaluation.points).first()["points_count"]}
    queries = evaluation.queries() if what != "intrinsic" else None
    if what in ("retrieval", "all"):
        out["retrieval"] = {r.pop("query_type"): r for r in rows(evaluation.retrieval(queries))}
    if what in ("compare", "all"):
        found, note = evaluation.comparison(queries, other)
        out["compare"] = rows(found)[0] | {"total_queries": queries.count(), "k": evaluation.top_k, "note": note}
    if what in ("intrinsic", "all"):
        one, types = evaluation.intrinsic(papers, chunks)
        out["intrinsic"] = rows(one)[0] | {"section_types": rows(types)}
    return out


def summary(results: dict) -> str:
    """The measures as lines of text; section types by falling similarity."""
    lines = [f"{results['collection']}: {results['points']} points, {results['run_at']}"]
    for kind, r in results.get("retrieval", {}).items():
        lines.append(f"retrieval {kind}: recall@1 {r['recall_at_1']}, @5 {r['recall_at_5']}, @10 {r['recall_at_10']}, mrr {r['mrr']}, found {r['found']} of {r['total']}")
    if c := results.get("compare"):
        lines.append(f"compare at {c['k']}: recall {c['recall_a']} against {c['recall_b']}; both {c['both']}, only here {c['a_only']}, only there {c['b_only']}, neither {c['neither']} ({c['note']})")
    if i := results.get("intrinsic"):
        lines.append(f"intrinsic: {i['total_papers']} papers, {i['total_chunks']} chunks of {i['avg_len']} characters (median {i['median_len']}, 5% {i['p5_len']}, 95% {i['p95_len']})")
        lines.append(f"similarity within papers {i['intra_similarity']}, across {i['inter_similarity']}, ratio {i['separation_ratio']} {i['label']}".rstrip())
        lines += [f"  {t['section_type']}: {t['similarity']}, {t['avg_len']} characters" for t in i["section_types"]]
    return "\n".join(lines)


def save(spark, results: dict, path: str) -> None:
    """The measures as one indented JSON file."""
    fs, p = hadoop_path(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(json.dumps(results, indent=2, default=str).encode()))
    stream.close()
