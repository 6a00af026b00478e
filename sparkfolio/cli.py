"""Command line: ingest, resume, progress, search, evaluate."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from .config import Settings
from .operators.embed import HashingEmbedder
from .operators.search import Request
from .operators.state import RUNS, STATE, progress
from .operators.store import Points, Snapshots
from .plans.evaluation import Evaluation, evaluate, save, summary
from .plans.ingest import Ingest
from .service import Service
from .sources import readers

POINTS = (
    "point_id string, embedding array<float>, paper_id string, doi string, title string, authors array<string>, year int, citation_count int, journal string, "
    "chunk_text string, section string, section_type string, section_order int, chunk_index int, total_chunks bigint, chunking_method string"
)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="sparkfolio")
    out.add_argument("--store", help="folder of the points and the state; default: the session's setting")
    out.add_argument("--width", type=int, help="width of the vectors; default: the session's setting")
    sub = out.add_subparsers(dest="command", required=True)
    run = sub.add_parser("ingest")
    run.add_argument("--works", required=True, help="metadata as JSON lines")
    run.add_argument("--tei", required=True, help="folder of XML files named by paper")
    run.add_argument("--max-papers", type=int, help="default: the session's setting")
    run.add_argument("--resume", action="store_true")
    sub.add_parser("progress")
    find = sub.add_parser("search")
    find.add_argument("query")
    find.add_argument("--limit", type=int, default=10)
    find.add_argument("--year-min", type=int)
    find.add_argument("--year-max", type=int)
    find.add_argument("--min-citations", type=int)
    find.add_argument("--sections", nargs="*")
    test = sub.add_parser("evaluate")
    test.add_argument("what", choices=["retrieval", "compare", "intrinsic", "all"])
    test.add_argument("--output", help="JSON file; default: results below the store")
    test.add_argument("--queries-per-paper", type=int, default=3)
    test.add_argument("--top-k", type=int, default=10)
    test.add_argument("--seed", type=int, default=42)
    test.add_argument("--other", help="Parquet of the collection to compare with")
    test.add_argument("--max-papers", type=int, default=50)
    test.add_argument("--max-chunks", type=int, default=20)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("sparkfolio").getOrCreate()
    settings = Settings.of(spark)
    settings = replace(settings, **{k: v for k in ("store", "width", "max_papers") if (v := getattr(args, k, None)) is not None})
    args.store = settings.store
    points, state = Points(spark, f"{args.store}/points", POINTS, settings.width, settings.buckets), Snapshots(spark, f"{args.store}/state", STATE)
    embedder = HashingEmbedder(settings.width)
    if args.command == "ingest":
        works = readers.works(spark, args.works)
        files = readers.tei(spark, args.tei).withColumnRenamed("paper_id", "work_id")
        job = Ingest(embedder, points, state, runs=Snapshots(spark, f"{args.store}/runs", RUNS), chars=settings.chunk_chars)
        if args.resume:
            from .operators.discovery import discover

            job.resume(discover(works, replace(settings.criteria(), max_papers=0)), files)
        else:
            job.run(works, files, settings.criteria())
    if args.command == "evaluate":
        own = Evaluation(points.read(), embedder, args.queries_per_paper, args.top_k, args.seed)
        other = spark.read.parquet(args.other) if args.other else None
        found = evaluate(args.store, own, args.what, other, args.max_papers, args.max_chunks)
        print(summary(found))
        save(spark, found, args.output or f"{args.store}/results/eval_{found['run_at'].replace(':', '')}.json")
    elif args.command == "search":
        Service(points, embedder).search(args.query, Request(args.limit, args.year_min, args.year_max, args.min_citations, args.sections)).show(args.limit, False)
    else:
        progress(state.read()).orderBy("stage").show(20, False)


if __name__ == "__main__":
    main()
