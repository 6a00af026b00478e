"""From papers to points: discover, skip what is done, extract, chunk, embed, store, and keep the state."""

from __future__ import annotations

import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chunk import CHARS, chunk
from ..operators.discovery import Criteria, discover
from ..operators.embed import Embedder
from ..operators.extract import extract
from ..operators.state import STAGES, moved, outcome, registered, run_ended, run_started, unprocessed
from ..operators.store import Points, Snapshots, payload
from ..sources.extractor import Delete, discard
from ..sources.files import remove


def chunks_of(sections: DataFrame, chars: int = CHARS) -> DataFrame:
    """Chunks of extracted sections, under the names that points have."""
    out = chunk(sections, ["paper_id", "section_key", "section_type", "section_order"], "content", chars)
    return out.withColumnRenamed("section_key", "section").drop("chunk_len")


class Ingest:
    """One pass over new papers, or over those that stopped half-way.

    ``files``: (work_id, tei) of the papers that could be fetched and parsed into XML; a paper without one, or with a null
    one, fails. ``runs``, if given, logs each pass with its counts. ``landed`` (pdf_path) of a pass is deleted by ``delete``
    after it, whatever became of the papers.
    """

    def __init__(self, embedder: Embedder, points: Points, state: Snapshots, mode: str = "replace", runs: Snapshots | None = None, delete: Delete | None = None, chars: int = CHARS):
        self.embedder, self.points, self.state, self.mode, self.runs, self.delete, self.chars = embedder, points, state, mode, runs, delete, chars

    def run(self, works: DataFrame, files: DataFrame, criteria: Criteria = Criteria(), landed: DataFrame | None = None) -> DataFrame:
        """The new state. Papers already embedded count against ``max_papers`` and are skipped."""
        papers = discover(works, criteria)
        state = self.state.write(registered(self.state.read(), papers))
        out = self._logged(unprocessed(papers, state), files, ("failed_download", "failed_processing"), asdict(criteria))
        if landed is not None and self.delete is not None:
            discard(landed, self.delete)
        return out

    def resume(self, papers: DataFrame, files: DataFrame) -> DataFrame:
        """One pass over papers in the middle stages, each done whole; papers only discovered wait for ``run``."""
        state = self.state.read().where(F.col("stage").isin(*STAGES[1:-1])).select("work_id", "stage")
        return self._logged(papers.join(state, "work_id"), files, (None, None), {"resume": True})

    def _logged(self, papers: DataFrame, files: DataFrame, failures: tuple[str | None, str | None], config: dict) -> DataFrame:
        if self.runs is None:
            return self._process(papers, files, *failures)
        runs, number = run_started(self.runs.read(), config)
        self.runs.write(runs)
        todo = papers.select("work_id").join(self.state.read().select("work_id"), "work_id", "left_semi")
        todo = self._staged(todo, "todo")
        state = self._process(papers, files, *failures)
        done = outcome(state, todo).first()
        self.runs.write(run_ended(self.runs.read(), number, done["papers_processed"], done["papers_failed"]))
        self._unstage(todo)
        return state

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        """Written beside the points, so that it is computed once."""
        path = f"{self.points.path}/staging/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _unstage(self, *tables: DataFrame) -> None:
        for df in tables:
            for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
                remove(df.sparkSession, path)

    def _process(self, papers: DataFrame, files: DataFrame, no_file: str | None, no_text: str | None) -> DataFrame:
        tei = files.where("tei is not null").join(papers.select("work_id"), "work_id", "left_semi").select(F.col("work_id").alias("paper_id"), "tei")
        sections = self._staged(extract(tei), "sections")
        chunks = self._staged(chunks_of(sections, self.chars), "chunks")
        self.points.merge(payload(self.embedder.embed(chunks, "chunk_text"), papers.drop("stage")), self.mode)
        n_sections = sections.groupBy("paper_id").agg(F.count(F.lit(1)).cast("int").alias("num_sections"))
        n_chunks = chunks.groupBy("paper_id").agg(F.count(F.lit(1)).cast("int").alias("num_chunks"))
        counts = n_sections.join(n_chunks, "paper_id", "left").withColumnRenamed("paper_id", "work_id")
        has = files.where("tei is not null").select("work_id", F.lit(True).alias("has_file")).distinct()
        own = papers.select("work_id", *([F.col("stage").alias("was")] if "stage" in papers.columns else [F.lit(None).cast("string").alias("was")]))
        both = own.join(has, "work_id", "left").join(counts, "work_id", "left")
        here = F.concat(F.lit("failed_"), F.col("was"))
        stage = F.when(F.col("has_file").isNull(), F.coalesce(here, F.lit(no_file))).when(F.coalesce("num_chunks", F.lit(0)) == 0, F.coalesce(here, F.lit(no_text))).otherwise(STAGES[-1])
        error = F.when(F.col("has_file").isNull(), "PDF not found").when(F.coalesce("num_sections", F.lit(0)) == 0, "no sections").when(F.coalesce("num_chunks", F.lit(0)) == 0, "no chunks")
        changes = both.select("work_id", stage.alias("stage"), "num_sections", "num_chunks", error.alias("error"))
        state = self.state.write(moved(self.state.read(), changes))
        self._unstage(sections, chunks)
        return state
