"""Stages of papers, as DataFrames: registering, pending work, transitions and progress."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import progress_bar

STAGES = ("discovered", "downloaded", "extracted", "chunked", "embedded")
STATE = "work_id string, stage string, pdf_path string, num_sections int, num_chunks int, metadata string, error string, created_at timestamp, updated_at timestamp"
RUNS = "id long, started_at timestamp, ended_at timestamp, papers_processed long, papers_failed long, config string"


def insert_or_ignore(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``existing`` and those rows of ``new`` whose key it lacks, one a key."""
    own = new.dropDuplicates([key]).join(existing.select(key), key, "left_anti")
    return existing.unionByName(own.select(*existing.columns))


def registered(state: DataFrame, papers: DataFrame) -> DataFrame:
    """State with the papers that are new to it as discovered, their metadata as JSON."""
    meta = F.to_json(F.struct(*[F.col(c) for c in papers.columns]))
    now = F.current_timestamp()
    new = papers.select("work_id", F.lit("discovered").alias("stage"), F.lit(None).cast("string").alias("pdf_path"), F.lit(0).alias("num_sections"), F.lit(0).alias("num_chunks"), meta.alias("metadata"), F.lit(None).cast("string").alias("error"), now.alias("created_at"), now.alias("updated_at"))
    return insert_or_ignore(state, new, "work_id")


def unprocessed(papers: DataFrame, state: DataFrame, key: str = "work_id") -> DataFrame:
    """Papers that have not reached the last stage; failed and half-done ones are among them."""
    return papers.join(state.where(F.col("stage") == STAGES[-1]).select(key), key, "left_anti")


def moved(state: DataFrame, changes: DataFrame) -> DataFrame:
    """State after ``changes`` (work_id, stage and any of pdf_path, num_sections, num_chunks, error); success clears the error."""
    fields = [c for c in ("stage", "pdf_path", "num_sections", "num_chunks") if c in changes.columns]
    error = F.col("new.error") if "error" in changes.columns else F.lit(None).cast("string")
    hit = F.col("new.work_id").isNotNull()
    both = state.alias("old").join(changes.alias("new"), F.col("old.work_id") == F.col("new.work_id"), "left")
    out = {c: F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")) for c in fields}
    out |= {"error": F.when(hit, error).otherwise(F.col("old.error")), "updated_at": F.when(hit, F.current_timestamp()).otherwise(F.col("old.updated_at"))}
    return both.select(*[out.get(c, F.col(f"old.{c}")).alias(c) for c in state.columns])


def pending(state: DataFrame, stage: str, limit: int = 0) -> DataFrame:
    """Papers that stand one stage before ``stage``, in the order of their ids."""
    at = STAGES[STAGES.index(stage) - 1]
    out = state.where(F.col("stage") == at).orderBy("work_id")
    return out.limit(limit) if limit else out


def failed(stage: str) -> str:
    return f"failed_{stage}"


def after_resume(stage: Column, has_file: Column, processed: Column) -> Column:
    """The stage after one pass of resuming: papers in the middle stages are done whole or fail under their stage's name."""
    middle = stage.isin(*STAGES[1:-1])
    return F.when(~middle, stage).when(~has_file | ~processed, F.concat(F.lit("failed_"), stage)).otherwise(STAGES[-1])


def progress(state: DataFrame) -> DataFrame:
    """(stage, cnt, bar), with the total of all; an empty state has a total of 0."""
    counts = state.groupBy("stage").agg(F.count(F.lit(1)).alias("cnt"))
    total = state.agg(F.lit("total").alias("stage"), F.count(F.lit(1)).alias("cnt"))
    return counts.unionByName(total).withColumn("bar", progress_bar(F.col("cnt")))


def work_left(state: DataFrame) -> DataFrame:
    return state.agg(F.count_if(F.col("stage").isin(*STAGES[:-1])).alias("pending"))


def metadata(state: DataFrame, schema: str) -> DataFrame:
    """(work_id and the fields of ``schema``) from the metadata that papers were registered with; null where it is no JSON."""
    return state.select("work_id", F.from_json("metadata", schema).alias("m")).select("work_id", "m.*")


def run_started(runs: DataFrame, config: dict | None = None) -> tuple[DataFrame, int]:
    """The run log with a run more, and its id: one above the largest."""
    number = (runs.agg(F.max("id")).first()[0] or 0) + 1
    new = runs.sparkSession.range(1).select(F.lit(number).cast("long").alias("id"), F.current_timestamp().alias("started_at"), F.lit(json.dumps(config or {})).alias("config"))
    return runs.unionByName(new, allowMissingColumns=True), number


def run_ended(runs: DataFrame, number: int, papers_processed: int, papers_failed: int) -> DataFrame:
    """The run log with the end of a run; an unknown run changes nothing."""
    own = F.col("id") == number
    now = {"ended_at": F.current_timestamp(), "papers_processed": F.lit(papers_processed).cast("long"), "papers_failed": F.lit(papers_failed).cast("long")}
    return runs.select(*[F.when(own, now[c]).otherwise(F.col(c)).alias(c) if c in now else F.col(c) for c in runs.columns])


def outcome(state: DataFrame, papers: DataFrame) -> DataFrame:
    """One row (papers_processed, papers_failed): of ``papers`` (work_id), those that the state has at the last stage, and failed."""
    own = state.join(papers.select("work_id").distinct(), "work_id", "left_semi")
    return own.agg(F.count_if(F.col("stage") == STAGES[-1]).alias("papers_processed"), F.count_if(F.col("stage").startswith("failed_")).alias("papers_failed"))


def chunk_counters(chunks: DataFrame, section: list[str]) -> DataFrame:
    """One row (sections_chunked, total_chunks) of chunks whose sections are told apart by the columns ``section``."""
    return chunks.groupBy(*section).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("sections_chunked"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_chunks"))
