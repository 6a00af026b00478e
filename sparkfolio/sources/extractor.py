"""Structured XML of landed files from a service that the caller names, and files that are no longer needed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: call(file name, bytes) -> (status, text); it raises OSError (or TimeoutError) if the service does not answer.
Call = Callable[[str, bytes], tuple[int, str]]
#: delete(path), of a file that may be gone already.
Delete = Callable[[str], None]


def extract_one(name: str, data: bytes, call: Call) -> str | None:
    """The service's XML; null for any other status than 200, and if it does not answer."""
    try:
        status, text = call(name, data)
    except OSError:
        return None
    return text if status == 200 else None


def extracted(files: DataFrame, call: Call, at_once: int = 10) -> DataFrame:
    """(work_id, tei) of ``files`` (work_id, pdf_path); tei is null where the service gives none.

    Files are read by Spark, one after another in each of ``at_once`` partitions, and sent as they are.
    """
    spark = files.sparkSession
    paths = [r["pdf_path"] for r in files.select("pdf_path").limit(1).collect()]
    if not paths:
        return spark.createDataFrame([], "work_id string, tei string")
    folder = F.regexp_replace("pdf_path", r"/[^/]*$", "")
    folders = [r[0] for r in files.select(folder).distinct().collect()]  # folders that files were landed in, few
    read = spark.read.format("binaryFile").load(folders)
    bare = lambda c: F.regexp_replace(c, r"^[a-z]+:/+", "/")
    both = files.select("work_id", bare(F.col("pdf_path")).alias("at")).join(read.select(bare(F.col("path")).alias("at"), "content"), "at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [extract_one(at.rsplit("/", 1)[-1], bytes(content), call) for at, content in zip(batch["at"], batch["content"], strict=True)]
            yield pd.DataFrame({"work_id": batch["work_id"], "tei": found})

    return both.repartition(at_once, "work_id").mapInPandas(run, "work_id string, tei string")


def discard(files: DataFrame, delete: Delete) -> int:
    """Delete the files of ``files`` (pdf_path), whatever became of their papers; how many there were."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["pdf_path"]:
                delete(path)
            yield pd.DataFrame({"n": [len(batch)]})

    return files.where("pdf_path is not null").select("pdf_path").distinct().mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
