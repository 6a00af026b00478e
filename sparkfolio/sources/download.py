"""Files fetched by papers' URLs, politely: rows of one host share a partition, which waits between requests."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import host

RESULT = "work_id string, success boolean, pdf_path string, error string"
#: fetch(url) -> (status, content type, bytes); it raises OSError for what may be tried again.
Fetch = Callable[[str], tuple[int, str, bytes]]
#: save(work_id, bytes) -> path, to a place that all machines share.
Save = Callable[[str, bytes], str]


def fetch_one(work_id: str, url: str | None, fetch: Fetch, save: Save, retries: int = 3, sleep: Callable[[float], None] = time.sleep) -> tuple:
    """(work_id, success, pdf_path, error). Failed connections and other statuses than 200 are tried again, after 1, 2, ... seconds."""
    if not url:
        return work_id, False, None, "No PDF URL"
    error = "Max retries exceeded"
    for attempt in range(retries):
        if attempt:
            sleep(2.0 ** (attempt - 1))
        try:
            status, kind, data = fetch(url)
        except OSError as e:
            error = f"{type(e).__name__}: {e}"
            continue
        if status != 200:
            error = f"HTTP {status}"
        elif "pdf" not in kind and "octet-stream" not in kind:
            return work_id, False, None, f"Not a PDF: {kind}"
        elif len(data) < 1000:
            return work_id, False, None, f"File too small: {len(data)} bytes"
        else:
            return work_id, True, save(work_id, data), None
    return work_id, False, None, error


def download(papers: DataFrame, fetch: Fetch, save: Save, have: DataFrame | None = None, at_once: int = 10, pause: float = 1.0, retries: int = 3) -> DataFrame:
    """(work_id, success, pdf_path, error) of ``papers`` (work_id, pdf_url); those in ``have`` (work_id, pdf_path) are not fetched.

    A host's papers are one after another with ``pause`` seconds between requests; ``at_once`` partitions run beside
    each other.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for batch in batches:
            rows = []
            for w, u, h in zip(batch["work_id"], batch["pdf_url"], batch["host"], strict=True):
                wait = last.get(h, -pause) + pause - time.monotonic() if h in last else 0
                if wait > 0:
                    time.sleep(wait)
                rows.append(fetch_one(w, u, fetch, save, retries))
                last[h] = time.monotonic()
            yield pd.DataFrame(rows, columns=["work_id", "success", "pdf_path", "error"])

    todo, done = papers, None
    if have is not None:
        done = papers.join(have, "work_id").select("work_id", F.lit(True).alias("success"), "pdf_path", F.lit(None).cast("string").alias("error"))
        todo = papers.join(have, "work_id", "left_anti")
    fetched = todo.select("work_id", "pdf_url", F.coalesce(host(F.col("pdf_url")), F.lit("")).alias("host")).repartition(at_once, "host").mapInPandas(run, RESULT)
    return fetched if done is None else done.unionByName(fetched)
