"""Papers from a live metadata index that the caller can ask page by page; the criteria are asked of the index, not of its rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import asdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..operators.discovery import Criteria
from .readers import WORKS

#: fetch(query, part, parts, after, size) -> (documents, where to go on or None): a page of one of the parts that the index is split into.
Fetch = Callable[[dict, int, int, object, int], tuple[list[dict], object]]
PAGE = 500


def query_of(criteria: Criteria) -> dict:
    """What the index is asked for: the bounds, the language, a location that names a file, and the fields that are read."""
    asked = {k: v for k, v in asdict(criteria).items() if k != "max_papers"}
    return asked | {"has_file": True, "fields": [f.split(" ")[0] for f in _split(WORKS)]}


def _split(schema: str) -> list[str]:
    """The fields of a schema; commas within <> part none."""
    out, depth = [""], 0
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [f.strip() for f in out]


def works_of_index(spark: SparkSession, fetch: Fetch, criteria: Criteria = Criteria(), parts: int = 8, page: int = PAGE) -> DataFrame:
    """The raw metadata of the papers that meet ``criteria``, in the schema of ``WORKS``; a task reads a part, a page at a time.

    Documents may lack fields, which are null, and have others, which are left out.
    """
    query = query_of(criteria)
    schema = to_arrow_schema(_parse_datatype_string(WORKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("id").to_pylist():
                after = None
                while True:
                    documents, after = fetch(query, part, parts, after, page)
                    if documents:
                        yield pa.RecordBatch.from_pylist([{f.name: d.get(f.name) for f in schema} for d in documents], schema=schema)
                    if after is None:
                        break

    return spark.range(0, parts, 1, parts).mapInArrow(run, WORKS)
