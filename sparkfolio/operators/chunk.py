"""Sentences packed greedily into chunks of bounded length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, sentences

CHARS = 1000


def packed(text: Column, chars: int = CHARS) -> Column:
    """Array of chunks: sentences joined by a space while they fit ``chars``; a longer sentence stands alone."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def close(acc):
        return F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))

    def add(acc, s):
        over = F.length(s) > chars
        full = F.length(acc["open"]) + F.length(s) + 1 > chars
        done = F.when(over, F.concat(close(acc), F.array(s))).when(full, close(acc)).otherwise(acc["done"])
        then = F.when(over, F.lit("")).when(full | (acc["open"] == ""), s).otherwise(F.concat_ws(" ", acc["open"], s))
        return F.struct(done.alias("done"), then.alias("open"))

    return F.aggregate(sentences(text), empty, add, close)


def chunk(sections: DataFrame, keys: list[str], text: str, chars: int = CHARS) -> DataFrame:
    """One row a chunk of each section: the keys, chunk_index, total_chunks of the section, chunk_text, chunk_len.

    The fold is exploded directly: behind a named column it would be computed twice. Blank texts have no chunks.
    """
    out = sections.where(~is_blank(F.col(text))).select(*keys, F.posexplode(packed(F.col(text), chars)).alias("chunk_index", "chunk_text"))
    total = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return out.select(*keys, "chunk_index", total.alias("total_chunks"), "chunk_text", F.length("chunk_text").alias("chunk_len"))
