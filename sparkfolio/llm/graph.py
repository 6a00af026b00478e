"""Connected components of a graph given as a table of edges, in rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, written


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, comp): the smallest node that each node of ``edges`` reaches.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until the edges stay as they are:
    every step links nodes to the smallest neighbour, so a hub only ever meets grouped minima and joins.
    Nulls and loops in ``edges`` are ignored; no edges give no rows.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        if large:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        met = both.join(least, "u")
        if large:
            out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def state(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    now = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    seen = state(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        then = written(star(star(now, True), False), "edges")
        forget(now)
        now, before, seen = then, seen, state(then)
        if seen == before:
            break
    else:
        raise RuntimeError("the components have not settled")
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("comp")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
