"""Mixing sources to target weights along a time-varying curriculum (operator 2).

Each source's weight is a line over training time t in [0, 1]; its integral up to t is the source's cumulative
token demand, which is inverted in closed form: the word that is x of the way through a source's target stands at
the t where the demand reaches x. Documents are sorted by that position. Everything is DataFrame expressions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import table, written

WORD = r"[^\x20\x09-\x0D]+"
SEED = 20240607


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Sources in code-point order, null last, take ``weights`` in turn. Targets add up to ``share`` of all sizes in
    proportion to the weights; none exceeds ``most`` times its source's size, and what one cannot take goes to the
    others by weight. Sorting by the level at which a source is full gives that without iterating.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    which = (F.row_number().over(order) - 1) % len(weights) + 1
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), which.cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    ranked = ranked.withColumn("full_at", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = (
        ranked.withColumn("before", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("level", (F.col("total") - F.col("before")) / F.col("open"))
        .withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("water", F.min(F.when(F.col("free"), F.struct("full_at", "level"))).over(every)["level"])
    )
    return filled.select("source", "source_size", F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("water") * F.col("weight"))).alias("target"))


def position(done: Column, slope: Column) -> Column:
    """The t in [0, 1] at which a weight of 1 + slope * (1 - 2t) has met the part ``done`` of its demand."""
    done = F.least(F.greatest(done, F.lit(0.0)), F.lit(1.0))
    root = F.sqrt(F.greatest((1 + slope) * (1 + slope) - 4 * slope * done, F.lit(0.0)))
    return F.when(slope == 0, done).otherwise(2 * done / (1 + slope + root))


def row_mark(docs: DataFrame, seed: int = SEED) -> Column:
    """A hash of a row's id, source and text: equal rows share it."""
    return F.xxhash64(docs["doc_id"].cast("string"), docs["source"].cast("string"), F.coalesce(docs["text"].cast("string"), F.lit("")), F.lit(seed))


def copied(middle: Column, size: Column, source_size: Column, target: Column) -> Column:
    """How many times a document is taken whose middle word is the ``middle``-th of its source."""
    whole = F.floor(F.try_divide(target, source_size))
    rest = target - whole * source_size
    return F.when((source_size == 0) | (size == 0), 0).otherwise(whole + F.when(middle <= rest, 1).otherwise(0)).cast("long")


def places(copies: Column, middle: Column, source_size: Column, target: Column, slope: Column) -> Column:
    """The position of each of a document's copies: pass p (from 0) stands p * source_size words further on in the source's demand."""
    passes = F.sequence(F.lit(0).cast("long"), F.greatest(copies, F.lit(1)) - 1)
    each = F.transform(passes, lambda p: position((p * source_size + middle) / target, slope))
    return F.when(copies > 0, each).otherwise(F.array().cast("array<double>"))


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    slopes: Sequence[float] = (0.5, 0.0, -0.5),
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, mark, size, source_size, target, copies, taken, position, positions, middle, slope) for every row of ``docs``.

    size is the number of words of the text (null: 0). A source of target T and size S takes its documents in the
    order of a hash: all of them floor(T / S) times, and once more those whose middle word lies below the rest of T.
    So taken (copies * size) differs from the target by about half a document, and no document is taken more than
    ``most`` times. Pass p of a document (from 0) stands where the source has given p * S words and those up to the
    document's middle: positions are those places on the curriculum, one for each copy, and position is the first
    (null if it is not taken). Of equal rows, each has a middle ``size`` words after that of the one before. Empty texts
    take nothing; a source without words has target 0; null is a source of its own, the last. Repeated rows count each; equal rows are interchangeable. Reruns agree. mark is the hash by which a row
    is found again. Other columns are not read.
    """
    spark = docs.sparkSession
    base = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), row_mark(docs, seed).alias("mark"), n_words(F.col("text").cast("string")).alias("size")), "sizes")
    n = base.count()
    buckets = 1 << max(6, math.ceil(math.log2(max(n, 1)) / 2))  # about as many as a bucket has rows
    base = base.withColumn("bucket", F.pmod("mark", F.lit(buckets)))

    parts = written(base.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    goal = targets(parts.groupBy("source").agg(F.sum("words").cast("long").alias("source_size")), weights, share, most)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    slope = F.element_at(F.array(*[F.lit(float(s)) for s in slopes]), (rank % len(slopes) + 1).cast("int"))
    goal = goal.withColumn("slope", slope).withColumnRenamed("source", "s")
    ahead = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.withColumn("start", F.coalesce(ahead, F.lit(0)))
    starts = starts.join(goal, starts["source"].eqNullSafe(goal["s"])).select(F.col("source").alias("s"), F.col("bucket").alias("k"), "start", "source_size", "target", "slope")
    starts = written(starts, "starts")

    rows = base.join(starts, base["source"].eqNullSafe(starts["s"]) & (base["bucket"] == starts["k"])).drop("s", "k")
    inside = Window.partitionBy("source", "bucket").orderBy("mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = F.col("start") + F.sum("size").over(inside)
    spot = rows.withColumn("middle", ends - F.col("size") / 2)
    out = spot.withColumn("copies", copied(F.col("middle"), F.col("size"), F.col("source_size"), F.col("target")))
    out = out.withColumn("taken", F.col("copies") * F.col("size"))
    out = out.withColumn("positions", places(F.col("copies"), F.col("middle"), F.col("source_size"), F.col("target"), F.col("slope")))
    out = out.withColumn("position", F.get("positions", F.lit(0)))
    return out.select("doc_id", "source", "mark", "size", "source_size", "target", "copies", "taken", "position", "positions", "middle", "slope")


def takes(docs: DataFrame, **options) -> DataFrame:
    """``mixed`` with a row for each copy that is taken, at a position of its own, range-sorted: training order, repeats included."""
    each = mixed(docs, **options).withColumn("position", F.explode("positions")).drop("positions")
    return each.orderBy("position", "mark", "doc_id")


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """``mixed``, range-sorted by the first position, with the rows that are not taken last; ``takes`` has the repeats.

    Every row of ``docs`` is there, null and empty texts and repeated rows too; extra columns are not; an empty table gives none.
    """
    return mixed(docs, **options).orderBy(F.col("position").asc_nulls_last(), "mark", "doc_id")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """The whole of ``documents``: sources weigh 3, 1, 2 in turn and share 150% of all words; positions has every copy's."""
    return curriculum(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "position", F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))
