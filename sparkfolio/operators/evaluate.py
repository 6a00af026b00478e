"""Measures of retrieval and of the geometry of embeddings."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import query_sentence, sentences, strip
from ..functions.vectors import unit

#: Slots of generated queries in order of priority, with the label of their queries.
SLOTS = (
    ("abstract", "abstract_sentence"),
    ("methods", "method_phrase"),
    ("introduction", "method_phrase"),
    ("body_section", "method_phrase"),
    ("results", "result_phrase"),
    ("conclusion", "result_phrase"),
    ("discussion", "result_phrase"),
)


def pick(seed: int, paper_id: Column, slot: Column, sentence: Column) -> Column:
    """An order of candidate sentences that is arbitrary but the same in any engine."""
    return F.sha1(F.concat_ws(":", F.lit(str(seed)), paper_id.cast("string"), slot.cast("string"), sentence).cast("binary"))


def sentence_queries(chunks: DataFrame, seed: int = 42) -> DataFrame:
    """(paper_id, slot, query_type, query_text): for each paper and slot one sentence of the first chunk that has a fit one.

    ``chunks`` has paper_id, point_id, section_type and chunk_text.
    """
    types = F.array(*[F.lit(t) for t, _ in SLOTS])
    labels = F.array(*[F.lit(x) for _, x in SLOTS])
    own = chunks.withColumn("slot", F.array_position(types, F.col("section_type")).cast("int")).where("slot > 0")
    own = own.select("paper_id", "point_id", "slot", F.explode(sentences(F.col("chunk_text"))).alias("sentence")).where(query_sentence(F.col("sentence")))
    first = Window.partitionBy("paper_id", "slot").orderBy("point_id", pick(seed, F.col("paper_id"), F.col("slot"), F.col("sentence")), "sentence")
    own = own.withColumn("r", F.row_number().over(first)).where("r = 1")
    return own.select("paper_id", "slot", F.element_at(labels, F.col("slot")).alias("query_type"), strip(F.col("sentence")).alias("query_text"))


def benchmark_queries(chunks: DataFrame, per_paper: int = 3, seed: int = 42) -> DataFrame:
    """Title first, then the sentence queries by priority, ``per_paper`` in all; papers whose first chunk has no title have none."""
    first = Window.partitionBy("paper_id").orderBy("point_id")
    titles = chunks.withColumn("r", F.row_number().over(first)).where("r = 1 and coalesce(title, '') <> ''")
    titles = titles.select("paper_id", F.lit(0).alias("slot"), F.lit("title").alias("query_type"), F.col("title").alias("query_text"))
    own = sentence_queries(chunks, seed).join(titles.select("paper_id"), "paper_id", "left_semi")
    order = Window.partitionBy("paper_id").orderBy("slot")
    return titles.unionByName(own).withColumn("r", F.row_number().over(order)).where(F.col("r") <= max(per_paper, 1)).drop("r")


def rank_of_source(queries: DataFrame, ranked: DataFrame) -> DataFrame:
    """``queries`` (query_id, query_type, source) with the rank of the source among the ranked papers, null if it is not there."""
    at = ranked.select("query_id", F.col("paper_id").alias("source"), "rank")
    return queries.join(at, ["query_id", "source"], "left")


def retrieval_metrics(ranks: DataFrame, k: int = 10) -> DataFrame:
    """Recall at 1, 5 and 10 and mean reciprocal rank, over all queries ('ALL') and for each type. No queries: zeros."""

    def recall(n: int) -> Column:
        return F.coalesce(F.bround(F.avg(F.when(F.col("rank") <= n, 1.0).otherwise(0.0)), 3), F.lit(0.0))

    measures = [
        F.count(F.lit(1)).alias("total"),
        F.count("rank").alias("found"),
        recall(1).alias("recall_at_1"),
        recall(5).alias("recall_at_5"),
        recall(min(10, k)).alias("recall_at_10"),
        F.coalesce(F.bround(F.avg(F.coalesce(1.0 / F.col("rank"), F.lit(0.0))), 3), F.lit(0.0)).alias("mrr"),
    ]
    return ranks.groupBy("query_type").agg(*measures).unionByName(ranks.agg(F.lit("ALL").alias("query_type"), *measures))


def not_compared(hits: DataFrame) -> DataFrame:
    """As ``compare``, where the second collection cannot be asked: ``hits`` is (query_id, in_a); only the first one's recall is known."""
    recall = F.bround(F.count_if("in_a") / F.greatest(F.count(F.lit(1)), F.lit(1)), 3)
    unknown = [F.lit(None).cast("long").alias(c) for c in ("both", "a_only", "b_only", "neither")]
    return hits.agg(recall.alias("recall_a")).select(*unknown, "recall_a", F.lit(None).cast("double").alias("recall_b"))


def compare(hits: DataFrame) -> DataFrame:
    """Queries by which of two collections found their source: ``hits`` is (query_id, in_a, in_b)."""
    a, b = F.col("in_a"), F.col("in_b")
    counts = hits.agg(F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("a_only"), F.count_if(~a & b).alias("b_only"), F.count_if(~a & ~b).alias("neither"), F.count(F.lit(1)).alias("n"))
    n = F.greatest(F.col("n"), F.lit(1))
    return counts.select("both", "a_only", "b_only", "neither", F.bround((F.col("both") + F.col("a_only")) / n, 3).alias("recall_a"), F.bround((F.col("both") + F.col("b_only")) / n, 3).alias("recall_b"))


def length_stats(chunks: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Count, mean, median and outer percentiles (exact, linear) of the chunk lengths of each group."""
    n = F.length(text)
    marks = F.percentile(n, F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    out = chunks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg(n), 1).alias("avg_len"), marks.alias("p"))
    return out.select(*keys, "n", "avg_len", *[F.bround(F.element_at("p", i + 1), 1).alias(c) for i, c in ((1, "median_len"), (0, "p5_len"), (2, "p95_len"))])


def _sums(points: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, n, own, sum): vectors, how many of them are not zero, and the sum of the unit vectors, for each key. Vectors have one length."""
    u = points.where(F.col(vector).isNotNull()).select(key, unit(F.col(vector)).alias("u"))
    u = u.select(key, F.exists("u", lambda x: x != 0).cast("int").alias("own"), array_to_vector("u").alias("u"))
    out = u.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("own"), Summarizer.sum(F.col("u")).alias("sum"))
    return out


def _square(sum: str) -> Column:
    return F.aggregate(vector_to_array(F.col(sum)), F.lit(0.0), lambda s, x: s + x * x)


def mean_similarity(points: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """(key, sim): the mean cosine of all pairs with the same key, of keys with two vectors at least.

    The sum over pairs is half of the squared norm of the sum less the squared norms: no pair is formed. Zero
    vectors count as similar to nothing.
    """
    s = _sums(points, key, vector).where("n >= 2")
    return s.select(key, ((_square("sum") - F.col("own")) / (F.col("n") * (F.col("n") - 1))).alias("sim"))


def cross_similarity(points: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """One row: the mean cosine of all pairs with different keys (0 if there are none); zero vectors are left out.

    The expectation of sampling such pairs, in place of a sample.
    """
    s = _sums(points, key, vector).where("own > 0")
    out = s.groupBy(F.lit(0).alias("one")).agg(Summarizer.sum(F.col("sum")).alias("all"), F.sum(_square("sum")).alias("same"), F.sum("own").alias("n"), F.sum(F.col("own") * F.col("own")).alias("nn"))
    pairs = F.nullif(F.col("n") * F.col("n") - F.col("nn"), F.lit(0))
    found = out.select("one", F.try_divide(_square("all") - F.col("same"), pairs).alias("sim"))
    return points.sparkSession.range(1).select(F.lit(0).alias("one")).join(found, "one", "left").select(F.coalesce("sim", F.lit(0.0)).alias("sim"))


def separation(intra: Column, inter: Column) -> Column:
    """The ratio of two rounded similarities, infinite where nothing is similar across."""
    return F.when(inter > 0, F.bround(intra / inter, 3)).otherwise(F.lit(float("inf")))


def separation_label(ratio: Column) -> Column:
    return F.when(ratio > 1.5, "good").when(ratio < 1.2, "low").otherwise("")
