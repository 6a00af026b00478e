"""Five stages from raw documents to sharded training data, each on all that the stage before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkfolio.llm.bloom import bloom, never, only
from sparkfolio.llm.decontamination import contamination
from sparkfolio.llm.mixing import copied, mixed, places, row_mark
from sparkfolio.llm.ngram_join import jaccard_join
from sparkfolio.llm.quality import accepted
from sparkfolio.llm.sharding import shard_report, sharded
from sparkfolio.llm.shared import forget, fresh, scratch, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality ranking does not reject.

    Null texts are ranked as empty ones; repeated rows are ranked alike, so all stay or go; without any label all stay.
    """
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the one of the smallest doc_id (null: the last); of repeated rows, one.

    A row is known by a hash of its doc_id and text: neither a null nor an equal doc_id hides a copy. Blank and null
    texts link with nothing. Rows that surely stay move nowhere; only those that may go are joined. An empty table
    stays empty; extra columns stay as they are.
    """
    mark, least, kind = fresh(docs, "mark", "least", "kind")
    text = F.col("text").cast("string")
    marked = docs.withColumn(mark, F.xxhash64(F.col("doc_id").isNull(), "doc_id", text.isNull(), text, F.lit(7)))
    found = jaccard_join(marked.select(F.col(mark).alias("doc_id"), text.alias("text")), n=5, percent=80)
    groups = found.groupBy(F.col("doc_id").alias(mark)).agg(F.min("component_id").alias("comp"), F.count(F.lit(1)).alias("n"))
    ids = marked.groupBy(mark).agg(F.min("doc_id").alias("id"))
    groups = written(groups.join(ids, mark), "groups")
    best = groups.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", mark))[mark].alias(least), F.count(F.lit(1)).alias("size"))
    best = written(best.where("size > 1").select("comp", least), "best")  # so that the join by component can split a large one
    gone = groups.join(best, "comp").where(F.col(mark) != F.col(least))
    again = groups.where("n > 1").join(gone.select(mark), mark, "left_anti")
    touched = written(gone.select(F.col(mark).alias(least), F.lit(0).alias(kind)).unionByName(again.select(F.col(mark).alias(least), F.lit(1).alias(kind))), "touched")
    bits = bloom(touched)
    stays = marked.mapInArrow(never(mark, bits), marked.schema).select(*docs.columns)
    asked = marked.mapInArrow(only(mark, bits), marked.schema).join(touched, F.col(mark) == F.col(least), "left")
    once = asked.where(F.col(kind) == 1).dropDuplicates([mark, "doc_id", "text"])
    return stays.unionByName(asked.where(F.col(kind).isNull()).select(*docs.columns)).unionByName(once.select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no window of a benchmark item occurs, however long they are.

    Null and empty texts hold no window and stay; repeated rows are held each; an empty benchmark keeps all rows.
    """
    found, (_, n_hit, _) = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.col(n_hit) == 0).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, each copy at its own place in the order of the curriculum.

    Null and empty texts have no words and are not taken; equal rows are taken each by its own place in their source;
    null is a source of its own; an empty table gives none.
    """
    facts = ("size", "source_size", "target", "slope")
    plan = mixed(docs).groupBy("mark").agg(F.max("copies").alias("copies"), F.min("middle").alias("middle"), *[F.min(c).alias(c) for c in facts])
    plan = written(plan.where("copies > 0").select("mark", F.struct("middle", *facts).alias("plan")), "mix")
    mark, own, n, place = fresh(docs, "mark", "plan", "n", "place")
    taken = docs.withColumn(mark, row_mark(docs)).join(plan.select(F.col("mark").alias(mark), F.col("plan").alias(own)), mark)
    taken = taken.withColumn(n, F.row_number().over(Window.partitionBy(mark).orderBy(mark)) - 1)  # of equal rows, which
    size, source_size, target, slope = (F.col(own)[c] for c in facts)
    middle = F.col(own)["middle"] + F.col(n) * size
    taken = taken.withColumn(place, F.explode(places(copied(middle, size, source_size, target), middle, source_size, target, slope)))
    return taken.orderBy(place, mark).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard of the committed version; nulls, repeated rows and extra columns are stored as they are."""
    return shard_report(sharded(docs))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing", source_mix),
    ("sharding", sharding),
]

#: SQL expresses neither the classifier nor the components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; of the tables between them only the last stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
