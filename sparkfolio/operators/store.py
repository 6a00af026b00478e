"""The table of vector points: payloads, upserts and deletions as new snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import point_id
from ..sources.files import Versions, hadoop_path, remove


def payload(chunks: DataFrame, papers: DataFrame) -> DataFrame:
    """Points: chunks with a vector joined to their papers, with defaults for what is missing and a stable id."""
    meta = papers.select(
        F.col("work_id").alias("paper_id"),
        F.coalesce("doi", F.lit("")).alias("doi"),
        F.coalesce("title", F.lit("")).alias("title"),
        "authors",
        "year",
        F.coalesce("citation_count", F.lit(0)).alias("citation_count"),
        F.coalesce("journal", F.lit("")).alias("journal"),
    )
    own = chunks.where("embedding is not null").withColumn("point_id", point_id(F.col("paper_id"), F.col("section"), F.col("chunk_index")))
    fields = ["point_id", "embedding", "paper_id", "doi", "title", "authors", "year", "citation_count", "journal", "chunk_text", "section", "section_type", "section_order", "chunk_index", "total_chunks"]
    return own.join(meta, "paper_id").select(*fields, F.lit("sentence_split").alias("chunking_method"))


def upsert(old: DataFrame, new: DataFrame, key: str = "point_id", order: str | None = None) -> DataFrame:
    """New rows win by key. Of new rows of one key the last by ``order`` counts; without one, any, so equal keys must not differ."""
    if order is None:
        last = new.dropDuplicates([key])
    else:
        newest = Window.partitionBy(key).orderBy(F.desc(order))
        last = new.withColumn("newest", F.row_number().over(newest)).where("newest = 1").drop("newest")
    return old.join(new.select(key).distinct(), key, "left_anti").select(*old.columns).unionByName(last.select(*old.columns))


def replace_papers(old: DataFrame, new: DataFrame, paper: str = "paper_id") -> DataFrame:
    """All rows of the papers in ``new`` are replaced, so that none of an earlier and longer version stays."""
    return old.join(new.select(paper).distinct(), paper, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def without_paper(points: DataFrame, paper_id) -> DataFrame:
    return points.where(F.col("paper_id") != paper_id)


class Snapshots:
    """A table kept as immutable snapshot folders, by versions that one rename publishes; the last ``keep`` of them stay."""

    def __init__(self, spark: SparkSession, path: str, schema, keep: int = 3):
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep
        self.versions = Versions(spark, f"{self.path}/versions")

    def read(self) -> DataFrame:
        numbers = self.versions.numbers()
        if not numbers:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{self.versions.read(numbers[-1])['data']}")

    def write(self, df: DataFrame) -> DataFrame:
        name, last = f"data/{uuid.uuid4().hex}", (self.versions.numbers() or [0])[-1]
        df.write.parquet(f"{self.path}/{name}")
        self.versions.publish({"data": name}, last)
        for number in self.versions.numbers()[: -self.keep]:
            remove(self.spark, f"{self.path}/{self.versions.read(number)['data']}")
            self.versions.drop(number)
        return self.read()


class Points:
    """The table of points in buckets of papers. A write rewrites the buckets of its papers alone; a version lists a folder for each bucket.

    Created when first written. Vectors must have ``width`` components: others are an error, as in a collection of that
    width. Year, citations and section types prune row groups, since a bucket's rows are sorted by section type and year.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, width: int | None = None, buckets: int = 64, keep: int = 3):
        self.spark, self.path, self.schema, self.width, self.buckets, self.keep = spark, path.rstrip("/"), schema, width, buckets, keep
        self.versions = Versions(spark, f"{self.path}/versions")

    def _last(self) -> tuple[int, dict]:
        numbers = self.versions.numbers()
        return (numbers[-1], self.versions.read(numbers[-1])) if numbers else (0, {"buckets": self.buckets, "folders": {}})

    def _rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], self.schema)

    def ensure(self) -> None:
        """Create the table if there is none."""
        if not self.versions.numbers():
            self.versions.publish({"buckets": self.buckets, "folders": {}}, 0)

    def read(self) -> DataFrame:
        return self._rows(sorted(self._last()[1]["folders"].values()))

    def merge(self, new: DataFrame, mode: str = "replace") -> DataFrame:
        """Points with those of ``new``: in place of all their papers' ("replace"), or by point_id ("upsert")."""
        last, now = self._last()
        bucket = F.pmod(F.xxhash64("paper_id"), F.lit(now["buckets"])).cast("int")
        if self.width is not None:
            bad = F.size("embedding") != self.width
            new = new.withColumn("embedding", F.when(bad, F.raise_error(F.lit(f"a vector has not {self.width} components"))).otherwise(F.col("embedding")))
        landed = f"data/{uuid.uuid4().hex}"
        new.select(*self.read().columns).withColumn("bucket", bucket).write.parquet(f"{self.path}/{landed}")  # computed once
        rows = self.spark.read.parquet(f"{self.path}/{landed}")
        touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # at most the buckets
        if touched:
            old = self._rows([f for b, f in now["folders"].items() if int(b) in touched])
            fresh = rows.drop("bucket")
            out = replace_papers(old, fresh) if mode == "replace" else upsert(old, fresh)
            to = f"data/{uuid.uuid4().hex}"
            placed = out.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("bucket", "section_type", "year")
            placed.write.partitionBy("bucket").parquet(f"{self.path}/{to}")
            fs, p = hadoop_path(self.spark, f"{self.path}/{to}")
            have = {f.getPath().getName().removeprefix("bucket=") for f in fs.listStatus(p) if f.getPath().getName().startswith("bucket=")}
            folders = {b: f for b, f in now["folders"].items() if int(b) not in touched} | {b: f"{to}/bucket={b}" for b in sorted(have)}
            self.versions.publish({"buckets": now["buckets"], "folders": folders}, last)
        remove(self.spark, f"{self.path}/{landed}")
        self._clean()
        return self.read()

    def _clean(self) -> None:
        """Drop versions beyond the last ``keep`` and the folders that only those list."""
        numbers = self.versions.numbers()
        gone, stay = numbers[: -self.keep], numbers[-self.keep :]
        held = {f for n in stay for f in self.versions.read(n)["folders"].values()}
        for n in gone:
            for folder in set(self.versions.read(n)["folders"].values()) - held:
                remove(self.spark, f"{self.path}/{folder}")
            self.versions.drop(n)
