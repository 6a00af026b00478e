"""Inputs: metadata indexes, structured XML, landed files; and results as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORKS = (
    "work_id string, doi string, title string, authors array<struct<display_name:string>>, publication_year int, cited_by_count int, language string, "
    "best_locations array<struct<pdf_url:string,source_id:string,display_name:string>>, locations array<struct<pdf_url:string,display_name:string>>"
)


def works(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """A dump of a metadata index; only the columns and nested fields that are used are read."""
    return spark.read.schema(WORKS).format(kind).load(path)


def tei(spark: SparkSession, path: str) -> DataFrame:
    """(paper_id, tei) from a folder of XML files named by paper."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return spark.read.text(path, wholetext=True).select(F.regexp_replace(name, r"(\.tei)?\.xml$", "").alias("paper_id"), F.col("value").alias("tei"))


def landed(spark: SparkSession, path: str, least: int = 1000) -> DataFrame:
    """(work_id, pdf_path) of the files in a folder that are larger than ``least`` bytes; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(F.col("length") > least).select(F.regexp_replace(name, r"\.pdf$", "").alias("work_id"), F.col("path").alias("pdf_path"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
