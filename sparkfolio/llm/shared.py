"""Tables written to the shared checkpoint folder, and small helpers on columns.

Lineage is cut only by writing Parquet below ``spark.checkpoint.dir``: an executor that is lost takes no
part of such a table with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import hadoop_path, remove

__all__ = ["bounded", "folder", "forget", "fresh", "hadoop_path", "joined", "new_path", "remove", "scratch", "table", "written"]

BATCH = 8 << 20
#: Paths of tables in the order that they were written in, for ``scratch``.
_made: list[str] = []


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, and on one machine, where it is unset, one below the warehouse."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not given:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        given = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    return given.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/sparkfolio/{name}-{uuid.uuid4().hex}"


def bounded(spark: SparkSession) -> None:
    """Hand rows to Python workers in Arrow batches of at most ``BATCH`` bytes, however long texts are, unless the session says otherwise."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH))


@contextmanager
def _freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that made them ends; else they stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a Parquet table in the shared folder."""
    spark = df.sparkSession
    bounded(spark)
    path = new_path(spark, name)
    _made.append(path)
    with _freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what ``written`` has made meanwhile, but for the last table: the result of the others."""
    start = len(_made)
    yield
    for path in _made[start:-1]:
        remove(spark, path)
    del _made[start:-1]


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and that nothing will read again."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            remove(df.sparkSession, path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, whatever extra columns it carries."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = f"_{n}"
        have.add(n.lower())
        out.append(n)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(values: Column) -> Column:
    return F.array_join(values, ",")
