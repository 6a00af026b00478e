"""Small files on any file system that Spark reaches, and versions that at most one writer can publish."""

from __future__ import annotations

import json
import os
import time
import uuid

from pyspark.sql import SparkSession

#: Seconds after which a claim that no version has followed is taken for that of a writer that has died.
STALE = 3600.0


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def _create(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there. One of several callers succeeds."""
    fs, p = hadoop_path(spark, path)
    if fs.getUri().getScheme() == "file":
        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        fs.create(p, False).close()
    except Exception:  # the JVM's error for a file that is there differs by file system
        if fs.exists(p):
            return False
        raise
    return True


class Versions:
    """A folder of numbered JSON files. A number is claimed by creating a file that must not exist, and shown whole by one rename."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self) -> list[int]:
        fs, p = hadoop_path(self.spark, self.path)
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def read(self, number: int) -> dict:
        fs, p = hadoop_path(self.spark, f"{self.path}/v{number:08d}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def age(self, number: int) -> float:
        """Seconds since a version was published."""
        fs, p = hadoop_path(self.spark, f"{self.path}/v{number:08d}.json")
        return time.time() - fs.getFileStatus(p).getModificationTime() / 1000

    def publish(self, content: dict, after: int) -> int:
        """Publish ``content`` as the version that follows ``after``; RuntimeError if another writer has, or is about to."""
        number = after + 1
        if number in self.numbers():
            raise RuntimeError(f"version {number} is there already")
        claim = f"{self.path}/.claim-{number:08d}"
        if not _create(self.spark, claim):
            fs, p = hadoop_path(self.spark, claim)
            if time.time() - fs.getFileStatus(p).getModificationTime() / 1000 < STALE:
                raise RuntimeError(f"version {number} is claimed by another writer")
            fs.delete(p, False)
            if not _create(self.spark, claim):
                raise RuntimeError(f"version {number} is claimed by another writer")
        fs, tmp = hadoop_path(self.spark, f"{self.path}/.{uuid.uuid4().hex}")
        stream = fs.create(tmp, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        _, to = hadoop_path(self.spark, f"{self.path}/v{number:08d}.json")
        if fs.exists(to) or not fs.rename(tmp, to):
            fs.delete(tmp, False)
            raise RuntimeError(f"version {number} is there already")
        return number

    def drop(self, number: int) -> None:
        """Remove a version; its claim stays, so that the number is not given again."""
        remove(self.spark, f"{self.path}/v{number:08d}.json")
