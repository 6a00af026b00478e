"""Shards of near-equal size by size-tiered compaction, under a versioned manifest (operator 8).

Arrivals are appended as small immutable files. Runs of similar size are merged, tier by tier, until they have the
target size; which files make a run is decided on their sizes alone, and one job then writes all runs, a task each. A
version is a manifest that lists its files with their bytes and rows. A writer claims the next version by creating a
file that must not exist, so that one of several publishes it; the manifest appears whole, by one rename.
"""

from __future__ import annotations

import math
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import Versions
from .shared import fresh, hadoop_path, new_path, table

TARGET, SMALL, FANOUT = 64 << 20, 8 << 20, 4
#: Row groups of merged files: what a writing task holds at once.
GROUP = 16 << 20
#: Files whose numbers are broadcast at most.
NAMED = 100_000
#: Versions that stay readable, and the seconds for which a file that none of them lists may belong to a writer at work.
KEEP, AGE = 3, 7 * 86400.0


def _name(path: str) -> str:
    """A file's folder and name, by which rows find it."""
    return "/".join(path.rsplit("/", 2)[-2:])


def _files(spark: SparkSession, path: str) -> list[dict]:
    """Data files below a folder with their bytes and age in seconds."""
    fs, p = hadoop_path(spark, path)
    out, found = [], fs.listFiles(p, True) if fs.exists(p) else None
    while found is not None and found.hasNext():
        f = found.next()
        if f.getPath().getName().startswith("part-"):
            out.append({"path": f.getPath().toString(), "bytes": f.getLen(), "age": time.time() - f.getModificationTime() / 1000})
    return sorted(out, key=lambda f: f["path"])


def _counted(spark: SparkSession, path: str) -> list[dict]:
    """The files of a folder that was just written, with bytes and rows; the rows are in the files' footers."""
    found = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a file, as in the manifest
    rows = {_name(r["f"]): r["n"] for r in found}
    return [{"path": f["path"], "bytes": f["bytes"], "rows": rows.get(_name(f["path"]), 0)} for f in _files(spark, path)]


def _numbered(rows: DataFrame, facts: list[tuple], schema: str) -> DataFrame:
    """``rows`` of a scan with the columns of ``schema``, whose first is the file (folder/name) that a row comes from and does not stay."""
    (name,) = fresh(rows, "file")
    own = rows.sparkSession.createDataFrame(facts, f"{name} string, {schema}")
    of = F.concat_ws("/", F.slice(F.split(F.input_file_name(), "/"), -2, 2))
    small = len(facts) <= NAMED  # about 20 MB of names; beyond that the rows are joined by file
    return rows.withColumn(name, of).join(F.broadcast(own) if small else own, name).drop(name)


def tier(size: int, small: int, fanout: int) -> int:
    return max(0, math.floor(math.log(max(size, 1) / small, fanout))) if size > small else 0


def plan(sizes: list[int], target: int = TARGET, small: int = SMALL, fanout: int = FANOUT) -> list[list[int]]:
    """Runs (lists of positions in ``sizes``) after merging runs of one tier, smallest tier first.

    A tier of fewer than ``fanout`` runs waits, unless it is below the last; runs of ``target`` or more are done. No
    merge exceeds ``target`` by more than its last run, and every position is in exactly one run.
    """
    runs = [([i], s) for i, s in enumerate(sizes)]
    top = tier(target, small, fanout)
    for t in range(top + 1):
        own = [r for r in runs if r[1] < target and tier(r[1], small, fanout) <= t]
        if len(own) < 2 or (t == top and len(own) < fanout and sum(r[1] for r in own) > target):
            continue
        runs = [r for r in runs if not (r[1] < target and tier(r[1], small, fanout) <= t)]
        most = min(target, small * fanout ** (t + 1))
        held, n = [], 0
        for at, s in own:
            if held and n + s > most:
                runs.append((held, n))
                held, n = [], 0
            held, n = held + at, n + s
        runs.append((held, n))
    return [sorted(at) for at, _ in sorted(runs)]


class Store:
    """A folder of immutable files and the manifests that list them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.published = Versions(spark, f"{self.path}/manifest")

    def versions(self) -> list[int]:
        return self.published.numbers()

    def manifest(self, version: int | None = None) -> dict:
        versions = self.versions()
        if not versions:
            return {"version": 0, "files": []}
        return self.published.read(versions[-1] if version is None else version)

    def commit(self, files: list[dict], after: int) -> int:
        """Publish the version that follows ``after``; RuntimeError if another writer has done so, or has claimed it."""
        return self.published.publish({"version": after + 1, "files": files}, after)

    def _scan(self, files: list[dict]) -> DataFrame:
        """The rows of files: by folder where all of a folder's files are asked for, else one by one."""
        folders: dict[str, list[str]] = {}
        for f in files:
            folders.setdefault(f["path"].rsplit("/", 1)[0], []).append(f["path"])
        paths = []
        for folder, own in folders.items():
            paths += [folder] if len(own) > 1 and len(own) == len(_files(self.spark, folder)) else own
        return self.spark.read.parquet(*paths)

    def append(self, docs: DataFrame, rows: int = 2000) -> int:
        """Write the rows as they come into small files, and commit them beside those of the last version."""
        now = self.manifest()
        to = f"{self.path}/data/{uuid.uuid4().hex}"
        docs.write.option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(to)
        return self.commit([*now["files"], *_counted(self.spark, to)], now["version"])

    def compact(self, target: int = TARGET, small: int = SMALL, fanout: int = FANOUT) -> int:
        """Merge the runs that ``plan`` names and commit; files of the versions before stay until ``vacuum``."""
        now = self.manifest()
        files = now["files"]
        runs = [r for r in plan([f["bytes"] for f in files], target, small, fanout) if len(r) > 1]
        if not runs:
            return now["version"]
        merged = {i for r in runs for i in r}
        rows = self._scan([files[i] for i in sorted(merged)])
        (run,) = fresh(rows, "run")
        placed = _numbered(rows, [(_name(files[i]["path"]), k) for k, r in enumerate(runs) for i in r], f"{run} int")
        to = f"{self.path}/data/{uuid.uuid4().hex}"
        placed.repartitionById(len(runs), F.col(run)).drop(run).write.option("compression", "zstd").option("parquet.block.size", GROUP).parquet(to)
        return self.commit([*(f for i, f in enumerate(files) if i not in merged), *_counted(self.spark, to)], now["version"])

    def vacuum(self, keep: int = KEEP, age: float = AGE) -> None:
        """Drop all versions but the last ``keep``, and the files that none of those lists and that are older than ``age`` seconds.

        Younger ones may have been written for a version that is not published yet.
        """
        versions = self.versions()
        held = {f["path"] for v in versions[-keep:] for f in self.manifest(v)["files"]}
        for v in versions[:-keep]:
            self.published.drop(v)
        fs, _ = hadoop_path(self.spark, self.path)
        for f in _files(self.spark, f"{self.path}/data"):
            if f["path"] not in held and f["age"] > age:
                fs.delete(hadoop_path(self.spark, f["path"])[1], False)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, with ``shard``, the place of their file in the manifest, and ``shard_rows``, how many it has."""
        files = self.manifest(version)["files"]
        rows = self._scan(files)
        shard, size = fresh(rows, "shard", "shard_rows")
        return _numbered(rows, [(_name(f["path"]), k, f["rows"]) for k, f in enumerate(files)], f"{shard} long, {size} long")


def sharded(docs: DataFrame, path: str | None = None, target: int = TARGET, small: int = SMALL, fanout: int = FANOUT) -> Store:
    """Append ``docs`` to the store at ``path`` (a new one in the shared folder by default), compact and vacuum it.

    All rows and columns are kept as they are: nulls, repeated rows, texts of any length, extra columns. A row is
    never split, so a file may exceed the target by its last run. An empty table is a version with an empty file. The
    last ``KEEP`` versions stay readable.
    """
    store = Store(docs.sparkSession, path or new_path(docs.sparkSession, "store"))
    store.append(docs)
    store.compact(target, small, fanout)
    store.vacuum()
    return store


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    """The whole of ``documents``: doc_id, shard, and the rows and version of the shard."""
    return shard_report(sharded(table(spark, sf_dir, "documents")))


def shard_report(store: Store) -> DataFrame:
    """(doc_id, shard, shard_rows, version) for every row of the last version; the rows of a shard are those of the manifest."""
    now = store.manifest()
    rows = store.read(now["version"])
    return rows.select("doc_id", F.col(rows.columns[-2]).alias("shard"), F.col(rows.columns[-1]).alias("shard_rows"), F.lit(now["version"]).cast("long").alias("version"))
