"""Removing lines that other documents hold, through a sharded minimal perfect hash (operator 7).

Lines found in at least two documents are indexed: a shard of them is a minimal perfect hash over their 128-bit
hashes and, in its order, arrays of fingerprints, document counts and first documents. Documents probe the arrays
with packed blocks of their own line hashes; no line is joined to another. A shard that many lines probe is copied
to as many parts as their number asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import table, written
from .tokens import U, mix, raw, slices

LEAST = 10
SHARD_LINES = 1 << 17
PART_LINES = 1 << 20
_STRIP = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, least: int = LEAST) -> bytes:
    """The normalised line, empty if it has fewer than ``least`` code points."""
    key = line.strip(_STRIP).lower()
    if len(key) < least or (not key.isascii() and len(key.decode("utf-8", "replace")) < least):
        return b""
    return key


class PerfectHash:
    """Maps n distinct 64-bit keys onto 0..n-1: each level keeps the keys that are alone on their bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, before = [], 0
        for bits in levels:
            ones = np.bitwise_count(bits).astype(np.int64)
            self.ranks.append(before + np.cumsum(ones) - ones)
            before += int(ones.sum())

    @staticmethod
    def _spot(keys: np.ndarray, level: int, words: int) -> np.ndarray:
        return mix(keys + U((level * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)) % U(words * 64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        if len(np.unique(keys)) < len(keys):
            raise ValueError("keys are not distinct")  # no level would part them
        while len(keys):
            words = max(1, -(-2 * len(keys) // 64))
            at = cls._spot(keys, len(levels), words).astype(np.int64)
            hits = np.bincount(at, minlength=words * 64)
            levels.append(np.packbits(hits == 1, bitorder="little").view(np.uint64))
            keys = keys[hits[at] > 1]
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; -1 for some of the keys that are not held, any place for the others."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self._spot(keys[left], level, len(bits))
            word, bit = (at >> U(6)).astype(np.int64), at & U(63)
            here = (bits[word] >> bit) & U(1) == 1
            below = bits[word[here]] & ((U(1) << bit[here]) - U(1))
            out[left[here]] = rank[word[here]] + np.bitwise_count(below)
            left = left[~here]
        return out


_LINE = "h1 long, h2 long, doc_id long"
_INDEX = "shard long, sizes array<long>, bits binary, prints binary, counts binary, firsts binary"
_BLOCK = "part long, kind int, sizes array<long>, a binary, b binary, c binary, d binary"


def _longs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.int64)


def _lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, rows = raw(part.column("text"))
                whole, ids, own, doc = data.tobytes(), part.column("doc_id").to_pylist(), [], []
                for i, d in enumerate(ids):
                    keys = {k for line in whole[rows[i] : rows[i + 1]].split(b"\n") if (k := line_key(line, least))}
                    own += [hashlib.blake2b(k, digest_size=16).digest() for k in keys]
                    doc += [d] * len(keys)
                if own:
                    h = np.frombuffer(b"".join(own), dtype=np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(doc, pa.int64())], names=["h1", "h2", "doc_id"])

    return run


def _joint(h1: np.ndarray, h2: np.ndarray, salt: int) -> np.ndarray:
    """One 64-bit key of a line's two hashes."""
    return h1.view(np.uint64) ^ mix(h2.view(np.uint64) + U(salt))


def _shard(table: pa.Table) -> pa.Table:
    h1, h2, salt = table.column("h1").to_numpy(), table.column("h2").to_numpy(), 0
    while len(np.unique(keys := _joint(h1, h2, salt))) < len(keys):  # of two lines that share a key, with the next salt most do not
        salt += 1
    index = PerfectHash.build(keys)
    at = index.find(keys)
    arrays = []
    for values, kind in ((h2, np.int64), (table.column("n").to_numpy(), np.int64), (table.column("first").to_numpy(), np.int64)):
        placed = np.empty(len(keys), dtype=kind)
        placed[at] = values
        arrays.append(placed.tobytes())
    return pa.table({"shard": [table.column("shard")[0].as_py()], "sizes": [[salt, *(len(x) for x in index.levels)]], "bits": [b"".join(x.tobytes() for x in index.levels)], "prints": [arrays[0]], "counts": [arrays[1]], "firsts": [arrays[2]]}, schema=_INDEX_ARROW)


_INDEX_ARROW = pa.schema([("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("prints", pa.binary()), ("counts", pa.binary()), ("firsts", pa.binary())])
_BLOCK_ARROW = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("sizes", pa.list_(pa.int64())), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary())])


def _packed(starts: np.ndarray, most: int = 1 << 17):
    """Blocks of line hashes for each part of the index. starts[s]: the first part that holds shard s."""

    def pack(h1, h2, doc):
        shard = (h1.view(np.uint64) % U(len(starts) - 1)).astype(np.int64)
        copies = (starts[shard + 1] - starts[shard]).astype(np.uint64)
        part = starts[shard] + (mix(doc.view(np.uint64)) % copies).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cut = np.flatnonzero(np.diff(part[order], prepend=-1))
        rows = [order[a:b] for a, b in zip(cut, [*cut[1:], len(order)], strict=True)]
        none = [b""] * len(rows)
        return pa.RecordBatch.from_pydict({"part": [int(part[r[0]]) for r in rows], "kind": [1] * len(rows), "sizes": [[]] * len(rows), "a": [h1[r].tobytes() for r in rows], "b": [h2[r].tobytes() for r in rows], "c": [doc[r].tobytes() for r in rows], "d": none}, schema=_BLOCK_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("h1", "h2", "doc_id")])
            n += batch.num_rows
            if n >= most:
                yield pack(*map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield pack(*map(np.concatenate, zip(*held, strict=True)))

    return run


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines to drop. Rows come sorted by part, each part's arrays first."""
    index = prints = firsts = salt = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                words = np.frombuffer(row["a"], dtype=np.uint64)
                salt, sizes = row["sizes"][0], row["sizes"][1:]
                index = PerfectHash(np.split(words, np.cumsum(sizes)[:-1]))
                prints, firsts = _longs(row["b"]), _longs(row["d"])
                continue
            h1, h2, doc = _longs(row["a"]), _longs(row["b"]), _longs(row["c"])
            at = index.find(_joint(h1, h2, salt))
            drop = (at >= 0) & (prints[at] == h2) & (firsts[at] != doc)
            if drop.any():
                yield pa.RecordBatch.from_arrays([pa.array(h1[drop]), pa.array(h2[drop]), pa.array(doc[drop])], names=["h1", "h2", "doc_id"])


def _kept(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, rows = raw(part.column("text"))
                whole, lines, dropped, kept = data.tobytes(), [], [], []
                for i, drop in enumerate(part.column("drop").to_pylist()):
                    own = whole[rows[i] : rows[i + 1]].split(b"\n")
                    stay = own
                    if drop:
                        gone = {d["h1"].to_bytes(8, "little", signed=True) + d["h2"].to_bytes(8, "little", signed=True) for d in drop}
                        stay = [x for x in own if not (k := line_key(x, least)) or hashlib.blake2b(k, digest_size=16).digest() not in gone]
                    lines.append(len(own))
                    dropped.append(len(own) - len(stay))
                    kept.append(b"\n".join(stay).decode("utf-8", "surrogateescape") if len(stay) < len(own) else whole[rows[i] : rows[i + 1]].decode("utf-8", "surrogateescape"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"])

    return run


def line_index(lines: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(the shards, the number of probing lines that each shard's shared lines bring) of a table of (h1, h2, doc_id)."""
    shared = written(lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")).where("first <> last"), "shared-lines")
    shards = max(1, -(-shared.count() // SHARD_LINES))
    # an unsigned remainder, as numpy takes it
    high, low = F.shiftrightunsigned("h1", 32) % shards, F.col("h1").bitwiseAND(F.lit(0xFFFFFFFF)) % shards
    sharded = shared.withColumn("shard", (high * ((1 << 32) % shards) + low) % shards)
    loads = np.zeros(shards, dtype=np.int64)
    for row in sharded.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # one row a shard
        loads[row["shard"]] = row["n"]
    return written(sharded.groupBy("shard").applyInArrow(_shard, _INDEX), "line-index"), loads


def dedup_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) for every row of ``docs``, which has doc_id and text.

    A text is split at \\n; null or empty text is one empty line. The key of a line is the line stripped of ASCII
    white space, A-Z lower-cased. Keys of at least ``least`` code points that documents of two or more doc_ids hold
    lose all their lines but those in the smallest doc_id. Rows that share a doc_id count as one document, each row
    is returned. Rows without doc_id keep all lines and count for no key. Other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = written(base.where("doc_id is not null").mapInArrow(_lines(least), _LINE), "lines")
    index, loads = line_index(lines)
    total = lines.count()
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = min(PART_LINES, max(1, total // wide))
    unique = max(0, total - int(loads.sum())) / len(loads)
    copies = np.maximum(1, np.ceil((loads + unique) / each)).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(copies)])
    bounds = F.array(*[F.lit(int(x)) for x in starts]) if len(starts) < 1000 else None
    if bounds is None:
        spans = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True))], "shard long, lo long, hi long")
        placed = index.join(spans, "shard").withColumn("part", F.explode(F.expr("sequence(lo, hi - 1)")))
    else:
        placed = index.withColumn("part", F.explode(F.sequence(F.element_at(bounds, (F.col("shard") + 1).cast("int")), F.element_at(bounds, (F.col("shard") + 2).cast("int")) - 1)))
    arrays = placed.select(F.col("part").cast("long").alias("part"), F.lit(0).alias("kind"), "sizes", F.col("bits").alias("a"), F.col("prints").alias("b"), F.col("counts").alias("c"), F.col("firsts").alias("d"))
    blocks = arrays.unionByName(lines.mapInArrow(_packed(starts), _BLOCK))
    ready = blocks.repartition(min(int(starts[-1]), max(wide, total // PART_LINES)), "part").sortWithinPartitions("part", "kind")
    drops = ready.mapInArrow(_probed, _LINE).groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("drop"))
    return base.join(drops, "doc_id", "left").select("doc_id", "text", "drop").mapInArrow(_kept(least), "doc_id long, n_lines long, n_dropped long, kept string")


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    """The whole of ``documents``."""
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
