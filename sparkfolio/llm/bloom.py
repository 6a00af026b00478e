"""A Bloom filter of fixed size over 64-bit keys, built by the executors and handed to Python workers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import U, mix

#: 8 MB, whatever the number of keys: with more keys it lets more rows through, and joins drop those.
BITS = 1 << 26


def _spots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.astype(np.int64).view(np.uint64))
    return h & U(BITS - 1), (h >> U(32)) & U(BITS - 1)


def bloom(keys: DataFrame):
    """A broadcast of the filter over the first column of ``keys`` (no nulls)."""
    keys = keys.select(F.col(keys.columns[0]).cast("long").alias("key"))

    def run(batches):
        mask = np.zeros(BITS >> 6, dtype=np.uint64)
        for batch in batches:
            for at in _spots(batch.column("key").to_numpy()):
                np.bitwise_or.at(mask, at >> U(6), U(1) << (at & U(63)))
        at = np.flatnonzero(mask)
        for k in range(0, len(at), 1 << 16):
            some = at[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(mask[some].view(np.int64))], names=["w", "b"])

    mask = np.zeros(BITS >> 6, dtype=np.uint64)
    got = keys.mapInArrow(run, "w long, b long").groupBy("w").agg(F.expr("bit_or(b)").alias("b")).toArrow()
    mask[got.column("w").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(mask)


def maybe(mask: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False where a key is surely not among those of the filter."""
    keep = np.ones(len(keys), dtype=bool)
    for at in _spots(keys):
        keep &= (mask[at >> U(6)] >> (at & U(63))) & U(1) == 1
    return keep


def only(column: str, bits):
    """For mapInArrow: the rows whose ``column`` may be among the keys."""

    def run(batches):
        for batch in batches:
            keep = maybe(bits.value, batch.column(column).to_numpy(zero_copy_only=False))
            if keep.any():
                yield batch.filter(pa.array(keep))

    return run


def never(column: str, bits):
    """For mapInArrow: the other rows, whose ``column`` is surely not among the keys."""

    def run(batches):
        for batch in batches:
            keep = ~maybe(bits.value, batch.column(column).to_numpy(zero_copy_only=False))
            if keep.any():
                yield batch.filter(pa.array(keep))

    return run
