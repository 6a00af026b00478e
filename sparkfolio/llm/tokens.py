"""Words of whole texts as 64-bit hashes, computed over the UTF-8 bytes of an Arrow column at once.

Bytes are read in blocks that end at a separator, so memory stays bounded however long a text is. A word's
hash is a polynomial over its bytes modulo 2**64, taken from running sums, then mixed. Two different words
share a hash with odds of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BLOCK = 1 << 18
_MULTIPLIER = 0x9E3779B97F4A7C15
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(_MULTIPLIER))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[list(_SPACES)] = False
#: Of a lower-cased text: digits, a-z and everything beyond ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the multiplier and of its inverse modulo 2**64, as many as the longest block has needed."""

    def __init__(self):
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_MULTIPLIER, n), _powers(pow(_MULTIPLIER, -1, 1 << 64), n)
        return self.up, self.down


_POWERS = _Powers()


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the rows in them) of a string column; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def _blocks(data: np.ndarray, cuts: np.ndarray, inside: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about BLOCK bytes, none of which ends within a word."""
    start = 0
    while start < len(data):
        end = min(start + BLOCK, len(data))
        if end < len(data):
            row = cuts[np.searchsorted(cuts, end, side="right") - 1]
            gap = np.flatnonzero(~inside[data[start:end]])
            end = max(int(row), start + int(gap[-1]) + 1 if len(gap) else 0)
            if end <= start:  # a word longer than a block
                after = int(cuts[np.searchsorted(cuts, start + BLOCK)])
                end = start + BLOCK
                while end < after and inside[data[end]]:
                    end += 1
        yield start, end
        start = end


def words(texts: pa.Array, inside: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, in order; offsets of the rows in them), with A-Z lower-cased."""
    data, rows = raw(texts)
    hashes, starts = [], []
    for start, end in _blocks(data, rows, inside):
        part = data[start:end]
        is_in = inside[part]
        begins = is_in.copy()
        begins[1:] &= ~is_in[:-1]
        ends = is_in.copy()
        ends[:-1] &= ~is_in[1:]
        cuts = rows[np.searchsorted(rows, start) : np.searchsorted(rows, end)] - start  # rows that begin here
        begins[cuts] = is_in[cuts]
        cuts = cuts[cuts > 0] - 1
        ends[cuts] = is_in[cuts]
        s, e = np.flatnonzero(begins), np.flatnonzero(ends)
        if not len(s):
            continue
        up, down = _POWERS.upto(len(part))
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        hashes.append(mix((sums[e + 1] - sums[s]) * down[s] + (e - s).astype(np.uint64)))
        starts.append(s + start)
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.zeros(len(rows), dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), rows)


_LANES = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD6E8FEB86659FD93)) | U(1)


def shingles(row: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles of a text's word hashes, in order; of a shorter text, the whole as one."""
    if not len(row):
        return row
    k = min(n, len(row))
    out = row[: len(row) - k + 1] * _LANES[0]
    for i in range(1, k):
        out = out + row[i : len(row) - k + 1 + i] * _LANES[i]
    return mix(out + U(k))


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``most`` bytes, at least one row each."""
    if not batch.num_rows:
        return
    _, rows = raw(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(rows, rows[start] + most, side="right")) - 1)
        end = min(end, batch.num_rows)
        yield batch.slice(start, end - start)
        start = end
