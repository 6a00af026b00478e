"""Exact Jaccard self-join of documents on their word shingles, by universe partitioning (operator 1).

Sets whose sizes fall into one band are cut into m segments of the hash universe. Two sets that meet the
threshold differ in at most H shingles, so when the segments' allowances (1: the segment is equal; 2: it differs
by at most one shingle, looked up through its one-deletion neighbourhood) add up to H + 1, at least one segment
agrees within its allowance. How many segments get allowance 2 is chosen by cost. Every pair found so is
verified on the complete sets.

Equal sets are one class before the join. Within an index entry the members are held against the member that
most entries share; only members that are then still apart meet each other. No link between different components
is lost, and a group of copies costs rows in proportion to its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import bloom, only
from .graph import components
from .shared import forget, table, written
from .tokens import U, mix, shingles, slices, words

BAND_RATIO = 1.4
#: Cost of verifying one chance pair, in units of handling one key; odds that a document has a given foreign shingle.
PAIR_COST, REUSE = 20.0, 0.002
#: Index entries that a plan may give a set, times the fewest: they are written and moved, so more documents must not ask for more of them.
MOST = 1.25
#: 64-bit words of the parity sketch of a set.
SKETCH = 16
#: Bytes of text whose index entries are grouped and filtered at once.
AT_ONCE = 1 << 30


class Scheme:
    """Bands of set sizes and, for each, the number of segments, of those with allowance 2, and of empty ones to pass over."""

    def __init__(self, percent: int, documents: int):
        self.percent, self.documents, self.bounds, self.plans = percent, max(documents, 1), [1], {}

    def band(self, size: int) -> int:
        while self.bounds[-1] <= size:
            self.bounds.append(max(self.bounds[-1] + 1, math.ceil(self.bounds[-1] * BAND_RATIO)))
        return int(np.searchsorted(self.bounds, size, side="right")) - 1

    def differ(self, small: int, large: int) -> int:
        """The most shingles that two linked sets of at most these sizes differ in."""
        return (100 - self.percent) * (small + large) // (100 + self.percent)

    def plan(self, band: int) -> tuple[int, int, int]:
        """(segments, those with allowance 2, spare) of the cheapest allocation; no segments if only equal sets can link."""
        if band not in self.plans:
            while len(self.bounds) < band + 2:
                self.band(self.bounds[-1])
            low, top = self.bounds[band], self.bounds[band + 1] - 1
            differ = self.differ(top, top * 100 // self.percent)
            spare = math.ceil(1.5 * differ * math.exp(-low / (differ + 1)))
            most = (differ + 1) // 2
            entries = {two: self._entries(low, differ + 1 + spare, two) for two in {most * i // 16 for i in range(17)}}
            few = [two for two, n in entries.items() if n <= MOST * min(entries.values())]
            self.plans[band] = min((self._cost(low, differ + 1 + spare, two), differ + 1 + spare - two, two, spare) for two in few)[1:] if differ else (0, 0, 0)
        return self.plans[band]

    def _entries(self, size: int, allowance: int, two: int) -> float:
        m = allowance - two
        return (m - two) + two * (max(size / m, 1.0) + 1)

    def _cost(self, size: int, allowance: int, two: int) -> float:
        m = allowance - two
        per = max(size / m, 1.0)
        chance = (m - two) * REUSE**per + two * (per + 1) * REUSE ** max(per - 1, 0)
        return self._entries(size, allowance, two) + self.documents / 2 * chance * PAIR_COST

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Index entries of a set, given as its sorted distinct shingle hashes.

        A set takes as many of a band's segments, from the first, as its own size asks for: two sets then share the
        first segments that the one of fewer takes, whose allowances exceed what they may differ in by ``spare``. Empty
        segments, which many sets would share, are passed over where a set has no more than ``spare`` of them.
        """
        n = len(hashes)
        if not n:
            return hashes
        mixed, out = mix(hashes), []
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed)])
        least, own = -(-self.percent * n // 100), self.band(n)
        for band in range(self.band(max(least, 1)), own + 1):
            m, two, spare = self.plan(band)
            if not m:
                continue
            most = self.differ(n, n * 100 // self.percent) if band == own else self.differ(self.bounds[band + 1] - 1, n)
            take = min(m, max(most + 1 + spare - two, two))
            at = np.searchsorted(hashes, _cuts(m)[: take + 1])
            if take == m:
                at[m] = n
            part, size = sums[at[1:]] - sums[at[:-1]], np.diff(at)
            salt = mix(np.arange(take, dtype=np.uint64) + U((band + 1) << 40))
            keys, full = mix(part ^ salt), size[two:] > 0
            if len(full) - np.count_nonzero(full) <= spare:
                keys = np.concatenate([keys[:two], keys[two:][full]])
            out.append(keys)
            if two:
                seg = np.repeat(np.arange(two), size[:two])
                out.append(mix((part[seg] - mixed[at[0] : at[two]]) ^ salt[seg]))
        return np.unique(np.concatenate(out)) if out else hashes[:0]


@lru_cache(maxsize=256)
def _cuts(m: int) -> np.ndarray:
    """Where each of m equal segments of the hash universe begins, and its end."""
    return np.array([*((i << 64) // m for i in range(m)), (1 << 64) - 1], dtype=np.uint64)


def parities(hashes: np.ndarray) -> np.ndarray:
    """Bit i is the parity of the number of hashes that fall on i. Two sets differ in at least as many elements as their parities differ in bits."""
    odd = np.bincount((hashes & U(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signatures(scheme: Scheme, n: int, runs: int):
    """Facts and the index entries of every text; entries are dealt over ``runs`` columns by their value, so that one can be read without the others."""
    cuts = _cuts(runs)[1:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, rows = words(part.column("text"))
                size, one, two, keys, sketch = [], [], [], [[] for _ in range(runs)], []
                for i in range(part.num_rows):
                    s = np.unique(shingles(hashes[rows[i] : rows[i + 1]], n))
                    size.append(len(s))
                    one.append(mix(s).sum(dtype=np.uint64) if len(s) else 0)
                    two.append(mix(s ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) if len(s) else 0)
                    own = scheme.keys(s)
                    for held, some in zip(keys, np.split(own, np.searchsorted(own, cuts)), strict=True):
                        held.append(some.view(np.int64))
                    sketch.append(parities(s))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(size, pa.int64()),
                        pa.array(np.array(one, dtype=np.uint64).view(np.int64)),
                        pa.array(np.array(two, dtype=np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(sketch) + 1) * SKETCH, pa.int32()), pa.array(np.concatenate(sketch))),
                        *(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, held)]), pa.int32()), pa.array(np.concatenate(held))) for held in keys),
                    ],
                    names=["doc_id", "n", "h1", "h2", "sketch", *(f"keys{k}" for k in range(runs))],
                )

    return run


def _verified(percent: int, n: int):
    def of(texts: pa.Array, i: int) -> np.ndarray:
        return np.unique(shingles(words(texts.slice(i, 1))[0], n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            ta, tb, keep = batch.column("ta"), batch.column("tb"), []
            for i in range(batch.num_rows):
                right = of(tb, i) if b[i] not in kept else kept[b[i]]
                if b[i] not in kept:
                    kept = {b[i]: right}
                left = of(ta, i)
                both = np.intersect1d(left, right, assume_unique=True).size
                if 100 * both >= percent * (len(left) + len(right) - both) and both:
                    keep.append(i)
            if keep:
                yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    return run


def jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, node) for every row of ``docs``, which has doc_id and text.

    Sets are the distinct n-word shingles of the whole text, A-Z lower-cased; two documents link when
    ``100 * intersection >= percent * union``; a text of fewer words is one shingle. component_id is the
    smallest doc_id that links reach. Null or empty texts have no shingles and link with nothing. Rows that share
    a doc_id are one document: they share a component. A null doc_id takes the component of its equal sets, if
    any of those has an id, and is null otherwise. Other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    documents, size = base.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    runs = max(1, -(-(size or 0) // AT_ONCE))
    kinds = ["doc_id long", "n long", "h1 long", "h2 long", "sketch array<long>", *(f"keys{k} array<long>" for k in range(runs))]
    full = written(base.mapInArrow(_signatures(Scheme(percent, documents), n, runs), ", ".join(kinds)), "signatures")
    signed = written(full.select("doc_id", "n", "h1", "h2", "sketch"), "sketches")
    # A set is known by h1 here (two sets share it with odds of 2**-64), and by its smallest doc_id from members on.
    whole = signed.select("doc_id", "n", "h1", "h2")
    classes = written(whole.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("node")).where("node is not null"), "classes")
    runs_of = []
    for k in range(runs):  # all entries at once would take more disk than the texts, and more keys than the filter tells apart
        entries = full.where("n > 0").select("h1", F.explode(f"keys{k}").alias("key"))
        shared = written(entries.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "shared")
        # Copies are one row before the join by key, so that this join's large partitions can be split.
        some = entries.mapInArrow(only("key", bloom(shared)), "h1 long, key long").distinct().join(shared, "key", "left_semi")
        runs_of.append(written(some.join(classes.select("h1", "n", "node"), "h1").select("key", "node", "n"), "members"))
        forget(shared)
    members = reduce(DataFrame.unionByName, runs_of)
    forget(full)

    # Each member against the one whose entries are shared most.
    weight = members.groupBy("node").agg(F.count(F.lit(1)).alias("w"))
    centre = members.join(weight, "node").groupBy("key").agg(F.max(F.struct("w", "node", "n")).alias("c"))
    near = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    centre = written(centre.select("key", F.col("c.node").alias("b"), F.col("c.n").alias("m")), "centres")
    stars = members.join(centre, "key").where(near & (F.col("node") != F.col("b"))).select(F.col("node").alias("a"), "b", "n", "m").distinct()
    # Chance pairs grow with the square of the documents: sketches drop them before any text is read.
    differ = reduce(add, [F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("s")[i])) for i in range(SKETCH)])
    alike = differ * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)
    stars = stars.join(signed.select(F.col("doc_id").alias("a"), "sketch"), "a").join(signed.select(F.col("doc_id").alias("b"), F.col("sketch").alias("s")), "b")
    pairs = written(stars.where(alike).select("a", "b").distinct(), "pairs")

    def verify(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        texts = base.where("doc_id is not null").mapInArrow(only("doc_id", bloom(ids)), base.schema)
        both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        return written(both.select("a", "b", "ta", "tb").mapInArrow(_verified(percent, n), "a long, b long"), "links")

    links = verify(pairs)
    comps = written(components(links), "components")

    # Members of an entry that are still in different components meet each other.
    named = members.join(comps, "node", "left").select("key", "node", "n", F.coalesce("comp", "node").alias("comp"))
    apart = written(named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key"), "apart")
    left = written(named.join(apart, "key").join(signed.select(F.col("doc_id").alias("node"), "sketch"), "node"), "left")
    other = left.select(F.col("key").alias("k"), F.col("node").alias("b"), F.col("n").alias("m"), F.col("comp").alias("other"), F.col("sketch").alias("s"))
    rest = left.join(other, (F.col("key") == F.col("k")) & (F.col("comp") < F.col("other")) & near & alike).select(F.col("node").alias("a"), "b")
    done = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = written(rest.distinct().join(done, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        more = verify(rest)
        comps = written(components(links.unionByName(more)), "components")
        forget(more)
    forget(members, centre, pairs, apart, left, rest, links)
    found = classes.select("h1", "h2", F.col("n").alias("size"), "node").join(comps, "node", "left").select("h1", "h2", "size", "node", F.coalesce("comp", "node").alias("comp"))
    same = (whole["h1"] == found["h1"]) & (whole["h2"] == found["h2"]) & (whole["n"] == found["size"])
    return whole.join(found, same, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "doc_id").alias("component_id"), "node")


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Three-word shingles at 0.9 over the whole of ``documents``."""
    return jaccard_join(table(spark, sf_dir, "documents"), n=3, percent=90).select("doc_id", "n_shingles", "component_id")
