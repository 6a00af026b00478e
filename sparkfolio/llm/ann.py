"""Nearest neighbours by cosine through additive quantisation and exact reranking (operator 6).

A unit vector is coded as the sum of one codeword from each of M full-dimensional codebooks. Codebooks start as
k-means over residuals and are then fitted together by least squares; codes are found by beam search. A query's table
of inner products with all codewords scores a code in M look-ups, divided by the stored norm of its sum. The best
``rerank`` vectors by that score are compared with the query exactly, and then all that may be nearer still: a vector's
distance to what its code stands for bounds what its score can be wrong by. So the nearest are found whatever the vectors
are like; where codes tell little (wide vectors, tight clusters), most are compared. Queries go to all groups of vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import table, written

#: Vectors that codebooks are fitted on at most (by a hash of the id); every vector is coded.
SAMPLE = 8192
BOOKS, WORDS, BEAM = 32, 64, 4
#: Vectors compared exactly at first for each query among RERANK_AT or fewer; among more, as many more as the root of their number.
RERANK, RERANK_AT = 128, 50_000
#: A group has so many bytes of vectors at most, and so many vectors at least where there are fewer groups than tasks want.
GROUP_BYTES, GROUP_LEAST = 32 << 20, 2048
#: Queries that meet a group at once; cosines that differ by no more count as equal until they are computed as asked.
TILE, TIE = 64, 1e-12


class Quantiser:
    def __init__(self, books: np.ndarray):
        self.books = books.astype(np.float32)  # (M, K, d)
        self.norms = (self.books**2).sum(2)

    @classmethod
    def fit(cls, x: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 6, seed: int = 5) -> Quantiser:
        draw = np.random.default_rng(seed)
        words = min(words, max(len(x), 1))
        rest, out = x.astype(np.float32).copy(), []
        for _ in range(books):
            c = rest[draw.choice(len(rest), words, replace=False)]
            for _ in range(rounds):
                at = ((c**2).sum(1) - 2 * rest @ c.T).argmin(1)
                n = np.bincount(at, minlength=words)
                sums = np.zeros_like(c)
                np.add.at(sums, at, rest)
                c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], rest[draw.choice(len(rest), words)])
            at = ((c**2).sum(1) - 2 * rest @ c.T).argmin(1)
            rest = rest - c[at]
            out.append(c)
        model = cls(np.stack(out))
        codes, _ = model.encode(x)
        flat = codes.astype(np.int64) + np.arange(books) * words
        gram, right = np.eye(books * words) * 0.1, 0.1 * model.books.reshape(books * words, -1).astype(np.float64)
        for i in range(books):
            np.add.at(right, flat[:, i], x)
            for j in range(books):
                np.add.at(gram, (flat[:, i], flat[:, j]), 1.0)
        return cls(np.linalg.solve(gram, right).reshape(books, words, -1))

    def encode(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(codes, norms of what they stand for), by beam search over the residuals."""
        codes, norms = [], []
        for k in range(0, len(x), 1024):
            rest = x[k : k + 1024, None, :].astype(np.float32)
            n, path = len(rest), np.empty((len(rest), 1, 0), dtype=np.uint8)
            for m, c in enumerate(self.books):
                b = rest.shape[1]
                loss = ((rest**2).sum(2)[:, :, None] + self.norms[m] - 2 * (rest.reshape(n * b, -1) @ c.T).reshape(n, b, -1)).reshape(n, -1)
                keep = min(beam, loss.shape[1])
                best = np.argpartition(loss, keep - 1, axis=1)[:, :keep]
                from_, word = best // len(c), best % len(c)
                rest = np.take_along_axis(rest, from_[:, :, None], 1) - c[word]
                path = np.concatenate([np.take_along_axis(path, from_[:, :, None], 1), word[:, :, None].astype(np.uint8)], 2)
            top = (rest**2).sum(2).argmin(1)
            codes.append(path[np.arange(n), top])
            norms.append(np.linalg.norm(x[k : k + 1024] - rest[np.arange(n), top], axis=1))
        return np.concatenate(codes), np.concatenate(norms).astype(np.float32)

    def errors(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distances of vectors to what their codes stand for, rounded up."""
        rest = x.astype(np.float64)
        for m, c in enumerate(self.books):
            rest -= c[codes[:, m]]
        return np.nextafter(np.linalg.norm(rest, axis=1).astype(np.float32), np.float32(np.inf))

    def slack(self) -> float:
        """What rounding to single precision can change in a unit query's score."""
        return 2.0**-23 * (len(self.books) + self.books.shape[2] + 8) * (1 + float(np.sqrt(self.norms.max(1)).sum()))

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(M, K, queries) inner products."""
        return np.einsum("mkd,qd->mkq", self.books, q.astype(np.float32), optimize=True)


def _unit(column, dim: int) -> np.ndarray:
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coded(model, dim: int):
    """Unit vectors with their codes, the norms of what these stand for and the distances to it; without a model the vectors alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if n := batch.num_rows:
                x = _unit(batch.column("v"), dim)
                codes, norms, errors = np.empty((n, 0), np.uint8), np.ones(n, np.float32), np.zeros(n, np.float32)
                if model is not None:
                    codes, norms = model.value.encode(x)
                    errors = model.value.errors(x, codes)
                packed = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (codes, x)]
                yield pa.RecordBatch.from_arrays([batch.column("node"), packed[0], pa.array(norms), pa.array(errors), packed[1]], names=["node", "code", "norm", "error", "x"])

    return run


_CODED = "node long, code binary, norm float, error float, x binary"
_SCORED = "query long, node long, score double"


class _Group:
    """Some of the vectors, with their codes."""

    def __init__(self, rows: list[pa.RecordBatch], dim: int):
        t = pa.Table.from_batches(rows).combine_chunks()
        self.nodes, self.norms, self.errors = (t.column(c).to_numpy() for c in ("node", "norm", "error"))
        self.x = np.frombuffer(b"".join(t.column("x").to_pylist()), dtype=np.float64).reshape(-1, dim)
        self.codes = np.frombuffer(b"".join(t.column("code").to_pylist()), dtype=np.uint8).reshape(len(self.x), -1).T.copy()
        self.norms = np.maximum(self.norms, 1e-9)

    def best(self, model, asked: np.ndarray, first: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, cosines) for each query: the ``most`` nearest, with those as near as the last of them.

        The ``first`` best by their codes are compared exactly. No vector is nearer than its code says by more than its
        distance to what the code stands for, so those that may still be among the nearest are known; they are compared too.
        """
        n, found = len(self.x), []
        if model is None:
            rest = np.ones((len(asked), n), dtype=bool)
        else:
            tables, slack = model.tables(asked), model.slack()
            rest = np.empty((len(asked), n), dtype=bool)
            for q in range(len(asked)):
                score = np.zeros(n, dtype=np.float32)
                for m in range(len(self.codes)):
                    score += tables[m, :, q][self.codes[m]]
                keep = min(max(first, most), n)
                top = np.argpartition(-(score / self.norms), keep - 1)[:keep]
                true = self.x[top] @ asked[q]
                floor = np.partition(true, -most)[-most] if keep >= most else -np.inf
                np.greater_equal(score + self.errors, floor - slack, out=rest[q])
                rest[q, top] = False
                found.append((top, true))
        many = rest.sum(1) > n // 8  # a product with all is faster than picking them
        every = dict(zip(np.flatnonzero(many).tolist(), asked[many] @ self.x.T, strict=True))
        for q in range(len(asked)):
            at = np.flatnonzero(rest[q])
            true = every[q][at] if q in every else self.x[at] @ asked[q]
            if found:
                at, true = np.concatenate([found[q][0], at]), np.concatenate([found[q][1], true])
            if len(at) > most:
                near = true >= np.partition(true, -most)[-most] - TIE
                at, true = at[near], true[near]
            yield at, true


def _searched(model, dim: int, first: int, most: int):
    """For rows sorted by group, in each the vectors before the queries: what each query finds in each group."""
    model_of = (lambda: None) if model is None else (lambda: model.value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, group = None, [], None
        for batch in batches:
            numbers, asks = batch.column("number").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((numbers[1:] != numbers[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist(), len(numbers)]
            for start, end in pairwise(cuts):
                if start == end:
                    continue
                some = batch.slice(start, end - start)
                if numbers[start] != number:
                    number, held, group = numbers[start], [], None
                if not asks[start]:
                    held.append(some)
                    continue
                if held:
                    group, held = _Group(held, dim), []
                if group is None:
                    continue
                for k in range(0, some.num_rows, TILE):
                    tile = some.slice(k, TILE)
                    asked = np.frombuffer(b"".join(tile.column("x").to_pylist()), dtype=np.float64).reshape(-1, dim)
                    near = list(group.best(model_of(), asked, first, most))
                    ids = np.repeat(tile.column("node").to_numpy(), [len(at) for at, _ in near])
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(group.nodes[np.concatenate([at for at, _ in near])]), pa.array(np.concatenate([true for _, true in near]))], names=["query", "node", "score"])

    return run


def cosine(a: Column, b: Column) -> Column:
    """In double precision."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def reranked(total: int, k: int) -> int:
    """How many of ``total`` vectors are compared exactly for a query's k nearest."""
    return max(RERANK, 4 * k, math.ceil(RERANK * math.sqrt(total / RERANK_AT)))


def nearest(vectors: DataFrame, queries: Column, k: int = 5, rerank: int | None = None, exact: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine found for each row where ``queries`` holds.

    ``vectors`` has vec_id and embedding. Nearest first, ties to the smaller vec_id, the query's own vec_id left out.
    Rows without vec_id, and vectors that are null, zero or hold null or non-finite components take no part, nor do
    those of another length than most. Rows that share vec_id and vector count once; of one vec_id with different
    vectors, each is a candidate and a query. Of equal vectors the k + 1 smallest ids are looked at, which is enough
    for any answer. Other columns are not read. ``rerank`` vectors are compared exactly at first (``reranked`` says how many
    by default), then those that the codes do not rule out; with ``exact``, no codes are used.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.col("vec_id").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where("embedding is not null").where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), queries.alias("asks"))
    rows = written(rows.withColumn("node", F.xxhash64("v")), "vectors")
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    dim = lengths["d"]
    rows = rows.where(F.size("v") == dim)

    # Equal vectors are one node, which keeps its k + 1 smallest ids; salted first, as one vector may have many.
    salted = Window.partitionBy("node", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("vec_id")
    few = rows.select("node", "vec_id").distinct().withColumn("r", F.row_number().over(salted)).where(F.col("r") <= k + 1)
    ids = written(few.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))).where(F.col("r") <= k + 1).select("node", "vec_id"), "ids")
    nodes = written(rows.groupBy("node").agg(F.min("v").alias("v")), "nodes")

    total = nodes.count()
    rerank = reranked(total, k) if rerank is None else rerank
    model = None
    if not exact:
        sample = nodes.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(SAMPLE).select("v").toArrow()
        model = rows.sparkSession.sparkContext.broadcast(Quantiser.fit(_unit(sample.column("v").combine_chunks(), dim)))
    asking = rows.where("asks").select("vec_id", "node").distinct()
    asked = written(asking.select("node").distinct().join(nodes, "node").select(F.col("node").alias("query"), "v"), "queries")

    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    groups = max(-(-total * 8 * dim // GROUP_BYTES), min(tasks, -(-total // GROUP_LEAST)), 1)
    held = nodes.select("node", "v").mapInArrow(_coded(model, dim), _CODED).select(F.pmod(F.xxhash64("node", F.lit(2)), F.lit(groups)).cast("int").alias("number"), F.lit(False).alias("asks"), "*")
    lots = asked.select(F.col("query").alias("node"), "v").mapInArrow(_coded(None, dim), _CODED).select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("number"), F.lit(True).alias("asks"), "*")
    met = held.unionByName(lots).repartition(groups, "number").sortWithinPartitions("number", "asks")
    guesses = met.mapInArrow(_searched(model, dim, max(4 * k, -(-rerank // groups)), k + 1), _SCORED)
    whole = Window.partitionBy("query").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.coalesce(F.nth_value("score", k + 1).over(whole), F.lit(-2.0))
    chosen = guesses.withColumn("last", last).where(F.col("score") >= F.col("last") - TIE).select("query", "node")

    met = chosen.join(asked.withColumnRenamed("v", "q"), "query").join(nodes, "node")
    exact = written(met.select("query", "node", cosine(F.col("q"), F.col("v")).alias("score")), "scores")
    listed = exact.join(ids, "node").select(F.col("query"), "vec_id", "score")
    answers = asking.withColumnRenamed("vec_id", "query_id").join(listed, F.col("node") == F.col("query")).where("vec_id <> query_id").select("query_id", "vec_id", "score")
    answers = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_ann(spark, sf_dir: str) -> DataFrame:
    """The whole of ``embeddings``, asked with each vec_id divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
