"""Quality scores learnt from preference pairs, Bradley-Terry style (operator 10).

A document of label 1 is preferred to one of label 0; the odds that a is preferred to b are exp(s(a) - s(b)) for a
score s linear in features of the text alone. Logistic loss on feature differences gives s; the quantile of s at the
share of label 0 is the threshold, where the returned score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import bloom, only
from .shared import table, written
from .tokens import U, raw, slices, words

#: Labelled rows that a model is fitted on at most, and preference pairs drawn from them.
LABELLED, PAIRS = 20_000, 200_000
_MARKS = b".,;:!?'\"()[]{}<>|*#$%&@/\\=+-_~`^"
_CLASSES = 10
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:192], _CLASS[192:] = 1, 2, 3, 4, 5
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10] = 6, 7
_CLASS[list(_MARKS)], _CLASS[[46, 44]] = 8, 9
_SINGLE = list(_MARKS)


def features(texts: pa.Array) -> np.ndarray:
    """One row a text: shares of kinds of characters, shape of words and lines, repetition, length. Empty texts: zeros but for a flag."""
    data, rows = raw(texts)
    n = len(rows) - 1
    size = np.diff(rows)
    row = np.repeat(np.arange(n), size)
    by_class = np.bincount(row * _CLASSES + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES)
    marks = np.flatnonzero(_CLASS[data] >= 8)
    code = np.zeros(256, dtype=np.int64)
    code[_SINGLE] = np.arange(len(_SINGLE))
    by_mark = np.bincount(row[marks] * len(_SINGLE) + code[data[marks]], minlength=n * len(_SINGLE)).reshape(n, len(_SINGLE))
    hashes, at = words(texts)
    n_words = np.diff(at)
    distinct, top, pairs = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n):
        own = hashes[at[i] : at[i + 1]]
        if len(own):
            counts = np.unique(own, return_counts=True)[1]
            distinct[i], top[i] = len(counts), counts.max()
            pairs[i] = len(np.unique(own[1:] * U(3) + own[:-1])) / max(len(own) - 1, 1) if len(own) > 1 else 1.0
    chars, n_words1 = np.maximum(size, 1)[:, None], np.maximum(n_words, 1)
    letters = by_class[:, 1] + by_class[:, 2] + by_class[:, 5]
    return np.column_stack(
        [
            by_class / chars,
            np.sqrt(by_mark / n_words1[:, None]),
            by_class[:, 2] / np.maximum(letters, 1),
            np.log1p(size),
            np.log1p(n_words),
            (size - by_class[:, 6] - by_class[:, 7] - by_class[:, 4]) / n_words1,
            distinct / n_words1,
            distinct / np.sqrt(n_words1),
            top / n_words1,
            pairs,
            (by_class[:, 7] + 1) / n_words1,
            size == 0,
        ]
    ).astype(np.float32)


class Ranking:
    """Weights of standardised features, and the threshold."""

    def __init__(self, mean, scale, weights, threshold):
        self.mean, self.scale, self.weights, self.threshold = mean, scale, weights, threshold

    @classmethod
    def fit(cls, x: np.ndarray, label: np.ndarray, seed: int = 11, ridge: float = 1e-3, steps: int = 25) -> Ranking:
        """Newton's method on the pairs' logistic loss. With one label only, every score is 1 or 0 accordingly."""
        x = x.astype(np.float64)
        mean, scale = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
        good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
        if not len(good) or not len(bad):
            return cls(mean, scale, np.zeros(x.shape[1]), np.inf if len(bad) else -np.inf)
        z, draw = (x - mean) / scale, np.random.default_rng(seed)
        n = min(PAIRS, len(good) * len(bad))
        d = z[draw.choice(good, n)] - z[draw.choice(bad, n)]
        w = np.zeros(x.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / n + ridge * np.eye(len(w)), d.T @ (1 - p) / n - ridge * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        scores = z @ w
        return cls(mean, scale, w, cls._cut(scores, len(bad) / len(label)))

    @staticmethod
    def _cut(scores: np.ndarray, share: float) -> float:
        """The quantile at ``share``, halfway between the scores on its two sides."""
        s = np.sort(scores)
        k = min(max(round(share * len(s)), 1), len(s) - 1)
        return float(s[k - 1] + s[k]) / 2

    def score(self, x: np.ndarray) -> np.ndarray:
        s = ((x.astype(np.float64) - self.mean) / self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def _featured(columns: list[str], at: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                x = features(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([lists if c == at else part.column(c) for c in columns], names=columns)

    return run


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(featured: DataFrame, labels: DataFrame) -> Ranking:
    """A model of at most ``LABELLED`` labelled rows, chosen by a hash of doc_id, that are not held out."""
    own = labels.where("quality in (0, 1)").where(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality"))
    rows = featured.join(own, featured["doc_id"] == own["id"]).select("features", "quality", "id")
    got = rows.orderBy(F.xxhash64("id"), "id", "quality", "features").limit(LABELLED).select("features", "quality").toArrow()
    n = len(got)
    if not n:
        return Ranking(0.0, 1.0, np.zeros(features(pa.array([""])).shape[1]), 0.0)
    x = np.array(got.column("features").combine_chunks().flatten()).reshape(n, -1)
    return Ranking.fit(x, got.column("quality").to_numpy())


def _scored(model: Ranking, columns: list[str], at: str, score: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(at).flatten()).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([pa.array(model.score(x)) if c == score else batch.column(c) for c in columns], names=columns)

    return run


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, which has doc_id and text.

    The score, from 0 to 1, grows with the odds of label 1 and depends on the text alone; predicted is 1 from 0.5.
    Null text counts as empty; an empty text is scored like any other. Repeated rows are scored each. Labels other
    than 0 and 1, or null, or of unknown documents teach nothing; without any label every score is 0.5. Other columns
    are not read.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    featured = written(base.mapInArrow(_featured(["doc_id", "features"], "features"), "doc_id long, features array<float>"), "features")
    model = fit(featured, labels)
    scored = featured.mapInArrow(_scored(model, ["doc_id", "score"], "features", "score"), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` that the classifier does not reject.

    Null texts are ranked as empty ones and stay null; repeated rows stay or go alike; extra columns stay; without any
    label every row stays; an empty table stays empty.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = labels.where(~held_out(F.col("doc_id"))).where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"))
    taught = base.where("doc_id is not null").mapInArrow(only("doc_id", bloom(own)), base.schema)  # no text moves
    featured = written(taught.mapInArrow(_featured(["doc_id", "features"], "features"), "doc_id long, features array<float>"), "features")
    model = fit(featured, labels)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                keep = model.score(features(part.column("text"))) >= 0.5
                yield part.filter(pa.array(keep))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.withColumn("text", F.col("text").cast("string")).schema).select(*columns)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """The whole of ``documents``, taught by ``labels``."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
