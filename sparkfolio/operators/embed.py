"""Vectors for texts, behind one interface: a table that has them, a hash of tokens, or a model."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH, BATCH = 384, 256


class Embedder(Protocol):
    def embed(self, texts: DataFrame, text: str) -> DataFrame:
        """The rows with a column ``embedding``."""


class Precomputed:
    """Joins vectors from a table by key."""

    def __init__(self, vectors: DataFrame, key: str, vector: str = "embedding"):
        self.vectors = vectors.select(key, F.col(vector).alias("embedding"))
        self.key = key

    def embed(self, texts: DataFrame, text: str) -> DataFrame:
        return texts.join(self.vectors, self.key)


class HashingEmbedder:
    """Signed counts of hashed words, at unit length. It stands in for a model; nearness is shared words, not meaning."""

    def __init__(self, width: int = WIDTH):
        self.width = width

    def embed(self, texts: DataFrame, text: str) -> DataFrame:
        hashes = F.transform(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.xxhash64(w))
        width = self.width

        @F.pandas_udf("array<float>")
        def counted(rows: pd.Series) -> pd.Series:
            n, h = rows.str.len().to_numpy(), np.concatenate([np.empty(0, np.int64), *rows])
            at = np.repeat(np.arange(len(n)), n) * width + h % width
            dense = np.bincount(at, np.where((h >> 40) & 1, -1.0, 1.0), len(n) * width).reshape(-1, width)
            norm = np.linalg.norm(dense, axis=1, keepdims=True)
            return pd.Series(list((dense / np.where(norm == 0, 1.0, norm)).astype(np.float32)))

        return texts.withColumn("embedding", counted(hashes))


class ModelEmbedder:
    """A model loaded once in each worker: ``load()`` returns a function of a list of texts to an array (n, width)."""

    def __init__(self, load: Callable[[], Callable[[list[str]], np.ndarray]], width: int = WIDTH, batch: int = BATCH):
        def make():
            model = load()
            return lambda texts: np.asarray(model([str(t) for t in texts]), dtype=np.float32)

        self.width = width
        self.apply = predict_batch_udf(make, return_type=T.ArrayType(T.FloatType()), batch_size=batch)

    def embed(self, texts: DataFrame, text: str) -> DataFrame:
        return texts.withColumn("embedding", self.apply(F.col(text)))
