"""Embedding of texts by an injected model, and reductions of vectors."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Embedder = Callable[[Sequence[str]], np.ndarray]


def offline_embedder(dimensions: int = 64) -> Embedder:
    """A stand-in without a model: signed hashes of words and pairs of words, of unit length."""

    def embed(texts: Sequence[str]) -> np.ndarray:
        rows = np.zeros((len(texts), dimensions))
        for row, text in zip(rows, texts):
            words = re.findall(r"\w+", text.lower())
            for unit in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
                digest = int(hashlib.md5(unit.encode()).hexdigest()[:8], 16)
                row[digest // 2 % dimensions] += 1.0 if digest % 2 else -1.0
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    return embed


def embed_texts(df: DataFrame, embedder: Embedder, key: str = "ord", text: str = "summary", batch: int = 4) -> DataFrame:
    """key, embedding of each row; a null text is embedded as an empty one.

    The embedder is made ready once per task and gets batch texts at a time.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = [embedder(frame["_text"].iloc[k : k + batch].tolist()) for k in range(0, len(frame), batch)]
            vectors = np.concatenate(parts).astype(np.float32) if parts else np.zeros((0, 1), np.float32)
            yield pd.DataFrame({key: frame[key].to_numpy(), "embedding": list(vectors)})

    own = df.select(key, F.coalesce(text, F.lit("")).alias("_text"))
    return own.mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, embedding array<float>")


def embed_multi_vectors(df: DataFrame, embedder: Callable[[Sequence[str]], Sequence[np.ndarray]], key: str = "ord", text: str = "query", batch: int = 64) -> DataFrame:
    """key, embedding of each row by a model that gives a text a vector for each of its parts:
    ARRAY<ARRAY<FLOAT>>, empty for null texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                own = frame.iloc[at : at + batch]
                given = own["_text"].notna().to_numpy()
                found = iter(embedder(own["_text"][given].tolist()) if given.any() else ())
                rows = [[list(map(float, v)) for v in next(found)] if g else [] for g in given]
                yield pd.DataFrame({key: own[key].to_numpy(), "embedding": rows})

    own = df.select(key, F.col(text).alias("_text"))
    return own.mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, embedding array<array<float>>")


def late_interaction(left: Column, right: Column) -> Column:
    """Of two lists of vectors the sum over the first of the largest inner product with any of
    the second; null for an empty second one."""
    product = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda acc, x: acc + x)
    return F.aggregate(left, F.lit(0.0), lambda acc, a: acc + F.array_max(F.transform(right, lambda b: product(a, b))))


def centred(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Vectors less their mean; the mean has one number per dimension and comes from partial
    sums in the tasks."""
    means = vectors.select(F.posexplode(vector).alias("k", "x")).groupBy("k").agg(F.avg(F.col("x").cast("double")).alias("m"))
    row = means.agg(F.array_sort(F.collect_list(F.struct("k", "m"))).alias("p")).select(F.col("p.m").alias("mean")).first()
    mean = F.array(*[F.lit(float(x)) for x in row["mean"]])
    return vectors.select(key, F.zip_with(F.col(vector).cast("array<double>"), mean, lambda x, m: x - m).alias(vector))


def directions(size: int, dimensions: int, seed: int = 0) -> np.ndarray:
    """A matrix of signs over the root of dimensions: hashes of seed, row and column."""
    signs = [[int(hashlib.md5(f"{seed}|{i}|{j}".encode()).hexdigest()[:8], 16) % 2 * 2 - 1 for j in range(dimensions)] for i in range(size)]
    return np.array(signs, np.float64).reshape(size, dimensions) / np.sqrt(dimensions)


def random_projection(vectors: DataFrame, dimensions: int, seed: int = 0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Vectors on dimensions random directions of signs, the same in every task for one seed."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix: np.ndarray | None = None
        for frame in frames:
            if frame.empty:
                continue
            own = np.stack(frame[vector].to_numpy()).astype(np.float64)
            if matrix is None:
                matrix = directions(own.shape[1], dimensions, seed)
            yield pd.DataFrame({key: frame[key].to_numpy(), vector: list(own @ matrix)})

    own = vectors.where(F.col(vector).isNotNull()).select(key, vector)
    return own.mapInPandas(run, f"{key} {vectors.schema[key].dataType.simpleString()}, {vector} array<double>")
