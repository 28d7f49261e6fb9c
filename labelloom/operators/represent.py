"""Vectors: hashed tokens, normalisation, reduction and fusion.

The encoder is any function from a text column to an ARRAY<DOUBLE> column;
``hashed_vector`` is the one that needs no model.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.vectors import list_column, matrix, unit


def tokens(text: Column) -> Column:
    """All runs of the letters a to z of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z]+)"), F.lit(1))


def bucket_of(token: str, dims: int) -> int:
    """Bucket of a token: the first 8 hexadecimal digits of its MD5, modulo ``dims``."""
    return int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dims


def _counter(dims: int, normalize: bool):
    @F.arrow_udf("array<double>")
    def count(lists: pa.Array) -> pa.Array:
        # Distinct tokens of the batch are hashed once; counting is one bincount.
        words = lists.flatten().dictionary_encode()
        buckets = np.array([bucket_of(w, dims) for w in words.dictionary.to_pylist()], dtype=np.int64)
        rows = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        slots = rows * dims + (buckets[words.indices.to_numpy(zero_copy_only=False)] if len(rows) else rows)
        counts = np.bincount(slots, minlength=len(lists) * dims).astype(np.float64).reshape(len(lists), dims)
        if normalize:
            length = np.sqrt((counts * counts).sum(1))
            counts /= np.where(length == 0, 1.0, length)[:, None]
        return list_column(counts)

    return count


def hashed_vector(text: Column, dims: int = 256, normalize: bool = True) -> Column:
    """Hashed token counts of a text.  Row-local: no shuffle, whole texts."""
    return _counter(dims, normalize)(tokens(text))


def document_frequency(df: DataFrame, v: str = "v") -> DataFrame:
    """Number of rows with a non-zero value, per dimension."""
    return (
        df.select(F.posexplode(v).alias("dim", "x")).where("x <> 0").groupBy("dim").agg(
            F.count(F.lit(1)).alias("df")
        )
    )


def tfidf(df: DataFrame, v: str = "v", normalize: bool = True) -> DataFrame:
    """Counts times ``ln((1+n)/(1+df)) + 1``; the driver holds one number per dimension."""
    n = df.count()
    found = {r.dim: r.df for r in document_frequency(df, v).collect()}
    dims = max(found, default=-1) + 1
    idf = [math.log((1 + n) / (1 + found.get(i, 0))) + 1 for i in range(dims)]
    scaled = F.zip_with(
        F.col(v), F.array(*[F.lit(x) for x in idf]), lambda x, w: F.coalesce(x * w, F.lit(0.0))
    )
    return df.withColumn(v, unit(scaled) if normalize else scaled)


def long_form(df: DataFrame, key: str, v: str = "v") -> DataFrame:
    """Non-zero entries as (key, dim, value)."""
    return df.select(key, F.posexplode(v).alias("dim", "value")).where("value <> 0")


def projection_signs(dims: int, out_dims: int, seed: int = 42) -> np.ndarray:
    """±1 matrix from MD5 parities, the same on every engine."""
    signs = np.empty((out_dims, dims))
    for j in range(out_dims):
        for i in range(dims):
            digest = hashlib.md5(f"{seed}:{j}:{i}".encode()).hexdigest()
            signs[j, i] = 1.0 if int(digest[0], 16) % 2 == 0 else -1.0
    return signs


def random_projection(df: DataFrame, dims: int, out_dims: int, v: str = "v", seed: int = 42) -> DataFrame:
    """Project to ``out_dims`` with a seeded ±1 matrix; keeps distances in expectation."""
    if not 1 <= out_dims < dims:
        raise ValueError("out_dims must be at least 1 and below the input dimension")
    signs = projection_signs(dims, out_dims, seed).T / math.sqrt(out_dims)

    @F.arrow_udf("array<double>")
    def project(vectors: pa.Array) -> pa.Array:
        return list_column(matrix(vectors) @ signs if len(vectors) else np.zeros((0, out_dims)))

    return df.withColumn(v, project(F.col(v)))


def reduce_pca(df: DataFrame, out_dims: int, v: str = "v") -> tuple[DataFrame, object]:
    """Principal components of the vectors; returns the projected table and the model.

    There must be fewer components than dimensions and no more than rows.
    """
    first = df.select(F.size(v).alias("d")).first()
    if first is None or not 1 <= out_dims < first.d:
        raise ValueError(f"components must be from 1 to one below the dimensions, got {out_dims}")
    if df.limit(out_dims).count() < out_dims:
        raise ValueError(f"fewer rows than components: {out_dims}")
    assembled = df.withColumn("_vec", array_to_vector(F.col(v)))
    model = PCA(k=out_dims, inputCol="_vec", outputCol="_pc").fit(assembled)
    projected = model.transform(assembled).withColumn(v, vector_to_array("_pc")).drop("_vec", "_pc")
    return projected, model


def resolve_weights(n_models: int, weights: list[float] | None = None) -> list[float]:
    """Given weights scaled to sum 1 if there is one per model, uniform otherwise."""
    total = sum(weights) if weights else 0.0
    if weights and len(weights) == n_models and total > 0:
        return [w / total for w in weights]
    return [1.0 / n_models] * n_models


def fuse(parts: list[Column], weights: list[float] | None = None) -> Column:
    """Weighted concatenation of unit parts, scaled to unit length; one part passes through."""
    if len(parts) < 2:
        return parts[0]

    def scaled(part: Column, weight: float) -> Column:
        return F.transform(unit(part), lambda x: x * F.lit(weight))

    return unit(F.concat(*[scaled(p, w) for p, w in zip(parts, resolve_weights(len(parts), weights))]))


def simplex_grid(n_models: int, steps: int = 5) -> list[tuple[float, ...]]:
    """All weight vectors whose entries are multiples of 1/steps and sum to 1, in order."""

    def parts(n: int, left: int):
        if n == 1:
            yield (left,)
            return
        for i in range(left + 1):
            for rest in parts(n - 1, left - i):
                yield (i, *rest)

    return [tuple(p / steps for p in combo) for combo in parts(n_models, steps)]
