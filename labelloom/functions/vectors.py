"""Column expressions and Arrow helpers for ARRAY<DOUBLE> vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    )


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, 0 when either vector is zero."""
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0, F.lit(0.0)).otherwise(dot(a, b) / lengths)


def unit(v: Column) -> Column:
    """L2-normalised vector; a zero vector stays zero.

    The one-element array binds the length, which a plain reference inside the
    inner lambda would compute again for every entry.
    """
    length = F.array(norm(v))
    return F.get(
        F.transform(
            length, lambda n: F.when(n == 0, v).otherwise(F.transform(v, lambda x: x / n))
        ),
        F.lit(0),
    )


def centroids(df: DataFrame, key: str, v: str = "v") -> DataFrame:
    """Mean vector and size per key; one partially aggregated row per key and task."""
    return df.groupBy(key).agg(
        vector_to_array(Summarizer.mean(array_to_vector(F.col(v)))).alias("centroid"),
        F.count(F.lit(1)).alias("n"),
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Dense matrix of a list column of one Arrow batch, without per-row work."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if rows == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(rows, -1)


def list_column(m: np.ndarray) -> pa.Array:
    """Arrow list column of the rows of a matrix."""
    rows, width = m.shape
    offsets = np.arange(0, (rows + 1) * width, width or 1, dtype=np.int32)[: rows + 1]
    if width == 0:
        offsets = np.zeros(rows + 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(m).ravel()))


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.maximum(d2, 0.0)


def rough_squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """(r, room): the squared distances of the rows of x from those of y without each row's own |x|^2, and their error at most.

    In single precision where that can hold the values: for finding the few pairs whose distance is then taken exactly.
    """
    longest = max(float((x * x).sum(1).max()), float((y * y).sum(1).max()))
    kind = np.float32 if 1e-20 < longest < 1e30 else np.float64
    out = (-2 * x).astype(kind) @ y.astype(kind).T
    out += (y * y).sum(1).astype(kind)[None, :]
    return out, 4 * (x.shape[1] + 8) * float(np.finfo(kind).eps) * longest


def paired_distances(x: np.ndarray, y: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Distances between rows of x and rows of y, pair by pair, without cancellation."""
    out = np.empty(len(row))
    step = max(1, (1 << 20) // max(1, x.shape[1]))
    for start in range(0, len(row), step):
        part = slice(start, start + step)
        out[part] = np.sqrt(((x[row[part]] - y[col[part]]) ** 2).sum(-1))
    return out


def to_bytes(column: pa.Array) -> bytes:
    """A column of numbers or of equally long lists as raw 8-byte values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_list(column.type):
        column = column.flatten()
    kind = np.int64 if pa.types.is_integer(column.type) else np.float64
    return column.to_numpy(zero_copy_only=False).astype(kind, copy=False).tobytes()


def from_bytes(raw: pa.Scalar, rows: int, kind: type = np.float64, wide: bool = False) -> np.ndarray:
    values = np.frombuffer(raw.as_buffer(), dtype=kind)
    return values.reshape(rows, -1) if wide else values
