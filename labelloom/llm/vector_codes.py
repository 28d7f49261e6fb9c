"""Vector codes: each of eight parts of a vector becomes the number of its nearest codebook entry.

Vectors are integers, floor(4096 x), so that distances, sums and codebooks are exact and alike on any partitioning.
The nearest entry is found through a tree of near neighbours over the entries of each codebook (GNAT): a node has a
few split points, every other entry belongs to the child of its nearest split point, and each split point stores the
range of its distances to the entries of each child. A query at distance d from a split point and r from the best
entry so far skips a child whose range lies strictly beyond [d - r, d + r]. Ranges are rounded outwards, so no entry
at an equal distance is lost; among entries, squared distances are compared as integers and ties go to the lower index.

A round is one pass over the written vectors: tasks send sums per part, entry and position, and the codebooks, at most
``ENTRIES`` entries of a vector's width, come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import cut

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
DEGREE = 4
#: Squared distances of integer components up to this bound stay within 64 bits for parts of up to 1,024 components.
LARGEST = 2**25
#: Relative error allowed to a rounded distance.
_ROUND = 1e-12


def _squares(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    gap = x - entry
    return np.einsum("ij,ij->i", gap, gap)


class Gnat:
    """Nearest entries of integer vectors. ``met`` counts the distances that searches have computed."""

    def __init__(self, entries: np.ndarray, members: np.ndarray | None = None, degree: int = DEGREE) -> None:
        self.entries = entries
        members = np.arange(len(entries)) if members is None else members
        # Split points: the first entry, then always the one farthest from those chosen.
        split = [int(members[0])]
        away = _squares(entries[members], entries[split[0]])
        while len(split) < min(degree, members.size):
            far = int(away.argmax())
            if away[far] == 0:
                break
            split.append(int(members[far]))
            away = np.minimum(away, _squares(entries[members], entries[split[-1]]))
        if away.max(initial=0) == 0:  # only copies of the split points are left: all are compared
            split = [int(m) for m in members]
        self.split = split
        rest = np.setdiff1d(members, split)
        to = np.stack([_squares(entries[rest], entries[s]) for s in split]) if rest.size else np.zeros((len(split), 0), np.int64)
        home = to.argmin(axis=0)
        self.children = []
        for j in range(len(split)):
            inside = home == j
            if inside.any():
                span = np.sqrt(to[:, inside].astype(np.float64))
                low, high = span.min(axis=1) * (1 - _ROUND), span.max(axis=1) * (1 + _ROUND)
                self.children.append((low, high, Gnat(entries, rest[inside], degree)))

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(index, squared distance) of the nearest entry of each row, ties to the lower index, and distances computed."""
        index = np.full(len(x), len(self.entries), np.int64)
        best = np.full(len(x), np.iinfo(np.int64).max, np.int64)
        return index, best, self._visit(x, np.arange(len(x)), index, best)

    def _visit(self, x: np.ndarray, rows: np.ndarray, index: np.ndarray, best: np.ndarray) -> int:
        points = x[rows]
        away = np.empty((len(self.split), rows.size))
        for i, s in enumerate(self.split):
            square = _squares(points, self.entries[s])
            away[i] = square
            better = (square < best[rows]) | ((square == best[rows]) & (s < index[rows]))
            index[rows[better]], best[rows[better]] = s, square[better]
        np.sqrt(away, out=away)
        met = len(self.split) * rows.size
        for low, high, child in self.children:
            reach = np.sqrt(best[rows].astype(np.float64))
            near, far = (away - reach) * (1 - _ROUND) - _ROUND * reach, (away + reach) * (1 + _ROUND)
            open_ = ((near <= high[:, None]) & (far >= low[:, None])).all(axis=0)
            if open_.any():
                met += child._visit(x, rows[open_], index, best)
        return met


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<i4").reshape(len(rows), width).astype(np.int64)


def assign(x: np.ndarray, trees: list[Gnat]) -> tuple[np.ndarray, np.ndarray]:
    """(entry of each part, squared distance of each part) of whole vectors."""
    parts = x.reshape(len(x), PARTS, -1)
    found = [tree.search(np.ascontiguousarray(parts[:, p]))[:2] for p, tree in enumerate(trees)]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def whole_numbers(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, width, q): floor(4096 x) as little-endian integers; rows with missing or non-finite components are gone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, at = [], []
            for i, row in enumerate(batch.column(2)):
                values = row.values if row.is_valid else None
                if values is None or values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False)
                if not np.isfinite(x).all():
                    continue
                q = np.floor(SCALE * x)
                if np.abs(q).max(initial=0) > LARGEST:
                    raise ValueError(f"components must lie within {LARGEST / SCALE:g} of zero")
                out.append(q.astype("<i4").tobytes())
                at.append(i)
            pick = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pick), batch.column(1).take(pick), pa.array([len(b) // 4 for b in out], pa.int32()), pa.array(out, pa.binary())],
                names=["id", "label", "width", "q"],
            )

    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    return rows.mapInArrow(run, "id long, label string, width int, q binary")


def _sums(rows: DataFrame, codebooks: list[np.ndarray], width: int) -> DataFrame:
    """(part, entry, place, total, n) over the parts assigned to each entry."""
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)
    wide = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(c) for c in shared.value]
        entries = len(shared.value[0])
        total, n = np.zeros((PARTS, entries, wide), np.int64), np.zeros((PARTS, entries), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            index, _ = assign(x, trees)
            parts = x.reshape(len(x), PARTS, wide)
            for p in range(PARTS):
                for e in np.unique(index[:, p]):
                    mine = index[:, p] == e
                    total[p, e] += parts[mine, p].sum(axis=0)
                    n[p, e] += mine.sum()
        p, e, i = np.indices(total.shape)
        used = np.repeat(n[:, :, None], wide, axis=2).ravel() > 0
        columns = [x.ravel()[used] for x in (p, e, i, total, np.repeat(n[:, :, None], wide, axis=2))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(t)) for c, t in zip(columns, ("i4", "i4", "i4", "i8", "i8"), strict=True)],
            names=["part", "entry", "place", "total", "n"],
        )

    found = rows.select("q").mapInArrow(run, "part int, entry int, place int, total long, n long")
    return found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def train(rows: DataFrame, width: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks of the parts of ``rows`` (id, q) of one width, from the parts of the smallest ids; null ids come last."""
    first = rows.orderBy(F.asc_nulls_last("id"), "q").select("q").limit(entries).collect()
    start = np.stack([np.frombuffer(bytes(r["q"]), "<i4") for r in first]).astype(np.int64).reshape(len(first), PARTS, -1)
    codebooks = [start[:, p].copy() for p in range(PARTS)]
    for _ in range(rounds):
        for r in _sums(rows, codebooks, width).collect():
            codebooks[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return codebooks


def digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in codebooks for x in book.ravel().tolist()).encode()).hexdigest()


def encode(rows: DataFrame, codebooks: list[np.ndarray], width: int) -> DataFrame:
    """(id, label, code, error) of (id, label, width, q); code and error are null for rows of another width."""
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(c) for c in shared.value]
        for batch in batches:
            fits = batch.column(2).to_numpy() == width if trees else np.zeros(batch.num_rows, bool)
            at = np.flatnonzero(fits)
            codes, errors = [None] * batch.num_rows, np.zeros(batch.num_rows, np.int64)
            if at.size:
                index, square = assign(_matrix(batch.column(3).take(pa.array(at)), width), trees)
                errors[at] = square.sum(axis=1)
                for i, row in zip(at, index.astype(np.uint8), strict=True):
                    codes[i] = row.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, mask=~fits)], names=["id", "label", "code", "error"]
            )

    return rows.select("id", "label", "width", "q").mapInArrow(run, "id long, label string, code string, error long")


def vector_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every row whose vector is complete and finite.

    Each codebook starts as the parts of the vectors with the ``entries`` smallest keys (equal keys by content, null keys
    last) and follows ``rounds`` rounds of assignment and componentwise floor of the mean; entries without parts stay.
    With fewer vectors there are fewer entries. Repeated rows count each time.

    All vectors must share one width that is a multiple of eight, that of the smallest key with such a width; other
    widths, empty vectors among them, take no part in the codebooks and get a null code and error. Components outside
    8,192 fail the job, as 64 bits would not hold their distances. Nulls together are one label. An empty table
    gives no row. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must lie between 1 and 256")
    base = cut(whole_numbers(vectors, key, vector, label), "whole")
    leader = base.where((F.col("width") > 0) & (F.col("width") % PARTS == 0)).orderBy(F.asc_nulls_last("id"), "q").select("width").first()
    width = leader["width"] if leader else 0
    if width // PARTS > 1024:
        raise ValueError("a part may have 1,024 components at most")
    codebooks = train(base.where(F.col("width") == width), width, entries, rounds) if leader else []
    coded = cut(encode(base, codebooks, width), "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(key), "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
