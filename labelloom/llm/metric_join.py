"""Embedding near-duplicates as an exact metric range join.

Vectors are compared by the Euclidean distance of their directions, d = sqrt(2 - 2 cos), which is a metric.
Within each label, pivots cut the space into cells of nearest pivots. A vector at distance d_i from its own
pivot and d_j from another can only have a partner in that other cell if d_j - d_i <= 2 r (triangle
inequality) and if it lies within r of the plane between both pivots; then it is copied there. Copies go to
cells of lower number only, so each pair meets once, and every cell joins by itself. Inside a cell vectors are
sorted by distance to the pivot and only rings closer than r meet.

Equal vectors are collapsed before the join. Cells above ``TILE`` rows are dealt over pairs of hashed chunks.
Each cell gives back partner counts and a forest, never its pairs. Vectors without any structure have no
empty regions to skip; there the work approaches all pairs, as any exact method's does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.common import cut, join_labels, tiles, whole_runs
from labelloom.operators.graph import components

#: Rows that one pivot should stand for, and the most pivots that are sent to the tasks.
CELL, PIVOTS = 512, 4096
TILE = 4096
_SLACK = 1e-6
_BLOCK = 512


def _prepare(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, h, v): v holds the components as little-endian doubles; h is null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for known, row in zip(batch.column(1).is_valid().to_pylist(), batch.column(2), strict=True):
                values = row.values if row.is_valid else None
                ok = known and values is not None and len(values) > 0 and values.null_count == 0
                x = values.to_numpy(zero_copy_only=False) + 0.0 if ok else None  # adding zero turns -0.0 into 0.0
                out.append(x.astype("<f8").tobytes() if ok and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "label", "v"])

    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    found = rows.mapInArrow(run, "id long, label string, v binary")
    return found.withColumn("h", F.when(F.col("id").isNotNull(), F.sha2("v", 256)))


def _units(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)


def _pivots(reps: DataFrame, sizes: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """Directions of the pivots of each large (label, width); at most PIVOTS in all, few per label if labels are many."""
    large = sizes.where(F.col("n") > CELL)
    total = large.agg(F.sum("n")).first()[0] or 0
    if not total:
        return {}
    share = F.ceil(F.least(F.col("n") / F.lit(CELL), F.col("n") * F.lit(PIVOTS / 2 / total))).cast("int")
    few = large.orderBy(F.desc("n"), "label", "width").limit(PIVOTS // 2).select("label", "width", share.alias("k"))
    order = Window.partitionBy("label", "width").orderBy(F.xxhash64("rep"), "rep")
    chosen = (
        reps.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PIVOTS)
        .join(F.broadcast(few), ["label", "width"]).where("place <= k").select("label", "width", "v", "rep").collect()
    )
    found: dict[tuple[str, int], list[tuple[int, bytes]]] = {}
    for r in chosen:
        found.setdefault((r["label"], r["width"]), []).append((r["rep"], bytes(r["v"])))
    return {k: _units(np.stack([np.frombuffer(v, "<f8") for _, v in sorted(rows)])) for k, rows in found.items()}


def _cells(reps: DataFrame, pivots: dict[tuple[str, int], np.ndarray], radius: float) -> DataFrame:
    """(label, width, cell, own, d, rep, weight, v): each row in its own cell and in lower cells within reach."""
    shared = reps.sparkSession.sparkContext.broadcast(pivots)

    def place(rep, weight, v, label, width) -> pa.RecordBatch:
        p = shared.value.get((label, width))
        n = len(rep)
        if p is None:
            at, cell, own, d = np.arange(n), np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n)
        else:
            dist = np.sqrt(np.maximum(2 - 2 * (_units(_matrix(v)) @ p.T), 0))
            near = dist.argmin(axis=1)
            mine = dist[np.arange(n), near]
            gap = np.sqrt(np.maximum(2 - 2 * (p @ p.T), 1e-18))[near]
            reach = (dist - mine[:, None] <= 2 * radius + _SLACK) & (
                (dist**2 - mine[:, None] ** 2) / (2 * gap) <= radius + _SLACK / gap
            )
            reach &= np.arange(p.shape[0]) < near[:, None]
            reach[np.arange(n), near] = True
            at, cell = np.nonzero(reach)
            own, d = cell == near[at], dist[at, cell]
        pick = pa.array(at)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([label] * at.size, pa.string()), pa.array([width] * at.size, pa.int32()), pa.array(cell.astype(np.int32)),
                pa.array(own), pa.array(d), rep.take(pick), weight.take(pick), v.take(pick),
            ],
            names=["label", "width", "cell", "own", "d", "rep", "weight", "v"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple[str, int], list[int]] = {}
            for i, k in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                groups.setdefault(k, []).append(i)
            for (label, width), at in groups.items():
                for k in range(0, len(at), 2048):
                    pick = pa.array(at[k : k + 2048])
                    yield place(batch.column(2).take(pick), batch.column(3).take(pick), batch.column(4).take(pick), label, width)

    return reps.select("label", "width", "rep", "weight", "v").mapInArrow(
        run, "label string, width int, cell int, own boolean, d double, rep long, weight long, v binary"
    )


def join_cell(x: np.ndarray, d: np.ndarray, own: np.ndarray, chunk: np.ndarray, two: bool, weight: np.ndarray, cosine: float,
              radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(partners by weight, label of the least linked row) of each row of a cell.

    Pairs of two copied rows belong to another cell; in a tile of ``two`` chunks pairs inside one chunk belong to another tile.
    """
    n = d.size
    order = np.argsort(d, kind="stable")
    x, d, own, chunk, weight_in = x[order], d[order], own[order], chunk[order], weight[order]
    u = _units(x)
    size = np.sqrt((x * x).sum(axis=1))
    counts, label = np.zeros(n, np.int64), np.arange(n)
    for at in range(0, n, _BLOCK):
        stop = min(at + _BLOCK, n)
        end = int(np.searchsorted(d, d[stop - 1] + radius + _SLACK, "right"))
        near = u[at:stop] @ u[at:end].T >= cosine - 1e-9
        near &= np.arange(at, end)[None] > np.arange(at, stop)[:, None]
        near &= own[at:stop, None] | own[None, at:end]
        if two:
            near &= chunk[at:stop, None] != chunk[None, at:end]
        i, j = np.nonzero(near)
        for k in range(0, i.size, 65536):
            a, b = i[k : k + 65536] + at, j[k : k + 65536] + at
            exact = np.einsum("ij,ij->i", x[a], x[b]) / (size[a] * size[b])
            extreme = ~np.isfinite(exact)
            exact[extreme] = np.einsum("ij,ij->i", u[a[extreme]], u[b[extreme]])
            a, b = a[exact >= cosine], b[exact >= cosine]
            np.add.at(counts, a, weight_in[b])
            np.add.at(counts, b, weight_in[a])
            join_labels(label, a, b)
    while True:
        jump = label[label]
        if np.array_equal(jump, label):
            break
        label = jump
    back_counts, back_label = np.empty(n, np.int64), np.empty(n, np.int64)
    back_counts[order], back_label[order] = counts, order[label]
    return back_counts, back_label


def _join(cells: DataFrame, cosine: float, radius: float, tile: int) -> DataFrame:
    """(a, b, n): partners of row a found in one cell, and the row b that stands for its links there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def key(table: pa.Table) -> np.ndarray:
            parts = [table.column(c).to_numpy().astype(np.int64) for c in ("width", "cell", "tile")]
            names = table.column("label").combine_chunks().dictionary_encode()
            names = names.chunk(0) if isinstance(names, pa.ChunkedArray) else names
            parts.append(names.indices.to_numpy(zero_copy_only=False).astype(np.int64))
            new = np.zeros(table.num_rows, bool)
            for p in parts:
                new[1:] |= p[1:] != p[:-1]
            return np.cumsum(new)

        for table in whole_runs(batches, key, 20_000):
            group = key(table)
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            for at, end in zip(starts, np.r_[starts[1:], group.size], strict=True):
                part = table.slice(at, end - at)
                own = part.column("own").to_numpy(zero_copy_only=False).astype(bool)
                if part.num_rows < 2 or not own.any():
                    continue
                rep, weight = part.column("rep").to_numpy(), part.column("weight").to_numpy()
                counts, label = join_cell(
                    _matrix(part.column("v")), part.column("d").to_numpy(), own, part.column("chunk").to_numpy(),
                    part.column("chunk")[0].as_py() != part.column("other")[0].as_py(), weight, cosine, radius,
                )
                hit = counts > 0
                if hit.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rep[hit]), pa.array(rep[label[hit]]), pa.array(counts[hit])], names=["a", "b", "n"]
                    )

    rows = tiles(cells, ["label", "width", "cell"], "rep", tile)
    return (
        rows.repartition("label", "width", "cell", "tile").sortWithinPartitions("label", "width", "cell", "tile", "rep")
        .mapInArrow(run, "a long, b long, n long")
    )


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = 0.98, tile: int = TILE) -> DataFrame:
    """(key, n_links, component_id) of every row: rows of the same label with a cosine of at least ``cosine`` are linked.

    ``cosine`` must be above 0. Rows with a null key or label and vectors that are null, empty, zero or hold null
    or non-finite components have no links and form their own component. Vectors of different widths do not link.
    Equal keys count as rows of their own. Other columns are not read.
    """
    radius = float(np.sqrt(2 - 2 * cosine))
    base = cut(_prepare(vectors, key, vector, label), "vectors")
    width = (F.octet_length("v") / 8).cast("int")
    valid = base.where("h is not null").withColumn("width", width)
    classes = cut(valid.groupBy("label", "h").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")), "classes")
    reps = cut(
        valid.join(classes, (valid.id == classes.rep) & (valid.h == classes.h) & (valid.label == classes.label))
        .select(valid.label, "width", classes.h, "rep", "weight", "v").dropDuplicates(["label", "h"]),
        "reps",
    )
    sizes = reps.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n"))
    found = cut(_join(cut(_cells(reps, _pivots(reps, sizes), radius), "placed"), cosine, radius, tile), "links")
    partners = found.groupBy("a").agg(F.sum("n").alias("n"))
    linked = components(found)
    named = (
        classes.join(partners, classes.rep == partners.a, "left").join(linked, classes.rep == linked.node, "left")
        .select(
            "label", "h", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    return base.join(named, ["label", "h"], "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
