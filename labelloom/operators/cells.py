"""Exact distance joins through cells around pivots.

Every point belongs to its nearest pivot; a cell is a pivot, a ring of
distances to it and, where a ring is still too full, a hash chunk.  Cells
therefore have a bounded number of rows whatever the skew.  A point only meets
the cells that the triangle inequality and the bisecting plane between two
pivots leave within its search radius, so results equal those over all pairs.

What reaches the driver or is broadcast is bounded by constants: at most
``MAX_PIVOTS`` vectors (and ``MAX_PIVOT_BYTES``) and ``MAX_RINGS`` rings each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom.functions.vectors import from_bytes, list_column, matrix, squared_distances, to_bytes
from labelloom.scratch import cut, give_back, parallelism, spread

CELL_ROWS = 1024
MAX_PIVOTS = 1024
MAX_PIVOT_BYTES = 64 << 20
MAX_RINGS = 64
SLACK = 1e-7
#: Bytes of vectors on one side of a tile of cells, and rows that are folded at once.
TILE_BYTES = 64 << 20
FOLD_ROWS = 1 << 20
#: Values of rows by rings that are held at once.
STEP_VALUES = 1 << 18


@dataclass
class Layout:
    """Pivots and the rings around them."""

    pivots: np.ndarray
    ring_pivot: np.ndarray
    ring_no: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    chunks: np.ndarray
    max_extra: np.ndarray
    pivot_extra: np.ndarray
    first_id: np.ndarray

    @property
    def pivot_gaps(self) -> np.ndarray:
        return np.sqrt(squared_distances(self.pivots, self.pivots))


@dataclass
class Cells:
    """``packed`` has one row per cell: cell, n and the raw bytes of ids, vs and extra.

    ``placed`` holds the single rows with their pivot and ring.
    """

    packed: DataFrame
    layout: Layout
    placed: DataFrame | None = None


_PACKED = "cell bigint, n bigint, ids binary, vs binary, extra binary"


def _pack(group: pa.Table) -> pa.Table:
    """One row of raw bytes per cell, so that joins move buffers instead of nested arrays."""
    return pa.table(
        {
            "cell": group["cell"].slice(0, 1),
            "n": pa.array([group.num_rows]),
            "ids": pa.array([to_bytes(group["id"])], type=pa.binary()),
            "vs": pa.array([to_bytes(group["v"])], type=pa.binary()),
            "extra": pa.array([to_bytes(group["extra"])], type=pa.binary()),
        }
    )


def _cell_key(pivot, ring, chunk):
    return (pivot << 32) + (ring << 24) + chunk


def nearest_pivots(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of every row of x and the distance to it, a few rows at a time."""
    near, gap = np.empty(len(x), dtype=np.int64), np.empty(len(x))
    step = max(1, STEP_VALUES // len(pivots))
    for start in range(0, len(x), step):
        d2 = squared_distances(x[start : start + step], pivots)
        near[start : start + step] = at = d2.argmin(1)
        gap[start : start + step] = np.sqrt(d2[np.arange(len(at)), at])
    return near, gap


def build_cells(
    points: DataFrame,
    extra: str | None = None,
    cell_rows: int = CELL_ROWS,
    max_pivots: int = MAX_PIVOTS,
) -> Cells:
    """Arrange a written table of (id BIGINT, v ARRAY<DOUBLE>) into packed cells."""
    n = points.count()
    if n == 0:
        raise ValueError("no points")
    dims = points.select(F.size("v").alias("d")).first().d
    if n <= cell_rows:
        return _single_cell(points, extra, n)
    wanted = max(1, min(max_pivots, math.ceil(n / cell_rows), MAX_PIVOT_BYTES // (8 * max(dims, 1))))
    more = (F.col(extra) if extra else F.lit(0.0)).cast("double").alias("extra")
    chosen = points.orderBy(F.xxhash64("id"), "id").limit(wanted).select("v", more).collect()
    pivots = np.array([r.v for r in chosen], dtype=np.float64).reshape(len(chosen), dims)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            near, gap = nearest_pivots(matrix(batch["v"]), pivots)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["v"], batch["extra"], pa.array(near), pa.array(gap)],
                ["id", "v", "extra", "pivot", "gap"],
            )
            batch = None
        give_back()

    source = points.select("id", "v", more)
    placed = cut(
        spread(source).mapInArrow(
            place, "id bigint, v array<double>, extra double, pivot bigint, gap double"
        ),
        "placed",
    )
    spans = placed.groupBy("pivot").agg(
        F.count(F.lit(1)).alias("rows"), F.min("gap").alias("low"), F.max("gap").alias("high"),
        F.max("extra").alias("max_extra"), F.min("id").alias("first_id"),
    ).collect()
    session = points.sparkSession
    ring_counts = {
        r.pivot: 1 if r.rows <= 4 * cell_rows else min(MAX_RINGS, math.ceil(r.rows / cell_rows))
        for r in spans
    }
    if max(ring_counts.values()) == 1:
        rings = [(r.pivot, 0, r.rows, r.low, r.high, r.max_extra, r.first_id) for r in spans]
        ringed = placed.withColumn("ring", F.lit(0).cast("bigint"))
    else:
        widths = session.createDataFrame(
            [
                (r.pivot, ring_counts[r.pivot], r.low, (r.high - r.low) / ring_counts[r.pivot])
                for r in spans
            ],
            "pivot bigint, n_rings bigint, start double, width double",
        )
        # Bounded by MAX_PIVOTS rows.
        ringed = placed.join(F.broadcast(widths), "pivot").withColumn(
            "ring",
            F.when(F.col("width") <= 0, F.lit(0)).otherwise(
                F.least(F.floor((F.col("gap") - F.col("start")) / F.col("width")), F.col("n_rings") - 1)
            ).cast("bigint"),
        )
        rings = [
            (r.pivot, r.ring, r.rows, r.low, r.high, r.max_extra, r.first_id)
            for r in ringed.groupBy("pivot", "ring").agg(
                F.count(F.lit(1)).alias("rows"), F.min("gap").alias("low"), F.max("gap").alias("high"),
                F.max("extra").alias("max_extra"), F.min("id").alias("first_id"),
            ).collect()
        ]
    layout = _layout(pivots, np.array([r.extra for r in chosen], dtype=np.float64), rings, cell_rows)
    return Cells(cut(_pack_cells(ringed, layout), "packed"), layout, ringed)


def _layout(pivots: np.ndarray, pivot_extra: np.ndarray, rings: list[tuple], cell_rows: int) -> Layout:
    """Layout of rings given as (pivot, ring, rows, low, high, max_extra, first_id)."""
    columns = list(zip(*sorted(rings))) or [()] * 7
    rows = np.array(columns[2], dtype=np.int64)
    return Layout(
        pivots,
        np.array(columns[0], dtype=np.int64),
        np.array(columns[1], dtype=np.int64),
        np.array(columns[3], dtype=np.float64),
        np.array(columns[4], dtype=np.float64),
        rows,
        np.maximum(1, -(-rows // cell_rows)),
        np.array(columns[5], dtype=np.float64),
        pivot_extra,
        np.array(columns[6], dtype=np.int64),
    )


def _pack_cells(ringed: DataFrame, layout: Layout) -> DataFrame:
    ring_table = ringed.sparkSession.createDataFrame(
        list(zip(layout.ring_pivot.tolist(), layout.ring_no.tolist(), layout.chunks.tolist())),
        "pivot bigint, ring bigint, n_chunks bigint",
    )
    return (
        # At most MAX_PIVOTS * MAX_RINGS rows of three numbers.
        ringed.join(F.broadcast(ring_table), ["pivot", "ring"])
        .withColumn(
            "cell",
            F.col("pivot") * F.lit(1 << 32)
            + F.col("ring") * F.lit(1 << 24)
            + F.pmod(F.xxhash64("id"), F.col("n_chunks")),
        )
        .groupBy("cell")
        .applyInArrow(_pack, _PACKED)
    )

def split_leaders(cells: Cells, leaders: int) -> tuple[Cells, Cells]:
    """Cells of the ``leaders`` earliest rows of every pivot, and cells of the other rows."""
    rank = F.row_number().over(Window.partitionBy("pivot").orderBy("id"))
    ranked = cells.placed.withColumn("rank", rank).where(F.col("rank") <= leaders)
    head = cut(ranked.drop("rank").withColumn("ring", F.lit(0).cast("bigint")), "leaders")
    tail = cells.placed.join(head.select("id"), "id", "left_anti")
    return _part(head, cells.layout), _part(cut(tail, "followers"), cells.layout)


def _part(rows: DataFrame, whole: Layout, cell_rows: int = CELL_ROWS) -> Cells:
    """Cells of some of the placed rows, with the same pivots and ring numbers."""
    rings = [
        (r.pivot, r.ring, r.rows, r.low, r.high, 0.0, r.first_id)
        for r in rows.groupBy("pivot", "ring").agg(
            F.count(F.lit(1)).alias("rows"), F.min("gap").alias("low"), F.max("gap").alias("high"),
            F.min("id").alias("first_id"),
        ).collect()
    ]
    layout = _layout(whole.pivots, whole.pivot_extra, rings, cell_rows)
    return Cells(cut(_pack_cells(rows, layout), "packed_part"), layout, rows)


def repack(points: DataFrame, cells: Cells, extra: str, cell_rows: int = CELL_ROWS) -> Cells:
    """The same cells with another BIGINT or DOUBLE column as ``extra``."""
    rows = cells.placed.drop("extra").join(points.select("id", F.col(extra).alias("extra")), "id").select(
        "id", "v", "extra", "pivot", "gap", "ring"
    )
    return Cells(cut(_pack_cells(rows, cells.layout), "repacked"), cells.layout, rows)


def _single_cell(points: DataFrame, extra: str | None, n: int) -> Cells:
    """All points in one cell; only called for at most ``cell_rows`` points."""
    packed = cut(
        points.select(
            F.lit(0).cast("bigint").alias("cell"), "id", "v",
            (F.col(extra) if extra else F.lit(0.0)).cast("double").alias("extra"),
        ).groupBy("cell").applyInArrow(_pack, _PACKED),
        "packed",
    )
    row = packed.first()
    x = np.frombuffer(row.vs, dtype=np.float64).reshape(n, -1)
    more = np.frombuffer(row.extra, dtype=np.float64)
    pivot = x[:1]
    gaps = np.sqrt(squared_distances(pivot, x))[0]
    zero = np.zeros(1, dtype=np.int64)
    layout = Layout(
        pivot, zero, zero, np.array([gaps.min()]), np.array([gaps.max()]), np.array([n]),
        zero + 1, more.max(keepdims=True), more[:1], zero,
    )
    return Cells(packed, layout)


def block_of(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, matrix and extra values of one packed cell."""
    n = batch["n"][row].as_py()
    return (
        from_bytes(batch["ids"][row], n, np.int64),
        from_bytes(batch["vs"][row], n, wide=True),
        from_bytes(batch["extra"][row], n),
    )


def reachable(layout: Layout, cell: int, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Cells that may hold a point within ``radius`` (per row, or per row and ring) of a row of x."""
    home = cell >> 32
    radius = radius if radius.ndim == 2 else radius[:, None]
    gaps = np.sqrt(squared_distances(layout.pivots[home : home + 1], layout.pivots))[0]
    met = np.zeros(len(layout.rows), dtype=bool)
    # A layout may have many rings: few rows at a time keep what is held for them small.
    step = max(1, STEP_VALUES // max(1, len(layout.rows), len(layout.pivots)))
    for start in range(0, len(x), step):
        part, reach = x[start : start + step], radius[start : start + step]
        d = np.sqrt(squared_distances(part, layout.pivots))
        to_ring = d[:, layout.ring_pivot]
        near = (to_ring - layout.high <= reach + SLACK) & (layout.low - to_ring <= reach + SLACK)
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d * d - d[:, home : home + 1] ** 2) / (2 * gaps)
        plane[:, gaps <= SLACK] = -np.inf
        near &= plane[:, layout.ring_pivot] <= reach + SLACK
        met |= near.any(0)
    hit = np.flatnonzero(met)
    keys = [
        _cell_key(layout.ring_pivot[r], layout.ring_no[r], np.arange(layout.chunks[r], dtype=np.int64))
        for r in hit
    ]
    return np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)


def with_targets(
    cells: Cells,
    radius: Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    symmetric: bool,
    targets: Layout | None = None,
    by_ring: bool = False,
) -> DataFrame:
    """Packed cells with the radius of every row and the cells they must meet.

    ``radius(cell, ids, x, extra)`` gives one radius per row, or one per row and ring; the latter is asked for
    a part of the cell's rows at a time.
    With ``symmetric`` a pair of cells appears once.  ``targets`` are the rings
    to meet, by default the own ones.
    """
    layout = targets or cells.layout

    def target(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cell = batch["cell"][row].as_py()
                ids, x, extra = block_of(batch, row)
                found, per_row = [], []
                step = max(1, STEP_VALUES // max(1, len(layout.rows))) if by_ring else len(ids)
                for start in range(0, len(ids), step):
                    part = slice(start, start + step)
                    reach = radius(cell, ids[part], x[part], extra[part])
                    found.append(reachable(layout, cell, x[part], reach))
                    per_row.append(reach if reach.ndim == 1 else reach.max(1))
                found, per_row = np.unique(np.concatenate(found)), np.concatenate(per_row)
                if symmetric:
                    found = found[found >= cell]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([cell]),
                        batch["n"].slice(row, 1),
                        batch["ids"].slice(row, 1),
                        batch["vs"].slice(row, 1),
                        batch["extra"].slice(row, 1),
                        pa.array([per_row.astype(np.float64).tobytes()], type=pa.binary()),
                        list_column(found[None, :]),
                    ],
                    ["cell", "n", "ids", "vs", "extra", "radius", "targets"],
                )
            batch = ids = x = extra = None
            give_back()

    return cut(
        cells.packed.mapInArrow(
            target,
            f"{_PACKED}, radius binary, targets array<bigint>",
        ),
        "targets",
    )


@dataclass
class Block:
    """Rows of one packed cell; ``radius`` only on the searching side, ``kept`` is what a kernel keeps with it in a tile."""

    cell: int
    ids: np.ndarray
    v: np.ndarray
    extra: np.ndarray
    radius: np.ndarray | None = None
    kept: dict | None = None


def _blocks(table: pa.Table) -> list[Block]:
    out = []
    for batch in table.to_batches():
        for row in range(batch.num_rows):
            ids, v, extra = block_of(batch, row)
            radius = from_bytes(batch["radius"][row], len(ids)) if "radius" in table.column_names else None
            out.append(Block(batch["cell"][row].as_py(), ids, v, extra, radius))
    return out


def tile_side(session: SparkSession, n_blocks: int, n_bytes: int) -> int:
    """Tiles along one side: a few for every core, more where one would pass ``TILE_BYTES``, never more than blocks."""
    for_cores = math.ceil(math.sqrt(4 * session.sparkContext.defaultParallelism))
    return max(1, min(n_blocks, max(for_cores, math.ceil(n_bytes / TILE_BYTES))))


def meet(left: DataFrame, right: DataFrame, keys: list[str], run: Callable, schema: str) -> DataFrame:
    """``run(left rows, right rows)`` once per tile, tiles dealt over all cores."""
    parts = 4 * parallelism(left.sparkSession)
    # Fresh keys: both sides may come from one table.
    fresh = [side.select(*[F.col(c).alias(c) for c in side.columns]) for side in (left, right)]
    sides = [side.repartition(parts, *keys).groupBy(*keys) for side in fresh]
    return sides[0].cogroup(sides[1]).applyInArrow(run, schema)


def join_cells(
    cells: Cells, sources: DataFrame, kernel: Callable, schema: str, fold: Callable | None = None, own: bool = False
) -> DataFrame:
    """Run ``kernel(a, bs)`` for every searching cell and the cells it must meet, tile by tile.

    Cells are dealt to tiles; a task takes a tile of searching cells and one of found cells, so a cell
    is sent once per tile and not once per cell it meets.  With ``own`` the searching cells are those of
    ``cells``: two tiles then meet in one task for both directions, and a cell that searches there is not
    sent again to be found, so it is sent half as often.  The kernel yields dicts of columns.  ``fold``
    reduces the rows of a tile (a dict of columns) whenever ``FOLD_ROWS`` have come together.
    """
    session = sources.sparkSession
    row_bytes = 8 * (cells.layout.pivots.shape[1] + 2)
    size = sources.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if own:
        side = tile_side(session, size.blocks, size.rows * row_bytes)
        part = lambda c: F.pmod(F.xxhash64(c), F.lit(side))
        pair = lambda a, c: F.least(part(a), part(c)) * F.lit(side) + F.greatest(part(a), part(c))
        keys = ["tile"]
        left = sources.withColumn("tile", F.explode(F.array_distinct(F.transform("targets", lambda c: pair("cell", c))))).withColumn(
            "targets", F.filter("targets", lambda c: pair("cell", c) == F.col("tile"))
        )
        met = sources.select(F.col("cell").alias("a"), F.explode("targets").alias("cell")).select(pair("a", "cell").alias("tile"), "cell").distinct()
        right = cells.packed.join(met.join(left.select("tile", "cell"), ["tile", "cell"], "left_anti"), "cell")
    else:
        a_side = tile_side(session, size.blocks, size.rows * row_bytes)
        b_side = tile_side(session, int(cells.layout.chunks.sum()), int(cells.layout.rows.sum()) * row_bytes)
        tile = lambda c: F.pmod(F.xxhash64(c), F.lit(b_side))
        keys = ["a_tile", "b_tile"]
        searching = sources.withColumn("a_tile", F.pmod(F.xxhash64("cell"), F.lit(a_side)))
        left = searching.withColumn(
            "b_tile", F.explode(F.array_distinct(F.transform("targets", tile)))
        ).withColumn("targets", F.filter("targets", lambda c: tile(c) == F.col("b_tile")))
        met = searching.select("a_tile", F.explode("targets").alias("cell")).distinct()
        right = cells.packed.join(met, "cell").withColumn("b_tile", tile("cell"))
    names = [part.split()[0] for part in schema.split(",")]
    types = {n: pa.int64() if t == "bigint" else pa.float64() for n, t in (part.split() for part in schema.split(","))}

    def whole(parts: list[dict]) -> dict:
        return {c: np.concatenate([p[c] for p in parts]) for c in names}

    def run(a_rows: pa.Table, b_rows: pa.Table) -> pa.Table:
        searching = _blocks(a_rows)
        found = {b.cell: b for b in [*_blocks(b_rows), *(searching if own else [])]}
        targets = dict(zip(a_rows["cell"].to_pylist(), a_rows["targets"].to_pylist()))
        parts: list[dict] = []
        waiting = 0
        for a in searching:
            for out in kernel(a, [found[c] for c in targets[a.cell] if c in found]):
                parts.append(out)
                waiting += len(out[names[0]])
                if fold and waiting >= FOLD_ROWS:
                    parts, waiting = [fold(whole(parts))], 0
        out = whole(parts) if parts else {c: [] for c in names}
        if fold and parts:
            out = fold(out)
        give_back()
        return pa.table({c: pa.array(out[c], type=types[c]) for c in names})

    return meet(left, right, keys, run, schema)
