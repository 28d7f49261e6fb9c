"""Nearest neighbours, near-duplicates and local outlier factors, all exact."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.vectors import norm, paired_distances, rough_squares, unit
from labelloom.operators.cells import (
    CELL_ROWS, STEP_VALUES, Block, build_cells, join_cells, repack, split_leaders, with_targets,
)
from labelloom.scratch import cut

# Below the row-number limit that Spark applies before a shuffle.
LEADERS = 512
PLAIN_CHUNKS = 8
#: Rows of a cell that meet another cell at once.
MATCH_ROWS = 256


def first_copies(points: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` rows (by id) of every group of equal vectors, with their rank.

    The rank filter is applied before the shuffle, so a vector that fills a
    third of the table does not end up in one task.
    """
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    return points.withColumn("copy", rank).where(F.col("copy") <= keep)


def knn(points: DataFrame, k: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(id, nbr, distance, rank) of the k nearest other points; ties go to the smaller id.

    A copy ranked behind the first k+1 of its group cannot be anyone's
    neighbour, so only those are searched; the others get the first k copies.
    """
    core = cut(first_copies(points.select("id", "v"), k + 1), "knn_core")
    edges = _knn_core(core.select("id", "v"), k, cell_rows)
    if points.count() == core.count():
        return edges
    lists = core.where(F.col("copy") <= k).groupBy("v").agg(
        F.array_sort(F.collect_list("id")).alias("first_ids")
    )
    rest = points.select("id", "v").join(core.select("id"), "id", "left_anti")
    spare = rest.join(lists, "v").select("id", F.posexplode("first_ids").alias("ix", "nbr"))
    return edges.unionByName(
        spare.select("id", "nbr", F.lit(0.0).alias("distance"), (F.col("ix") + 1).alias("rank"))
    )


def _knn_core(points: DataFrame, k: int, cell_rows: int) -> DataFrame:
    cells = build_cells(points, cell_rows=cell_rows)
    layout = cells.layout

    def radius(cell, ids, x, extra):
        """Upper bound of the k-th neighbour distance, from the own cell and from ring sizes."""
        d = np.sqrt(((x * x).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * x @ x.T).clip(0))
        bound = np.full(len(x), np.inf)
        if len(x) > k:
            bound = np.partition(d, k, axis=1)[:, k]
        step = max(1, STEP_VALUES // max(1, len(layout.rows)))
        for start in range(0, len(x), step):
            part = x[start : start + step]
            pivot_d = np.sqrt(
                ((part * part).sum(1)[:, None] + (layout.pivots**2).sum(1)[None, :] - 2 * part @ layout.pivots.T).clip(0)
            )
            worst = pivot_d[:, layout.ring_pivot] + layout.high
            order = np.argsort(worst, axis=1)
            filled = np.cumsum(layout.rows[order], axis=1) >= k + 1
            at = filled.argmax(1)
            by_ring = worst[np.arange(len(part)), order[np.arange(len(part)), at]]
            bound[start : start + step] = np.fmin(bound[start : start + step], np.where(filled[:, -1], by_ring, np.inf))
        return bound + 1e-6

    sources = with_targets(cells, radius, symmetric=False)

    def nearest(a: Block, bs: list[Block]):
        """The k best of all rows of bs; the k-th distance found so far bounds the search of the next cell."""
        n = len(a.ids)
        a2 = (a.v * a.v).sum(1)
        reach = a.radius.copy()
        row, nbr, dist = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for b in bs:
            d2, room = rough_squares(a.v, b.v)
            if a.cell == b.cell:
                d2[a.ids[:, None] == b.ids[None, :]] = np.inf
            # Every column as near as the k-th one, with room for rounding: ties are decided below, by exact distance and id.
            limit = (reach**2 - a2 + room).astype(d2.dtype)
            near = d2 <= limit[:, None]
            if np.count_nonzero(near) > 4 * k * n and len(b.ids) > k:
                limit = np.minimum(limit, np.partition(d2, k - 1, axis=1)[:, k - 1] + d2.dtype.type(2 * room))
                near = d2 <= limit[:, None]
            near &= d2 < np.inf
            new, col = np.divmod(np.flatnonzero(near.ravel()), len(b.ids))
            if not len(new):
                continue
            gap = paired_distances(a.v, b.v, new, col)
            row, nbr, dist = np.concatenate([row, new]), np.concatenate([nbr, b.ids[col]]), np.concatenate([dist, gap])
            order = np.lexsort((nbr, dist, row))
            row, nbr, dist = row[order], nbr[order], dist[order]
            place = np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row]
            ok = (place < k) & (dist <= a.radius[row])
            last = ok & (place == k - 1)
            reach[row[last]] = np.minimum(reach[row[last]], dist[last])
            row, nbr, dist = row[ok], nbr[ok], dist[ok]
        yield {"id": a.ids[row], "nbr": nbr, "distance": dist}

    found = join_cells(cells, sources, nearest, "id bigint, nbr bigint, distance double", own=True)
    rank = F.row_number().over(Window.partitionBy("id").orderBy("distance", "nbr"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def core_distance(points: DataFrame, min_samples: int, edges: DataFrame | None = None) -> DataFrame:
    """Distance to the ``min_samples``-th nearest point, the point itself being the first."""
    if min_samples <= 1:
        return points.select("id", F.lit(0.0).alias("core"))
    edges = knn(points, min_samples - 1) if edges is None else edges
    reached = edges.where(F.col("rank") <= min_samples - 1).groupBy("id").agg(
        F.max("distance").alias("core")
    )
    return reached


def mutual_reachability(edges: DataFrame, cores: DataFrame) -> DataFrame:
    """Largest of both core distances and the distance, per neighbour edge."""
    return (
        edges.join(cores, "id")
        .join(cores.select(F.col("id").alias("nbr"), F.col("core").alias("nbr_core")), "nbr")
        .select("id", "nbr", "distance", F.greatest("distance", "core", "nbr_core").alias("reach"))
    )


def lof(points: DataFrame, k: int = 20, edges: DataFrame | None = None) -> DataFrame:
    """(id, lof): mean local density of the k neighbours over the own one.

    Rows ranked behind the first k+2 copies of a vector share the value of the
    (k+2)-th, so a hot group of copies adds no joins on its own key.
    """
    n = points.count()
    k = min(k, n - 1)
    if k < 1:
        return points.select("id", F.lit(1.0).alias("lof"))
    core = cut(first_copies(points.select("id", "v"), k + 2), "lof_core")
    n_core = core.count()
    edges = cut(knn(core.select("id", "v"), k) if edges is None else edges, "lof_edges")
    kdist = edges.groupBy("id").agg(F.max("distance").alias("kdist"))
    lrd = cut(
        edges.join(kdist.select(F.col("id").alias("nbr"), F.col("kdist").alias("nbr_kdist")), "nbr")
        .groupBy("id")
        .agg((F.lit(1.0) / (F.avg(F.greatest("distance", "nbr_kdist")) + F.lit(1e-10))).alias("lrd")),
        "lrd",
    )
    scored = (
        edges.join(lrd.select(F.col("id").alias("nbr"), F.col("lrd").alias("nbr_lrd")), "nbr")
        .groupBy("id")
        .agg(F.avg("nbr_lrd").alias("near"))
        .join(lrd, "id")
        .select("id", (F.col("near") / F.col("lrd")).alias("lof"))
    )
    if n_core == n:
        return scored
    last = core.where(F.col("copy") == k + 2).join(scored, "id").select("v", "lof")
    rest = points.select("id", "v").join(core.select("id"), "id", "left_anti")
    return scored.unionByName(rest.join(last, "v").select("id", "lof"))


def _alike(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, hit): the rows of x with a product of at least ``threshold`` with a row of y, and with which.

    For unit vectors: single precision decides all but the products close to the threshold, which are taken exactly.
    """
    room = 4 * (x.shape[1] + 8) * float(np.finfo(np.float32).eps)
    rough = x.astype(np.float32) @ y.astype(np.float32).T
    rows = np.flatnonzero((rough >= threshold - room).any(1))
    rough = rough[rows]
    hit = rough >= threshold + room
    row, col = np.divmod(np.flatnonzero(((rough >= threshold - room) & ~hit).ravel()), len(y))
    for at in range(0, len(row), 4096):
        r, c = row[at : at + 4096], col[at : at + 4096]
        hit[r, c] = np.einsum("ij,ij->i", x[rows[r]], y[c]) >= threshold
    return rows, hit


def _match_kernel(threshold: float, symmetric: bool):
    """Smallest earlier id at or above the threshold, for the rows of a (and of b); and the least of each row's."""
    none = np.iinfo(np.int64).max

    def match(a: Block, bs: list[Block]):
        for b in bs:
            for start in range(0, len(a.ids), MATCH_ROWS):
                rows, hit = _alike(a.v[start : start + MATCH_ROWS], b.v, threshold)
                if not len(rows):
                    continue
                ids = a.ids[start + rows]
                first = np.where(hit & (b.ids[None, :] < ids[:, None]), b.ids[None, :], none).min(1)
                ok = first < none
                yield {"id": ids[ok], "first_id": first[ok]}
                if symmetric and a.cell != b.cell:
                    first = np.where(hit & (ids[:, None] < b.ids[None, :]), ids[:, None], none).min(0)
                    ok = first < none
                    yield {"id": b.ids[ok], "first_id": first[ok]}

    def least(rows: dict) -> dict:
        order = np.lexsort((rows["first_id"], rows["id"]))
        ids = rows["id"][order]
        keep = np.r_[True, ids[1:] != ids[:-1]] if len(ids) else np.zeros(0, bool)
        return {"id": ids[keep], "first_id": rows["first_id"][order][keep]}

    return match, least


def _matches_between(distinct: DataFrame, threshold: float, cell_rows: int) -> DataFrame:
    """(id, first_id) among distinct unit vectors.

    When a ring fills more than ``PLAIN_CHUNKS`` cells its members may all be
    alike, and all of its chunks would meet each other.  Then every row first
    meets the ``LEADERS`` earliest rows of each pivot.  The others of a pivot
    have larger ids than its leaders, so a row that matched a leader needs none
    of them: the second pass takes a ring's other rows only for rows whose best
    match so far is later than the earliest of them.  Nothing is left out.
    """
    cells = build_cells(distinct, cell_rows=cell_rows)
    limit = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    schema = "id bigint, first_id bigint"
    if cells.layout.chunks.max() <= PLAIN_CHUNKS:
        sources = with_targets(cells, lambda cell, ids, x, extra: np.full(len(x), limit), symmetric=True)
        kernel, least = _match_kernel(threshold, True)
        found = join_cells(cells, sources, kernel, schema, least, own=True)
        return found.groupBy("id").agg(F.min("first_id").alias("first_id"))
    kernel, least = _match_kernel(threshold, False)
    leaders, rest = split_leaders(cells, LEADERS)
    to_leaders = with_targets(
        cells, lambda cell, ids, x, extra: np.full(len(x), limit), symmetric=False, targets=leaders.layout
    )
    first = cut(
        join_cells(leaders, to_leaders, kernel, schema, least)
        .groupBy("id").agg(F.min("first_id").alias("first_id")),
        "leader_matches",
    )
    none = np.iinfo(np.int64).max
    known = cut(
        distinct.join(first, "id", "left").select("id", "v", F.coalesce("first_id", F.lit(none)).alias("best")), "bounded"
    )
    queries = repack(known, cells, "best", cell_rows)
    earliest = rest.layout.first_id

    def radius(cell, ids, x, extra):
        best = extra.view(np.int64)
        later = np.minimum(best, ids)[:, None] > earliest[None, :]
        return np.where(later, limit, -np.inf)

    to_rest = with_targets(queries, radius, symmetric=False, targets=rest.layout, by_ring=True)
    more = join_cells(rest, to_rest, kernel, schema, least)
    return first.unionByName(more).groupBy("id").agg(F.min("first_id").alias("first_id"))


def earliest_matches(points: DataFrame, threshold: float, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(id, first_id): every point with an earlier point at cosine >= threshold, and the earliest.

    Equal vectors are collapsed first; their copies match the first of them.
    Zero vectors match nothing.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    usable = cut(points.where(norm(F.col("v")) > 0).select("id", unit(F.col("v")).alias("v")), "units")
    distinct = cut(usable.groupBy("v").agg(F.min("id").alias("id")), "distinct")
    if distinct.isEmpty():
        return points.select("id", F.col("id").alias("first_id")).where("false")
    between = cut(_matches_between(distinct, threshold, cell_rows), "matches")
    if usable.count() == distinct.count():
        return between
    firsts = distinct.join(between, "id", "left").select(
        "v", F.col("id").alias("rep"), F.coalesce("first_id", "id").alias("first_id")
    )
    copies = usable.join(distinct.select("id"), "id", "left_anti")
    return between.unionByName(copies.join(firsts, "v").select("id", "first_id"))


def near_duplicate_flags(points: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(id, duplicate_flag): true when an earlier point has cosine >= threshold."""
    matched = earliest_matches(points, threshold).select("id", F.lit(True).alias("matched"))
    return points.select("id").join(matched, "id", "left").select(
        "id", F.coalesce("matched", F.lit(False)).alias("duplicate_flag")
    )
