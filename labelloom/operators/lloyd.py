"""Grouped k-means: many groups, values of k and restarts in the same passes.

Each iteration is one pass over the points in which every task adds up its own
sums, followed by a small aggregation.  The state is the table of centres; its
size is checked and models are run in batches when it would exceed
``MAX_CENTRE_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.vectors import list_column, matrix, squared_distances
from labelloom.scratch import cut

MAX_CENTRE_BYTES = 64 << 20
RELATIVE_TOLERANCE = 1e-4
#: Rows whose distances from all centres are held at once.
STEP_ROWS = 256
#: Rounds of oversampling, and rows drawn in a round for each start that is wanted.
DRAW_ROUNDS, DRAWN = 4, 2


@dataclass
class Model:
    """k centres of one group."""

    grp: int
    k: int
    restart: int
    centres: np.ndarray
    inertia: float = np.inf
    done: bool = False
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0))


def uniform(ids: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the id, seed and step only (64-bit mixing)."""
    mask = (1 << 64) - 1
    offset = np.uint64((seed * 0x9E3779B97F4A7C15 + step * 0xBF58476D1CE4E5B9) & mask)
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64) + offset
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _by_group(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    grp = batch["grp"].to_numpy(zero_copy_only=False)
    for g in np.unique(grp):
        yield int(g), np.flatnonzero(grp == g)


def first_starts(points: DataFrame, k: int) -> dict[int, np.ndarray]:
    """The k distinct vectors with the lowest ids, per group.

    The lowest few ids usually hold enough distinct vectors; only groups that
    begin with many copies need the distinct vectors of the whole group.
    """
    if k == 1:
        firsts = points.groupBy("grp").agg(F.min_by("v", "id").alias("v")).collect()
        return {r.grp: np.array([r.v]) for r in firsts}
    head = min(8 * k, 1000)
    rank = F.row_number().over(Window.partitionBy("grp").orderBy("id"))
    starts = _distinct_in_order(
        points.select("grp", "id", "v").withColumn("rank", rank).where(F.col("rank") <= head).collect(), k
    )
    short = [g for g, vs in starts.items() if len(vs) < k]
    if short:
        distinct = points.where(F.col("grp").isin(short)).groupBy("grp", "v").agg(F.min("id").alias("id"))
        rows = distinct.withColumn("rank", rank).where(F.col("rank") <= k).collect()
        starts.update(_distinct_in_order(rows, k))
    return {g: np.array(vs) for g, vs in starts.items()}


def _distinct_in_order(rows: list, k: int) -> dict[int, list]:
    found: dict[int, dict] = {}
    for r in sorted(rows, key=lambda r: (r.grp, r.id)):
        vectors = found.setdefault(r.grp, {})
        if len(vectors) < k:
            vectors.setdefault(tuple(r.v), None)
    return {g: [list(v) for v in vectors] for g, vectors in found.items()}


def farthest_starts(points: DataFrame, k: int) -> dict[tuple[int, int], np.ndarray]:
    """k starts per (group, 0): the lowest id, then always the row farthest from those chosen, in one pass each."""
    chosen = {(g, 0): vs for g, vs in first_starts(points, 1).items()}
    finished: set[tuple[int, int]] = set()
    while table := {q: vs for q, vs in chosen.items() if len(vs) < k and q not in finished}:
        found = _next_candidates(points, table, 1, None, 0)
        for key, old in table.items():
            if key in found and found[key][0][0] >= 1e-12:
                chosen[key] = np.vstack([old, found[key][0][2][None, :]])
            else:
                finished.add(key)
    return chosen


def parallel_starts(points: DataFrame, k: int, restarts: int, seed: int = 42) -> dict[tuple[int, int], np.ndarray]:
    """k starts per (group, restart) by oversampling, every restart on its own.

    The first row of a restart is drawn by a seeded hash of the ids. Each round then draws ``DRAWN`` * k further rows, with
    probability proportional to the squared distance from all rows drawn before, by a race of hashed exponentials,
    so the draw does not depend on the partitioning. One more pass counts the rows next to each drawn one, and
    k-means++ on the drawn rows with these weights gives the starts. A shorter sequence of starts is its beginning.
    """
    groups = sorted(first_starts(points, 1).items())
    width = len(groups[0][1][0]) if groups else 0
    room = max(1, MAX_CENTRE_BYTES // (8 * max(1, width) * (1 + DRAW_ROUNDS * DRAWN * k)))
    keys = [(g, r) for g, _ in groups for r in range(restarts)]
    starts: dict[tuple[int, int], np.ndarray] = {}
    for at in range(0, len(keys), room):
        drawn: dict[tuple[int, int], np.ndarray] = {key: np.zeros((0, width)) for key in keys[at : at + room]}
        for step in range(DRAW_ROUNDS + 1):
            found = _next_candidates(points, drawn, DRAWN * k if step else 1, seed, step)
            for key, rows in found.items():
                drawn[key] = np.vstack([drawn[key], *[v[None, :] for _, _, v in rows]])
        drawn = {key: np.unique(vs, axis=0) for key, vs in drawn.items()}
        for key, weight in _near_rows(points, drawn).items():
            starts[key] = _weighted_starts(drawn[key], weight, k, seed + key[1])
    return starts


def _near_rows(points: DataFrame, drawn: dict[tuple[int, int], np.ndarray]) -> dict[tuple[int, int], np.ndarray]:
    """How many rows of its group lie nearest to each drawn one."""
    by_group: dict[int, list[int]] = {}
    for g, r in drawn:
        by_group.setdefault(g, []).append(r)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {key: np.zeros(len(vs), dtype=np.int64) for key, vs in drawn.items()}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x_all = matrix(batch["v"])
            for g, rows in _by_group(batch):
                for r in by_group.get(g, []):
                    sums[g, r] += np.bincount(squared_distances(x_all[rows], drawn[g, r]).argmin(1), minlength=len(drawn[g, r]))
        flat = [(g, r, int(i), int(n[i])) for (g, r), n in sums.items() for i in np.flatnonzero(n)]
        if flat:
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat), types)], ["grp", "restart", "at", "n"])

    found = points.select("grp", "v").mapInArrow(count, "grp bigint, restart int, at int, n bigint")
    out = {key: np.zeros(len(vs)) for key, vs in drawn.items()}
    for r in found.groupBy("grp", "restart", "at").agg(F.sum("n").alias("n")).collect():
        out[r.grp, r.restart][r.at] = r.n
    return out


def _weighted_starts(x: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Up to k distinct rows of x by k-means++ with weights; of several draws the one that leaves the least cost is taken."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(x), p=weight / weight.sum()))]
    gap = squared_distances(x, x[chosen]).min(1)
    gap[gap < 1e-12] = 0.0
    while len(chosen) < k and (cost := float((gap * weight).sum())) > 0:
        draws = np.unique(rng.choice(len(x), size=2 + int(np.log(k)), p=gap * weight / cost))
        left = np.minimum(gap[None, :], squared_distances(x[draws], x))
        best = int((left @ weight).argmin())
        chosen.append(int(draws[best]))
        gap = left[best]
        gap[gap < 1e-12] = 0.0
        gap[chosen] = 0.0
    return x[chosen]


STARTS = {
    "parallel": parallel_starts,
    "farthest": lambda points, k, restarts, seed: farthest_starts(points, k),
}


def spread_starts(points: DataFrame, k: int, restarts: int, seed: int = 42, starts: str = "parallel") -> dict[tuple[int, int], np.ndarray]:
    """Sequences of at most k distinct starts per (group, restart); ``farthest`` gives a single, fixed one."""
    return STARTS[starts](points, k, restarts, seed)


def _next_candidates(
    points: DataFrame, table: dict[tuple[int, int], np.ndarray], keep: int, seed: int | None, step: int
) -> dict[tuple[int, int], list[tuple[float, int, np.ndarray]]]:
    """The ``keep`` best scored points per (group, restart): (score, -id, vector).

    Without a seed the score is the squared distance from the rows of ``table``, else a race of exponentials with that
    rate; with no rows to measure from all rates are one.
    """
    by_group: dict[int, list[int]] = {}
    for g, r in table:
        by_group.setdefault(g, []).append(r)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x_all = matrix(batch["v"])
            id_all = batch["id"].to_numpy(zero_copy_only=False)
            for g, rows in _by_group(batch):
                x, ids = x_all[rows], id_all[rows]
                for r in by_group.get(g, []):
                    d2 = squared_distances(x, table[g, r]).min(1) if len(table[g, r]) else np.ones(len(x))
                    # Round-off of a repeated point must not win a draw.
                    d2[d2 < 1e-12] = 0.0
                    score = d2 if seed is None else d2 / -np.log(uniform(ids, seed + r, step))
                    top = np.lexsort((ids, -score))[:keep]
                    entries = [(float(score[i]), -int(ids[i]), x[i]) for i in top if score[i] > 0]
                    merged = best.get((g, r), []) + entries
                    best[g, r] = sorted(merged, key=lambda e: e[:2], reverse=True)[:keep]
        flat = [(g, r, *e) for (g, r), es in best.items() for e in es]
        if flat:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([e[0] for e in flat], type=pa.int64()),
                    pa.array([e[1] for e in flat], type=pa.int32()),
                    pa.array([e[2] for e in flat], type=pa.float64()),
                    pa.array([e[3] for e in flat], type=pa.int64()),
                    list_column(np.array([e[4] for e in flat])),
                ],
                ["grp", "restart", "score", "order", "v"],
            )

    rank = F.row_number().over(
        Window.partitionBy("grp", "restart").orderBy(F.desc("score"), F.desc("order"))
    )
    rows = (
        points.select("grp", "id", "v")
        .mapInArrow(candidates, "grp bigint, restart int, score double, `order` bigint, v array<double>")
        .withColumn("rank", rank)
        .where(F.col("rank") <= keep)
        .collect()
    )
    found: dict[tuple[int, int], list] = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        found.setdefault((r.grp, r.restart), []).append((r.score, r.order, np.array(r.v)))
    return found


def _batches_of(models: list[Model]) -> Iterator[list[Model]]:
    group: list[Model] = []
    used = 0
    for m in models:
        if group and used + m.centres.nbytes > MAX_CENTRE_BYTES:
            yield group
            group, used = [], 0
        group.append(m)
        used += m.centres.nbytes
    if group:
        yield group


def _stack(models: list[Model]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per group: stacked centres, the model of each centre, and first slots."""
    out: dict[int, list] = {}
    for index, m in enumerate(models):
        out.setdefault(m.grp, []).append((index, m.centres))
    return {
        g: (
            np.vstack([c for _, c in parts]),
            np.array([i for i, _ in parts]),
            np.cumsum([0] + [len(c) for _, c in parts]),
        )
        for g, parts in out.items()
    }


def _slots_by_k(centres: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(slots, -2 centres, their squares) of the models with equally many centres; slots have one row per model."""
    sizes = np.diff(starts)
    found = [starts[:-1][sizes == k][:, None] + np.arange(k) for k in np.unique(sizes)]
    return [(slots, -2.0 * centres[slots.ravel()], (centres[slots.ravel()] ** 2).sum(1)[:, None]) for slots in found]


def _add_sums(x: np.ndarray, by_k: list[tuple], sums: np.ndarray, counts: np.ndarray, cost: np.ndarray) -> None:
    """Add rows to the sums, counts and costs of their nearest centres, for all models of a group; few rows, so that they stay in a core's cache."""
    squares = (x * x).sum(1)
    for slots, turned, lengths in by_k:
        flat = slots.ravel()
        # Squared distances without the rows' own squares, which do not change their order.
        d2 = turned @ x.T
        d2 += lengths
        d2 = d2.reshape(*slots.shape, len(x))
        least = d2.min(1)
        marks = d2 == least[:, None, :]
        if np.count_nonzero(marks) != least.size:
            # Of equally near centres the first one.
            marks = np.arange(slots.shape[1])[None, :, None] == d2.argmin(1)[:, None, :]
        marks = marks.astype(np.float64)
        sums[flat] += marks.reshape(len(flat), -1) @ x
        counts[flat] += marks.sum(2).ravel()
        cost[flat] += (marks @ np.maximum(least + squares, 0.0)[:, :, None]).ravel()


def _iterate(points: DataFrame, models: list[Model], tol: float | None, tasks: int) -> None:
    table = _stack(models)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {g: np.zeros_like(c) for g, (c, _, _) in table.items()}
        counts = {g: np.zeros(len(c)) for g, (c, _, _) in table.items()}
        cost = {g: np.zeros(len(c)) for g, (c, _, _) in table.items()}
        by_k: dict[int, list[tuple]] = {}
        seen = set()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x_all = matrix(batch["v"])
            for g, rows in _by_group(batch):
                if g not in table:
                    continue
                seen.add(g)
                if g not in by_k:
                    centres, _, starts = table[g]
                    by_k[g] = _slots_by_k(centres, starts)
                for first in range(0, len(rows), STEP_ROWS):
                    _add_sums(x_all[rows[first : first + STEP_ROWS]], by_k[g], sums[g], counts[g], cost[g])
        for g in seen:
            used = np.flatnonzero(counts[g])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), g, dtype=np.int64)),
                    pa.array(used.astype(np.int32)),
                    list_column(sums[g][used]),
                    pa.array(counts[g][used]),
                    pa.array(cost[g][used]),
                ],
                ["grp", "slot", "total", "n", "cost"],
            )

    partials = points.select("grp", "v").mapInArrow(
        partial, "grp bigint, slot int, total array<double>, n double, cost double"
    )
    if tasks * sum(m.centres.nbytes for m in models) <= MAX_CENTRE_BYTES:
        # Few tasks: their partial sums are small enough to be added here.
        added: dict[tuple[int, int], list] = {}
        for r in partials.collect():
            entry = added.setdefault((r.grp, r.slot), [0.0, 0.0, 0.0])
            entry[0] = entry[0] + np.array(r.total)
            entry[1] += r.n
            entry[2] += r.cost
        reduced = [(g, slot, *entry) for (g, slot), entry in added.items()]
    else:
        reduced = (
            partials.groupBy("grp", "slot")
            .agg(
                vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"),
                F.sum("n").alias("n"),
                F.sum("cost").alias("cost"),
            )
            .collect()
        )
    fresh = {g: c.copy() for g, (c, _, _) in table.items()}
    costs = {g: np.zeros(len(c)) for g, (c, _, _) in table.items()}
    sizes = {g: np.zeros(len(c)) for g, (c, _, _) in table.items()}
    for grp, slot, total, n, cost_ in reduced:
        fresh[grp][slot] = np.array(total) / n
        costs[grp][slot] = cost_
        sizes[grp][slot] = n
    for g, (centres, owners, starts) in table.items():
        for at, index in enumerate(owners):
            a, b = starts[at], starts[at + 1]
            model = models[index]
            shift = float(((fresh[g][a:b] - centres[a:b]) ** 2).sum())
            model.inertia = float(costs[g][a:b].sum())
            model.counts = sizes[g][a:b]
            model.centres = fresh[g][a:b]
            spread = model.inertia / max(model.counts.sum() * model.centres.shape[1], 1.0)
            model.done = shift <= (RELATIVE_TOLERANCE * spread if tol is None else tol)


def lloyd(
    points: DataFrame, models: list[Model], iterations: int = 300, tol: float | None = None
) -> list[Model]:
    """Move the centres of all models until they rest or ``iterations`` have passed.

    A model rests when the squared shift of its centres is at most ``tol``, by
    default a small share of the mean squared deviation per dimension.
    """
    tasks = points.rdd.getNumPartitions()
    for batch in _batches_of(models):
        for _ in range(iterations):
            active = [m for m in batch if not m.done]
            if not active:
                break
            _iterate(points, active, tol, tasks)
    return models


def assign(points: DataFrame, models: list[Model], column: str = "labs") -> DataFrame:
    """Add an array column: for each model of the row's group, in order, the nearest centre."""
    table = _stack(models)
    schema = T.StructType(points.schema.fields + [T.StructField(column, T.ArrayType(T.IntegerType()))])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x_all = matrix(batch["v"])
            found: list = [None] * batch.num_rows
            for g, rows in _by_group(batch):
                if g not in table:
                    continue
                centres, _, starts = table[g]
                d2 = squared_distances(x_all[rows], centres)
                near = np.stack(
                    [d2[:, a:b].argmin(1) for a, b in zip(starts[:-1], starts[1:])], axis=1
                ).astype(np.int32)
                for at, row in enumerate(rows):
                    found[row] = near[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, type=pa.list_(pa.int32()))],
                [*batch.schema.names, column],
            )

    return points.mapInArrow(label, schema)


def best_of_restarts(models: list[Model]) -> list[Model]:
    """Lowest inertia per (group, k); the earlier restart wins a tie."""
    best: dict[tuple[int, int], Model] = {}
    for m in models:
        key = (m.grp, m.k)
        if key not in best or m.inertia < best[key].inertia - 1e-12:
            best[key] = m
    return [best[k] for k in sorted(best)]


def kmeans_candidates(
    points: DataFrame, ks: list[int], restarts: int = 10, iterations: int = 300, seed: int = 42, starts: str = "parallel"
) -> tuple[DataFrame, list[Model]]:
    """Fit every k of ``ks`` in every group; returns points with ``labs`` and the models.

    A group with fewer distinct points than k has no model for that k.
    """
    found = spread_starts(points, max(ks), restarts, seed, starts)
    models = [
        Model(g, k, r, centres[:k].copy())
        for (g, r), centres in sorted(found.items())
        for k in ks
        if len(centres) >= k
    ]
    models = best_of_restarts(lloyd(points, models, iterations))
    return cut(assign(points, models), "kmeans"), models
