"""Search for the fusion weights whose fused space has the best silhouette."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions.vectors import unit
from labelloom.operators.pairs import block_pairs, pairwise
from labelloom.operators.represent import simplex_grid
from labelloom.operators.silhouette import STEP_ROWS, marked, score_totals
from labelloom.scratch import cut, settle


def weight_silhouettes(df: DataFrame, parts: list[str], steps: int = 5) -> DataFrame:
    """(cand, w0, w1, ..., silhouette) for every weight vector of the simplex grid.

    One pass over pairs of blocks computes a Gram matrix per part; the distance of
    every fused space follows from those, so no fused vector is built.
    """
    grid = simplex_grid(len(parts), steps)
    session = df.sparkSession
    real = df.where("cluster_id >= 0")
    widths = [r for r in real.select(*[F.size(p) for p in parts]).first()]
    points = cut(
        real.select(
            F.lit(0).cast("bigint").alias("grp"), F.col("id").cast("bigint").alias("id"),
            F.concat(*[unit(F.col(p)) for p in parts]).alias("v"),
            F.col("cluster_id").cast("bigint").alias("cluster"),
        ),
        "fusion_points",
    )
    cuts = np.cumsum([0, *widths])

    def shares(x: np.ndarray) -> list[np.ndarray]:
        return [(x[:, low:high] != 0).any(1).astype(np.float64) for low, high in zip(cuts[:-1], cuts[1:])]

    def lengths(weights: list[float], has: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """1 / length of the weighted parts of each row, 0 for a row without any, and its own square."""
        length = np.sqrt(sum(w * w * h for w, h in zip(weights, has)))
        return np.where(length == 0, 0.0, 1 / np.where(length == 0, 1, length)), (length > 0).astype(np.float64)

    def sums(grp: int, left: list[dict], right: list[dict]):
        sides = [left] if right is left else [left, right]
        found = [np.unique(np.concatenate([b["cluster"] for b in side])) for side in sides]
        marks = [[marked(np.searchsorted(found[i], b["cluster"]), np.ones(len(b["id"]))) for b in side] for i, side in enumerate(sides)]
        has = [[shares(b["v"]) for b in side] for side in sides]
        scales = [[[lengths(weights, h) for weights in grid] for h in one] for one in has]
        totals = [[np.zeros((len(grid), len(b["id"]), len(found[-1 - i]))) for b in side] for i, side in enumerate(sides)]
        for i, j in block_pairs(left, right):
            a, b, own_block = left[i], right[j], right is left and i == j
            (a_codes, a_marks), (b_codes, b_marks) = marks[0][i], marks[-1][j]
            turned = [np.ascontiguousarray(b["v"][:, low:high].T) for low, high in zip(cuts[:-1], cuts[1:])]
            whole = all(h.all() for h in has[0][i] + has[-1][j])
            back = np.zeros((len(grid), len(b["id"]), len(a_codes)))
            # Few rows at a time, so that their products stay in a core's cache.
            for at in range(0, len(a["id"]), STEP_ROWS):
                rows = slice(at, at + STEP_ROWS)
                grams = [a["v"][rows, low:high] @ t for low, high, t in zip(cuts[:-1], cuts[1:], turned)]
                same = a["id"][rows, None] == b["id"][None, :] if own_block else None
                d2, part = np.empty_like(grams[0]), np.empty_like(grams[0])
                if whole:
                    # Every part has length one: the parts' squared distances, halved, only need mixing.
                    for g in grams:
                        np.maximum(np.subtract(1.0, g, out=g), 0.0, out=g)
                        if same is not None:
                            g[same] = 0.0
                for cand, weights in enumerate(grid):
                    used = [(w * w, g) for w, g in zip(weights, grams) if w]
                    if whole and used:
                        (first, g), *more = used
                        np.multiply(g, 2 * first / sum(s for s, _ in used), out=d2)
                        for s, g in more:
                            d2 += np.multiply(g, 2 * s / sum(s for s, _ in used), out=part)
                    else:
                        (by_a, a_one), (by_b, b_one) = (x[rows] for x in scales[0][i][cand]), scales[-1][j][cand]
                        d2[...] = 0.0
                        for s, g in used:
                            d2 += np.multiply(g, s, out=part)
                        d2 *= -2 * by_a[:, None]
                        d2 *= by_b[None, :]
                        d2 += a_one[:, None]
                        d2 += b_one[None, :]
                        np.maximum(d2, 0.0, out=d2)
                        if same is not None:
                            d2[same] = 0.0
                    d = np.sqrt(d2, out=d2)
                    totals[0][i][cand][rows, b_codes] += d @ b_marks
                    if not own_block:
                        back[cand] += d.T @ a_marks[rows]
            totals[-1][j][:, :, a_codes] += back
        for i, side in enumerate(sides):
            others = found[-1 - i]
            m = len(others)
            for block, total in zip(side, totals[i]):
                n = len(block["id"])
                for cand in range(len(grid)):
                    yield {
                        "grp": np.zeros(n * m, dtype=np.int64),
                        "cand": np.full(n * m, cand, dtype=np.int32),
                        "id": np.repeat(block["id"], m),
                        "weight": np.ones(n * m),
                        "own": np.repeat(block["cluster"], m),
                        "cluster": np.tile(others, n),
                        "total": total[cand].ravel(),
                    }

    sizes = settle(
        points.select("grp", "cluster", F.explode(F.sequence(F.lit(0), F.lit(len(grid) - 1))).alias("cand"))
        .groupBy("grp", "cand", "cluster")
        .agg(F.count(F.lit(1)).cast("double").alias("size")),
        "fusion_sizes",
    )
    total = (
        pairwise(
            points, ["cluster"], sums,
            "grp bigint, cand int, id bigint, weight double, own bigint, cluster bigint, total double",
            out_rows=max(1, sizes.count()), both=True,
        )
        .groupBy("grp", "cand", "id", "weight", "own", "cluster")
        .agg(F.sum("total").alias("total"))
    )
    means = score_totals(total, sizes).groupBy("cand").agg(
        F.coalesce(F.avg("s"), F.lit(0.0)).alias("silhouette")
    )
    names = ", ".join(f"w{i} double" for i in range(len(parts)))
    weights = session.createDataFrame([(i, *w) for i, w in enumerate(grid)], f"cand int, {names}")
    return weights.join(means, "cand")


def best_weights(df: DataFrame, parts: list[str], steps: int = 5) -> list[float]:
    """Weights with the highest silhouette, the first of equals; uniform below two clusters."""
    n = len(parts)
    if n < 2:
        return [1.0]
    if df.where("cluster_id >= 0").select("cluster_id").distinct().limit(2).count() < 2:
        return [1.0 / n] * n
    row = weight_silhouettes(df, parts, steps).orderBy(F.desc("silhouette"), "cand").first()
    return [row[f"w{i}"] for i in range(n)]
