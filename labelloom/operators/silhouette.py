"""Silhouette: exact over packed blocks, and the linear squared-distance variant.

The exact value is defined over all pairs, so its work is quadratic in the
number of distinct points of a group.  Tiles of bounded size meet through an
equi-join and only distance *sums* per (point, cluster) leave a task.  Equal
points are collapsed to one weighted point first.  Callers choose between it and
the squared variant, one linear pass, by name (``KINDS``); no row count does.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions.vectors import list_column, matrix
from labelloom.operators.pairs import BLOCK_ROWS, block_pairs, pairwise
from labelloom.scratch import cut, settle

KINDS = ("exact", "squared")
#: Rows of a block whose distances from another block are held at once.
STEP_ROWS = 128


def require_kind(kind: str) -> None:
    if kind not in KINDS:
        raise ValueError(f"unknown silhouette: {kind}")


def marked(code: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, marks): the codes that occur, and per column of distances its weight under each of its codes.

    A column may have several codes, a row of ``code``, no two equal; one product of distances and marks then serves all.
    """
    present, place = np.unique(code, return_inverse=True)
    marks = np.zeros((len(code), len(present)))
    marks[np.arange(len(code))[:, None], place.reshape(len(code), -1)] = np.reshape(weight, (-1, 1))
    return present, marks


def silhouette_rows(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Silhouette of every distinct point under each of several labellings.

    ``points``: grp BIGINT, id BIGINT, v ARRAY<DOUBLE>, labs ARRAY<INT>.  Pairs
    are only formed inside a group.  A point with a negative label plays no part
    under that labelling.  Returns grp, cand (index into labs), id (first of the
    equal points), cluster, weight, s; points of a lone cluster give NULL.
    """
    distinct = cut(
        points.groupBy("grp", "v", "labs").agg(
            F.min("id").alias("id"), F.count(F.lit(1)).cast("double").alias("weight")
        ),
        "silhouette_points",
    )
    sizes = settle(
        distinct.select("grp", "weight", F.posexplode("labs").alias("cand", "cluster"))
        .where("cluster >= 0")
        .groupBy("grp", "cand", "cluster")
        .agg(F.sum("weight").alias("size")),
        "silhouette_sizes",
    )

    def sums(grp: int, left: list[dict], right: list[dict]):
        cands = left[0]["labs"].shape[1]
        sides = [left] if right is left else [left, right]
        # Labels of a tile's blocks, the columns where each candidate's begin, and per block the marks of its rows.
        found = [[np.unique(np.concatenate([b["labs"][:, cand] for b in side])) for cand in range(cands)] for side in sides]
        ends = [np.cumsum([0] + [len(f) for f in one]) for one in found]
        marks = [
            [marked(np.stack([start + np.searchsorted(f, b["labs"][:, c]) for c, (start, f) in enumerate(zip(ends[i], found[i]))], axis=1), b["weight"]) for b in side]
            for i, side in enumerate(sides)
        ]
        totals = [[np.zeros((len(b["id"]), ends[-1 - i][-1])) for b in side] for i, side in enumerate(sides)]
        for i, j in block_pairs(left, right):
            a, b, same = left[i], right[j], right is left and i == j
            (a_codes, a_marks), (b_codes, b_marks) = marks[0][i], marks[-1][j]
            turned, squares = -2.0 * b["v"].T, (b["v"] * b["v"]).sum(1)
            back = np.zeros((len(b["id"]), len(a_codes)))
            # Few rows at a time, so that their distances stay in a core's cache.
            for at in range(0, len(a["id"]), STEP_ROWS):
                rows = slice(at, at + STEP_ROWS)
                d = a["v"][rows] @ turned
                d += squares[None, :]
                d += (a["v"][rows] ** 2).sum(1)[:, None]
                np.sqrt(np.maximum(d, 0.0, out=d), out=d)
                if same:
                    d[a["id"][rows, None] == b["id"][None, :]] = 0.0
                else:
                    back += d.T @ a_marks[rows]
                totals[0][i][rows, b_codes] += d @ b_marks
            totals[-1][j][:, a_codes] += back
        for i, side in enumerate(sides):
            for block, total in zip(side, totals[i]):
                n = len(block["id"])
                for cand, (start, others) in enumerate(zip(ends[-1 - i], found[-1 - i])):
                    m = len(others)
                    yield {
                        "grp": np.full(n * m, grp, dtype=np.int64),
                        "cand": np.full(n * m, cand, dtype=np.int32),
                        "id": np.repeat(block["id"], m),
                        "weight": np.repeat(block["weight"], m),
                        "own": np.repeat(block["labs"][:, cand].astype(np.int64), m),
                        "cluster": np.tile(others.astype(np.int64), n),
                        "total": total[:, start : start + m].ravel(),
                    }

    widest = sizes.groupBy("grp").count().agg(F.max("count").alias("rows")).first().rows
    total = (
        pairwise(
            distinct, ["labs", "weight"], sums,
            "grp bigint, cand int, id bigint, weight double, own bigint, cluster bigint, total double",
            block_rows, widest or 1, True,
        )
        .where("own >= 0 and cluster >= 0")
        .groupBy("grp", "cand", "id", "weight", "own", "cluster")
        .agg(F.sum("total").alias("total"))
    )
    return score_totals(total, sizes)


def score_totals(total: DataFrame, sizes: DataFrame) -> DataFrame:
    """Silhouettes from distance sums per (point, cluster) and cluster sizes."""
    mine = F.col("own") == F.col("cluster")
    per_point = (
        total.join(sizes.withColumn("cluster", F.col("cluster").cast("bigint")), ["grp", "cand", "cluster"])
        .groupBy("grp", "cand", "id", "weight", "own")
        .agg(
            F.max(F.when(mine, F.col("size"))).alias("own_size"),
            F.max(F.when(mine, F.col("total") / F.greatest(F.col("size") - 1, F.lit(1.0)))).alias("a"),
            F.min(F.when(~mine, F.col("total") / F.col("size"))).alias("b"),
        )
    )
    s = (
        F.when(F.col("b").isNull(), F.lit(None).cast("double"))
        .when(F.col("own_size") <= 1, F.lit(0.0))
        .when(F.greatest("a", "b") == 0, F.lit(0.0))
        .otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    )
    return per_point.select("grp", "cand", "id", F.col("own").alias("cluster"), "weight", s.alias("s"))


def grouped_silhouette(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean silhouette per (grp, cand); 0 when a labelling has a single cluster."""
    rows = silhouette_rows(points, block_rows)
    return rows.groupBy("grp", "cand").agg(
        F.coalesce(F.sum(F.col("s") * F.col("weight")) / F.sum("weight"), F.lit(0.0)).alias("silhouette")
    )


def grouped_silhouette_squared(points: DataFrame) -> DataFrame:
    """``grouped_silhouette`` with squared distances: two linear passes.

    The mean squared distance of a point to a cluster follows from the
    cluster's size, sum and sum of squared norms, so no pair is formed.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, labs = matrix(batch["v"]), matrix(batch["labs"]).astype(np.int64)
            grp = batch["grp"].to_numpy(zero_copy_only=False)
            squares = (x * x).sum(1)
            for cand in range(labs.shape[1]):
                keys, code = np.unique(np.stack([grp, labs[:, cand]]), axis=1, return_inverse=True)
                code = code.ravel()
                marks = np.zeros((keys.shape[1], len(x)))
                marks[code, np.arange(len(x))] = 1.0
                added, counts = marks @ x, marks.sum(1)
                norms = marks @ squares
                for i, (g, c) in enumerate(keys.T):
                    entry = total.setdefault((int(g), cand, int(c)), [0.0, 0.0, 0.0])
                    entry[0] += counts[i]
                    entry[1] = entry[1] + added[i]
                    entry[2] += norms[i]
        if total:
            keys = list(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([k[2] for k in keys], pa.int64()), pa.array([float(total[k][0]) for k in keys]),
                    list_column(np.array([total[k][1] for k in keys])), pa.array([float(total[k][2]) for k in keys]),
                ],
                ["grp", "cand", "cluster", "n", "s", "q"],
            )

    # One row per cluster of a grouped k-means: bounded like its table of centres.
    rows = (
        points.select("grp", "v", "labs")
        .mapInArrow(sums, "grp bigint, cand int, cluster bigint, n double, s array<double>, q double")
        .groupBy("grp", "cand", "cluster")
        .agg(
            F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s"),
            F.sum("q").alias("q"),
        )
        .collect()
    )
    table: dict[tuple[int, int], list] = {}
    for r in sorted(rows, key=lambda r: (r.grp, r.cand, r.cluster)):
        table.setdefault((r.grp, r.cand), []).append(r)
    stats = {
        k: (
            np.array([r.cluster for r in rs]), np.array([r.n for r in rs]), np.array([r.s for r in rs]),
            np.array([r.q for r in rs]),
        )
        for k, rs in table.items()
    }

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x_all, labs = matrix(batch["v"]), matrix(batch["labs"]).astype(np.int64)
            grp = batch["grp"].to_numpy(zero_copy_only=False)
            out = []
            for g in np.unique(grp):
                at = np.flatnonzero(grp == g)
                x = x_all[at]
                for cand in range(labs.shape[1]):
                    ids, n, s, q = stats[int(g), cand]
                    if len(ids) < 2:
                        out.append((int(g), cand, 0.0, float(len(at))))
                        continue
                    own = np.searchsorted(ids, labs[at, cand])
                    total = n[None] * (x * x).sum(1)[:, None] - 2 * x @ s.T + q[None]
                    total = np.maximum(total, 0.0)
                    rows_ = np.arange(len(at))
                    a = total[rows_, own] / np.maximum(n[own] - 1, 1.0)
                    mean = total / n[None]
                    mean[rows_, own] = np.inf
                    b = mean.min(1)
                    top = np.maximum(a, b)
                    value = np.where((n[own] <= 1) | (top == 0), 0.0, (b - a) / np.where(top == 0, 1.0, top))
                    out.append((int(g), cand, float(value.sum()), float(len(at))))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2]),
                    pa.array(columns[3]),
                ],
                ["grp", "cand", "total", "n"],
            )

    return (
        points.select("grp", "v", "labs")
        .mapInArrow(score, "grp bigint, cand int, total double, n double")
        .groupBy("grp", "cand")
        .agg((F.sum("total") / F.sum("n")).alias("silhouette"))
    )


def split_silhouette(points: DataFrame, kind: str = "exact") -> DataFrame:
    """(grp, cand, silhouette, kind) of the given kind for every group, whatever its size."""
    require_kind(kind)
    scored = grouped_silhouette(points) if kind == "exact" else grouped_silhouette_squared(points)
    return scored.withColumn("kind", F.lit(kind))


def labelled(df: DataFrame, cluster: str = "cluster_id", v: str = "v", id_: str = "id") -> DataFrame:
    """Non-noise rows of a labelled table in the shape that ``silhouette_rows`` reads."""
    return df.where(F.col(cluster) >= 0).select(
        F.lit(0).cast("bigint").alias("grp"), F.col(id_).cast("bigint").alias("id"), F.col(v).alias("v"),
        F.array(F.col(cluster).cast("int")).alias("labs"),
    )


def silhouette(df: DataFrame, cluster: str = "cluster_id", v: str = "v") -> DataFrame:
    """One row: exact mean silhouette of the non-noise rows, 0 when it is undefined."""
    scored = grouped_silhouette(labelled(df, cluster, v))
    return scored.agg(F.coalesce(F.max("silhouette"), F.lit(0.0)).alias("silhouette"))


def silhouette_per_cluster(df: DataFrame, cluster: str = "cluster_id", v: str = "v") -> DataFrame:
    rows = silhouette_rows(labelled(df, cluster, v))
    return rows.groupBy(F.col("cluster").alias("cluster_id")).agg(
        F.sum("weight").cast("bigint").alias("n"),
        F.coalesce(F.sum(F.col("s") * F.col("weight")) / F.sum("weight"), F.lit(0.0)).alias("silhouette"),
    )


def silhouette_squared(df: DataFrame, cluster: str = "cluster_id", v: str = "v") -> float:
    """Silhouette with squared distances (another number than the exact one), one linear pass."""
    rows = df.where(F.col(cluster) >= 0).select(
        array_to_vector(F.col(v)).alias("features"), F.col(cluster).cast("double").alias("prediction")
    )
    if rows.select("prediction").distinct().limit(2).count() < 2:
        return 0.0
    return float(ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(rows))


def silhouette_value(df: DataFrame, cluster: str = "cluster_id", v: str = "v", kind: str = "exact") -> float:
    """Mean silhouette of the given kind."""
    require_kind(kind)
    if kind == "exact":
        return float(silhouette(df, cluster, v).first().silhouette)
    return silhouette_squared(df, cluster, v)


def silhouette_values(points: DataFrame, labellings: list[DataFrame], kind: str = "exact") -> list[float]:
    """``silhouette_value`` of (id, v) under each of several labellings (id, cluster_id).

    The exact kind takes every distance once for all labellings.
    """
    require_kind(kind)
    if kind != "exact" or len(labellings) < 2:
        return [silhouette_value(points.join(one, "id"), kind=kind) for one in labellings]
    names = [f"_c{i}" for i in range(len(labellings))]
    tagged = reduce(DataFrame.unionAll, [
        one.select("id", F.lit(i).alias("cand"), F.col("cluster_id").cast("int").alias("cluster_id")) for i, one in enumerate(labellings)
    ])
    # An id that repeats meets each of its labels, as in a join with one labelling.
    aligned = tagged.groupBy("id").agg(
        *[F.sort_array(F.collect_list(F.when(F.col("cand") == i, F.col("cluster_id")))).alias(c) for i, c in enumerate(names)]
    ).select("id", F.explode(F.arrays_zip(*names)).alias("c"))
    scored = grouped_silhouette(
        points.select("id", "v").join(aligned, "id").select(
            F.lit(0).cast("bigint").alias("grp"), F.col("id").cast("bigint").alias("id"), "v",
            F.array(*[F.coalesce(f"c.{c}", F.lit(-1)) for c in names]).alias("labs"),
        )
    )
    found = {r.cand: float(r.silhouette) for r in scored.collect()}
    return [found.get(i, 0.0) for i in range(len(labellings))]
