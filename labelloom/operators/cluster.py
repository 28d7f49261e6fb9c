"""Clustering: choice of k, k-means, graph clustering and the automatic choice."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import IllegalArgumentException
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.vectors import matrix, squared_distances
from labelloom.operators.clean import CLUSTER_METHODS, require_vectors
from labelloom.operators.lloyd import MAX_CENTRE_BYTES, kmeans_candidates
from labelloom.operators.neighbors import knn
from labelloom.operators.spectral import embedding
from labelloom.operators.silhouette import grouped_silhouette, require_kind, silhouette_value, silhouette_values
from labelloom.scratch import cut, settle


def estimate_k(n: int, min_cluster_size: int = 10) -> int:
    """sqrt(n / 2), at most 20 and one cluster per ``min_cluster_size`` rows, at least 2."""
    return max(2, min(int(math.sqrt(n / 2)), min(20, n // min_cluster_size)))


def canonical(assigned: DataFrame, column: str = "cluster_id") -> DataFrame:
    """Renumber clusters by their smallest member id, so ids do not depend on the run."""
    members = assigned.where(F.col(column) >= 0).groupBy(column).agg(F.min("id").alias("first"))
    # One row per cluster.
    numbered = settle(
        members.select(
            F.col(column), (F.row_number().over(Window.orderBy("first")) - 1).cast("int").alias("_new")
        ),
        "canonical",
    )
    return (
        assigned.join(numbered, column, "left")
        .withColumn(column, F.coalesce("_new", F.lit(-1)).cast("int"))
        .drop("_new")
    )


def _pages(centres: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Centres in cluster order, in pages of at most MAX_CENTRE_BYTES."""
    ids, vs = [], []
    for r in centres.orderBy("cluster_id").toLocalIterator():
        ids.append(r.cluster_id)
        vs.append(r.centroid)
        if len(vs) * len(r.centroid) * 8 >= MAX_CENTRE_BYTES:
            yield np.array(ids), np.array(vs)
            ids, vs = [], []
    if vs:
        yield np.array(ids), np.array(vs)


def assign_nearest(points: DataFrame, centres: DataFrame) -> DataFrame:
    """Add ``nearest`` and ``distance``; ties go to the smaller cluster id.

    Centres travel to the tasks in pages of bounded size; every page is one
    narrow pass that keeps the better of old and new.
    """
    out = points.withColumn("nearest", F.lit(None).cast("int")).withColumn(
        "distance", F.lit(None).cast("double")
    )
    for ids, table in _pages(centres):

        def better(batches: Iterator[pa.RecordBatch], ids=ids, table=table) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                x = matrix(batch["v"])
                near = squared_distances(x, table).argmin(1)
                gap = np.sqrt(((x - table[near]) ** 2).sum(1))
                old = batch["distance"].to_numpy(zero_copy_only=False).astype(np.float64)
                keep = ~np.isnan(old) & (old <= gap)
                kept = batch["nearest"].fill_null(-1).to_numpy(zero_copy_only=False)
                fresh = {
                    "nearest": pa.array(np.where(keep, kept, ids[near]).astype(np.int32)),
                    "distance": pa.array(np.where(keep, old, gap)),
                }
                yield pa.RecordBatch.from_arrays(
                    [fresh.get(name, batch[name]) for name in batch.schema.names], batch.schema.names
                )

        out = out.mapInArrow(better, out.schema)
    return out


def kmeans(
    points: DataFrame, k: int, restarts: int = 10, iterations: int = 300, seed: int = 42
) -> DataFrame:
    """(id, cluster_id) of the best of several seeded starts."""
    n = points.count()
    if k < 2 or k >= n:
        raise ValueError(f"k must be at least 2 and below the number of rows ({n}), got {k}")
    grouped = points.select(F.lit(0).cast("bigint").alias("grp"), "id", "v")
    labelled, _ = kmeans_candidates(grouped, [k], restarts, iterations, seed)
    return canonical(labelled.select("id", F.get("labs", F.lit(0)).alias("cluster_id")))


def kmeans_ml(points: DataFrame, k: int, restarts: int = 3, iterations: int = 300, seed: int = 42) -> DataFrame:
    """(id, cluster_id) by the ML library's parallel-start k-means, best training cost."""
    rows = points.select("id", array_to_vector(F.col("v")).alias("features"))
    models = [
        KMeans(k=k, seed=seed + r, maxIter=iterations, tol=1e-6).fit(rows) for r in range(restarts)
    ]
    best = min(models, key=lambda m: m.summary.trainingCost)
    return canonical(best.transform(rows).select("id", F.col("prediction").alias("cluster_id")))


def knn_graph(points: DataFrame, neighbors: int = 10, edges: DataFrame | None = None) -> DataFrame:
    """Undirected (src < dst, weight) graph: 1 for mutual neighbours, 0.5 for one-sided.

    As in the usual definition a point counts as its own first neighbour, so
    each has ``neighbors - 1`` others.
    """
    edges = knn(points, neighbors - 1) if edges is None else edges
    return edges.groupBy(F.least("id", "nbr").alias("src"), F.greatest("id", "nbr").alias("dst")).agg(
        (F.count(F.lit(1)) * F.lit(0.5)).alias("weight")
    )


def graph_cluster(
    points: DataFrame, k: int, neighbors: int = 10, restarts: int = 10, iterations: int = 300, tolerance: float = 1e-4,
    seed: int = 42,
) -> DataFrame:
    """(id, cluster_id) by k-means over the k leading eigenvectors of the neighbour graph.

    A graph whose embedding has fewer than k distinct rows gives as many clusters as it has.
    """
    n = points.count()
    if k < 2 or k >= n:
        raise ValueError(f"k must be at least 2 and below the number of rows ({n}), got {k}")
    graph = cut(knn_graph(points, max(2, min(neighbors, n - 1))), "graph")
    rows = embedding(graph, k, tolerance, seed)
    # Rows that agree up to the tolerance of the eigenvectors are one place.
    places = rows.select(F.transform("v", lambda x: F.round(x, 6) + F.lit(0.0)).alias("v")).distinct().limit(k).count()
    if places < 2:
        return rows.select("id", F.lit(0).alias("cluster_id"))
    return kmeans(rows, min(k, places), restarts, iterations, seed)


def select_best(candidates: DataFrame) -> DataFrame:
    """The candidate with the highest silhouette, the earlier one on a tie."""
    return candidates.orderBy(F.desc("silhouette"), "try_order").limit(1)


def candidate_ks(n: int, n_clusters: int | None, min_cluster_size: int) -> list[int]:
    """Cluster counts to try, in order and without repeats."""
    k = estimate_k(n, min_cluster_size)
    wanted = ([n_clusters] if n_clusters is not None else []) + [k, max(2, k - 1), k + 1]
    return [k for k in dict.fromkeys(wanted) if 2 <= k < n]


def cluster(
    points: DataFrame, method: str = "auto", n_clusters: int | None = None, min_cluster_size: int = 10,
    restarts: int = 10, iterations: int = 300, seed: int = 42, silhouette: str = "exact",
) -> tuple[DataFrame, DataFrame]:
    """((id, cluster_id), candidate table) for a written table of (id, v).

    All k-means candidates share their passes over the data, and all candidates
    without noise the distances of their silhouettes.  The candidate
    table lists every method tried with its silhouette and its kind.  With
    ``auto`` a method that fails is left out; only if none is left does it raise.
    """
    from labelloom.operators.density import density_cluster

    if method not in CLUSTER_METHODS:
        raise ValueError(f"unknown clustering method: {method}")
    require_kind(silhouette)
    require_vectors(points)
    n = points.count()
    if n < min_cluster_size:
        raise ValueError(f"{n} rows are fewer than min_cluster_size {min_cluster_size}")
    k = n_clusters if n_clusters is not None else estimate_k(n, min_cluster_size)
    ks = candidate_ks(n, n_clusters, min_cluster_size) if method == "auto" else [k]

    def by_density() -> list[tuple[str, int, DataFrame]]:
        return [("hdbscan", -1, cut(density_cluster(points, min_cluster_size).select("id", "cluster_id"), "density"))]

    def by_means() -> list[tuple[str, int, DataFrame]]:
        grouped = points.select(F.lit(0).cast("bigint").alias("grp"), "id", "v")
        labelled, models = kmeans_candidates(grouped, ks, restarts, iterations, seed)
        at = {m.k: i for i, m in enumerate(models)}
        column = lambda k_try: labelled.select("id", F.get("labs", F.lit(at[k_try])).alias("cluster_id"))
        return [("kmeans", k_try, column(k_try)) for k_try in ks if k_try in at]

    def by_graph() -> list[tuple[str, int, DataFrame]]:
        return [("spectral", k, graph_cluster(points, k))]

    results: list[tuple[str, int, DataFrame]] = []
    failed: list[str] = []
    tries = [("hdbscan", by_density, True), ("kmeans", by_means, bool(ks)), ("spectral", by_graph, method == "spectral" or 2 <= k < n)]
    for name, attempt, applies in tries:
        if method not in ("auto", name) or not applies:
            continue
        try:
            results += attempt()
        except (ValueError, IllegalArgumentException) as error:
            if method != "auto":
                raise
            failed.append(f"{name}: {error}")
    # Labellings of every row share their distances; density clustering leaves rows out and is scored on the others alone.
    values: dict[int, float] = {}
    for partial in (True, False):
        at = [i for i, (name, _, _) in enumerate(results) if (name == "hdbscan") == partial]
        values.update(zip(at, silhouette_values(points, [results[i][2] for i in at], silhouette), strict=True))
    scores = [(order, name, k_try, values[order], silhouette) for order, (name, k_try, _) in enumerate(results)]
    if not scores:
        raise RuntimeError("no clustering method applies" + "".join(f"; {x}" for x in failed))
    table = points.sparkSession.createDataFrame(
        scores, "try_order int, method string, k int, silhouette double, silhouette_kind string"
    )
    best = max(scores, key=lambda s: (s[3], -s[0]))
    return cut(canonical(results[best[0]][2]), "clusters"), table


def cluster_metrics(df: DataFrame, silhouette: str = "exact") -> DataFrame:
    """One row: rows, real clusters, noise rows, noise share, silhouette and its kind."""
    value = silhouette_value(df, kind=silhouette)
    return df.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_distinct(F.when(F.col("cluster_id") >= 0, F.col("cluster_id"))).alias("n_clusters"),
        F.count_if(F.col("cluster_id") == -1).alias("n_noise"),
        F.coalesce(F.avg((F.col("cluster_id") == -1).cast("double")), F.lit(0.0)).alias("noise_ratio"),
    ).select("*", F.lit(value).alias("silhouette"), F.lit(silhouette).alias("silhouette_kind"))
