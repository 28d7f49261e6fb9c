"""Graph clustering on eigenvectors: against dense linear algebra, and on shapes that means alone cannot separate."""

import numpy as np
import pytest

from labelloom.operators import cluster, spectral
from labelloom.scratch import cut


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def dense(edges, n):
    a = np.zeros((n, n))
    for r in edges.collect():
        a[r.id, r.nbr] += r.w
    return a


def graph_of(spark, weights):
    return spark.createDataFrame([(int(i), int(j), float(w)) for (i, j), w in weights.items()], "src long, dst long, weight double")


def blocks(rng, sizes, inside, between):
    """A weighted graph of blocks with few links between them."""
    truth = np.repeat(np.arange(len(sizes)), sizes)
    weights = {}
    for i in range(len(truth)):
        for j in range(i + 1, len(truth)):
            if rng.random() < (inside if truth[i] == truth[j] else between):
                weights[i, j] = 1.0 if truth[i] == truth[j] else 0.5
    for i in range(len(truth) - 1):  # every block hangs together
        if truth[i] == truth[i + 1]:
            weights[i, i + 1] = 1.0
    return weights, truth


@pytest.mark.parametrize("k,sent,tolerance", [(1, True, 1e-8), (6, True, 1e-8), (4, False, 1e-4)])
def test_leading_vectors_equal_dense_ones(spark, k, sent, tolerance, monkeypatch):
    if not sent:
        monkeypatch.setattr(spectral, "BLOCK_BYTES", 0)
    weights, _ = blocks(np.random.default_rng(3), [20, 25, 30, 18], 0.3, 0.02)
    edges = cut(spectral.normalised(graph_of(spark, weights)), "edges")
    found, values, residuals = spectral.leading(edges, k, tolerance=tolerance)
    a = dense(edges, 93)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    assert values == pytest.approx(want, abs=1.1 * tolerance) and residuals.max() <= tolerance
    x = np.array([r.v for r in found.orderBy("id").collect()])
    assert np.abs(x.T @ x - np.eye(k)).max() < 1e-8
    assert np.linalg.norm(a @ x - x * values, axis=0).max() <= 1.1 * tolerance


def test_all_vectors_of_a_tiny_graph(spark):
    edges = cut(spectral.normalised(graph_of(spark, {(0, 1): 1.0, (1, 2): 1.0, (2, 0): 0.5, (3, 3): 9.0, (2, 4): 2.0})), "edges")
    assert {r.id for r in edges.select("id").distinct().collect()} == {0, 1, 2, 4}  # a loop is no edge
    ids = [0, 1, 2, 4]
    a = dense(edges, 5)[np.ix_(ids, ids)]
    _, values, _ = spectral.leading(edges, 4, tolerance=1e-9)
    assert values == pytest.approx(np.linalg.eigvalsh(a)[::-1], abs=1e-9)
    with pytest.raises(ValueError, match="nodes"):
        spectral.leading(edges, 5)


def test_result_does_not_depend_on_partitioning(spark):
    weights, _ = blocks(np.random.default_rng(5), [15, 15, 15], 0.4, 0.01)
    graph = graph_of(spark, weights)
    one = spectral.embedding(graph.repartition(1), 3, 1e-9).orderBy("id").collect()
    many = spectral.embedding(graph.repartition(7), 3, 1e-9).orderBy("id").collect()
    x, y = np.array([r.v for r in one]), np.array([r.v for r in many])
    assert np.abs(x @ x.T - y @ y.T).max() < 1e-6
    assert np.linalg.norm(x, axis=1) == pytest.approx(np.ones(45))


def test_unsettled_vectors_are_an_error(spark):
    weights = {(i, i + 1): 1.0 for i in range(300)}  # a long path: its leading values almost agree
    edges = cut(spectral.normalised(graph_of(spark, weights)), "edges")
    with pytest.raises(ValueError, match="settled"):
        spectral.leading(edges, 3, tolerance=1e-12, rounds=1, degree=2)


def test_five_weakly_linked_blocks(spark):
    weights, truth = blocks(np.random.default_rng(11), [40, 40, 40, 40, 40], 0.2, 0.004)
    rows = spectral.embedding(graph_of(spark, weights), 5)
    found = [r.cluster_id for r in cluster.kmeans(rows, 5).orderBy("id").collect()]
    assert same_partition(found, truth)


def test_two_rings(points):
    rng = np.random.default_rng(2)
    angle = rng.uniform(0, 2 * np.pi, 300)
    radius = np.where(np.arange(300) < 120, 1.0, 3.0) + rng.normal(0, 0.05, 300)
    x = np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=1)
    truth = (np.arange(300) >= 120).astype(int)
    pts = points(x)
    assert same_partition([r.cluster_id for r in cluster.graph_cluster(pts, 2).orderBy("id").collect()], truth)
    means = [r.cluster_id for r in cluster.kmeans(pts, 2).orderBy("id").collect()]
    assert not same_partition(means, truth)


def test_copies_and_more_clusters_than_places(points):
    x = np.repeat([[0.0, 0.0], [5.0, 5.0], [9.0, 0.0]], 12, axis=0)
    found = [r.cluster_id for r in cluster.graph_cluster(points(x), 3, neighbors=5).orderBy("id").collect()]
    assert same_partition(found, np.repeat([0, 1, 2], 12))
