"""Candidates of the automatic choice share the distances of their silhouettes."""

import numpy as np
import pytest

from labelloom.operators import cluster, silhouette


def exact(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i, own in enumerate(labels):
        mine = labels == own
        a = d[i, mine].sum() / max(mine.sum() - 1, 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b) if mine.sum() > 1 else 0.0)
    return np.mean(out)


def test_candidates_share_one_pass_over_pairs(points, blobs, monkeypatch):
    x = blobs[0][blobs[1] >= 0]
    passes, pairwise = [], silhouette.pairwise
    monkeypatch.setattr(silhouette, "pairwise", lambda *a, **k: passes.append(a[0]) or pairwise(*a, **k))
    _, table = cluster.cluster(points(x), "auto", n_clusters=3, restarts=2, iterations=20)
    assert table.count() >= 4
    assert len(passes) == 2  # density leaves rows out, all others meet in one


def test_values_follow_the_definition(spark, points):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(60, 3)), np.ones((4, 3))])
    labels = [rng.integers(0, k, len(x)) for k in (2, 5)] + [np.r_[np.full(30, -1), rng.integers(0, 3, 34)], np.zeros(64, dtype=int)]
    tables = [spark.createDataFrame(list(zip(range(64), map(int, one))), "id long, cluster_id int") for one in labels]
    got = silhouette.silhouette_values(points(x), tables)
    real = labels[2] >= 0
    assert got == pytest.approx([exact(x, labels[0]), exact(x, labels[1]), exact(x[real], labels[2][real]), 0.0])


def test_repeated_ids_count_as_in_single_joins(points):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(20, 2))
    rows = points(np.vstack([x, x]), ids=[*range(20), *range(20)])
    labels = [points(np.vstack([x, x]), clusters=np.tile(rng.integers(0, k, 20), 2), ids=[*range(20), *range(20)]).select("id", "cluster_id") for k in (2, 3)]
    single = [silhouette.silhouette_value(rows.join(one, "id")) for one in labels]
    assert silhouette.silhouette_values(rows, labels) == pytest.approx(single)
