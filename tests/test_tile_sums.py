"""Sums over all pairs leave a task once per tile of blocks."""

import numpy as np
import pytest

from labelloom.operators import cells, pairs, silhouette


def test_sums_leave_a_task_once_per_tile(points, spark, monkeypatch):
    x = np.random.default_rng(14).normal(size=(240, 4))
    labels = np.arange(240) % 3
    found = []
    real = silhouette.pairwise
    monkeypatch.setattr(silhouette, "pairwise", lambda *args: found.append(real(*args)) or found[-1])
    rows = silhouette.silhouette_rows(silhouette.labelled(points(x, labels)), block_rows=8).toPandas().sort_values("id")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    mean = np.stack([d[:, labels == c].sum(1) / (80 - (labels == c)) for c in range(3)], 1)
    a = mean[np.arange(240), labels]
    mean[np.arange(240), labels] = np.inf
    b = mean.min(1)
    assert rows["s"].to_numpy() == pytest.approx((b - a) / np.maximum(a, b))
    assert found[0].count() <= 240 * 3 * cells.tile_side(spark, 30, 0)


def test_wide_results_take_smaller_tiles(points, monkeypatch):
    monkeypatch.setattr(pairs, "TILE_BYTES", 4096)
    x = np.random.default_rng(15).normal(size=(120, 4))
    got = silhouette.silhouette(points(x, np.arange(120) % 5)).first().silhouette
    monkeypatch.undo()
    assert got == pytest.approx(silhouette.silhouette(points(x, np.arange(120) % 5)).first().silhouette)
