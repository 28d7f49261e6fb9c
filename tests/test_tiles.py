"""Cells meet by tiles: what leaves the tasks grows with the tiles and not with the cells."""

import numpy as np
import pytest

from labelloom.operators import cells, density, neighbors


def watched(monkeypatch, module, name):
    """Tables that ``module.name`` returns."""
    found = []
    real = getattr(module, name)

    def spy(*args, **kw):
        found.append(real(*args, **kw))
        return found[-1]

    monkeypatch.setattr(module, name, spy)
    return found


def test_neighbours_leave_a_task_once_per_tile(points, spark, monkeypatch):
    x = np.random.default_rng(11).normal(size=(400, 12))
    found = watched(monkeypatch, neighbors, "join_cells")
    edges = neighbors.knn(points(x), 3, cell_rows=8).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    assert {(r.id, r.nbr, r["rank"]) for r in edges} == {(i, int(j), k + 1) for i in range(400) for k, j in enumerate(np.argsort(d[i])[:3])}
    assert found[0].count() <= 400 * 3 * cells.tile_side(spark, 50, 0)


def test_trees_of_a_tile_are_one_forest(points, spark, monkeypatch):
    x = np.random.default_rng(12).normal(size=(200, 8))
    found = watched(monkeypatch, density, "join_cells")
    pts = points(x)
    core = neighbors.core_distance(pts, 3)
    edges = density.candidate_edges(pts.join(core, "id"), cell_rows=8).toPandas()
    side = cells.tile_side(spark, 25, 0)
    assert found[0].count() <= 2 * 200 * side
    kept = density.lightest_forest({c: edges[c].to_numpy() for c in "abw"})
    ids, v = np.arange(200), x
    c = np.array([r.core for r in core.orderBy("id").collect()])
    assert len(kept["w"]) == 199
    assert kept["w"].sum() == pytest.approx(density.spanning_tree(ids, v, c)[2].sum())


def test_forest_with_ties_and_repeats():
    rng = np.random.default_rng(13)
    a, b = rng.integers(0, 40, 500), rng.integers(40, 80, 500)
    w = rng.integers(0, 3, 500).astype(float)
    order = np.lexsort((b, a, w))
    want = density.light_forest(a, b, order)
    got = density.lightest_forest({"a": a, "b": b, "w": w})
    assert sorted(zip(got["w"], got["a"], got["b"])) == sorted(zip(w[want], a[want], b[want]))
