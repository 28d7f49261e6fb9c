"""Two tiles of one table's cells meet once, and the tree of a pair of cells follows (weight, a, b) through ties."""

import numpy as np

from labelloom.operators import cells, density, neighbors


def test_a_cell_is_sent_once_for_both_directions(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 3))
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    sent = []
    plain = cells.meet

    def watched(left, right, keys, run, schema):
        both = [(r.tile, r.cell) for side in (left, right) for r in side.select("tile", "cell").collect()]
        sent.append((both, len({c for _, c in both})))
        return plain(left, right, keys, run, schema)

    monkeypatch.setattr(cells, "meet", watched)
    found = {(r.id, r["rank"]): r.nbr for r in neighbors.knn(points, 3, cell_rows=12).collect()}
    (both, n), = sent
    assert len(both) == len(set(both)) <= n * cells.tile_side(spark, n, 0)
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(gaps, np.inf)
    near = np.argsort(gaps, axis=1, kind="stable")[:, :3]
    assert found == {(i, k + 1): int(near[i, k]) for i in range(600) for k in range(3)}


def test_spanning_tree_breaks_ties_by_weight_and_ends():
    rng = np.random.default_rng(6)
    for n in (1, 2, 7, 40):
        ids = rng.permutation(90)[:n]
        x, core = rng.integers(0, 3, (n, 2)).astype(float), rng.choice([0.0, 1.0, 2.0], n)
        found = set(zip(*(c.tolist() for c in density.spanning_tree(ids, x, core)), strict=True))
        edges = []
        for i in range(n):
            for j in range(i):
                w = max(float(np.sqrt(((x[i] - x[j]) ** 2).sum())), core[i], core[j])
                edges.append((w, int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
        home, want = {int(i): int(i) for i in ids}, set()
        for w, a, b in sorted(edges):
            if home[a] != home[b]:
                old, new = home[b], home[a]
                home = {k: new if v == old else v for k, v in home.items()}
                want.add((a, b, w))
        assert {(a, b) for a, b, _ in found} == {(a, b) for a, b, _ in want}
        assert np.allclose(sorted(w for *_, w in found), sorted(w for *_, w in want))
