import numpy as np
import pytest

from labelloom.operators import neighbors, silhouette


def brute_knn(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), d.shape), d), axis=1)[:, :k]
    return order, np.take_along_axis(d, order, 1)


def data(seed, copies):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(c, 0.5, (40, 3)) for c in ((0, 0, 0), (4, 0, 0), (0, 9, 0))])
    return np.vstack([x, np.tile(x[5], (copies, 1))]) if copies else x


@pytest.mark.parametrize("copies, cell_rows, k", [(0, 1024, 4), (0, 16, 7), (60, 16, 3)])
def test_knn_equals_brute_force(points, copies, cell_rows, k):
    x = data(1, copies)
    rows = neighbors.knn(points(x), k, cell_rows).collect()
    order, dist = brute_knn(x, k)
    got = {(r.id, r.rank): (r.nbr, r.distance) for r in rows}
    assert len(got) == len(x) * k
    for i in range(len(x)):
        assert [got[i, r + 1][0] for r in range(k)] == list(order[i])
        assert [got[i, r + 1][1] for r in range(k)] == pytest.approx(list(dist[i]), abs=1e-9)


@pytest.mark.parametrize("copies", [0, 70])
def test_lof_equals_brute_force(points, copies):
    x, k = data(2, copies), 5
    order, dist = brute_knn(x, k)
    kdist = dist[:, -1]
    lrd = 1 / (np.maximum(kdist[order], dist).mean(1) + 1e-10)
    want = lrd[order].mean(1) / lrd
    got = {r.id: r.lof for r in neighbors.lof(points(x), k).collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(list(want), rel=1e-6)


@pytest.mark.parametrize("cell_rows, copies", [(1024, 0), (16, 0), (16, 60)])
def test_near_duplicates_equal_brute_force(points, cell_rows, copies):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 6))
    x = np.vstack([base, base + rng.normal(0, 0.15, base.shape), np.zeros((3, 6)), np.tile(base[3], (copies, 1))])
    x = x[rng.permutation(len(x))]
    n = np.linalg.norm(x, axis=1)
    u = x / np.where(n == 0, 1, n)[:, None]
    hit = (u @ u.T >= 0.95) & (n[:, None] > 0) & (n[None] > 0)
    want = {j: int(np.flatnonzero(hit[j, :j])[0]) for j in range(len(x)) if hit[j, :j].any()}
    got = {r.id: r.first_id for r in neighbors.earliest_matches(points(x), 0.95, cell_rows).collect()}
    # Rounding of a scaled copy may sit on either side of equality, never of the threshold.
    assert got == want
    flags = {r.id: r.duplicate_flag for r in neighbors.near_duplicate_flags(points(x), 0.95).collect()}
    assert {i for i, f in flags.items() if f} == set(want) and len(flags) == len(x)


def test_hot_near_copies_take_the_leader_pass(points, monkeypatch):
    rng = np.random.default_rng(6)
    hot = np.array([1.0, 2, 3, 4]) + rng.normal(0, 0.01, (400, 4))
    x = np.vstack([hot, rng.normal(size=(200, 4))])[rng.permutation(600)]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hit = u @ u.T >= 0.99
    want = {j: int(np.flatnonzero(hit[j, :j])[0]) for j in range(len(x)) if hit[j, :j].any()}
    monkeypatch.setattr(neighbors, "LEADERS", 5)
    monkeypatch.setattr(neighbors, "PLAIN_CHUNKS", 1)
    got = {r.id: r.first_id for r in neighbors.earliest_matches(points(x), 0.99, 12).collect()}
    assert got == want


def test_near_duplicate_fixtures(points):
    five = points([[1.0, 0, 0, 0]] * 5)
    assert neighbors.near_duplicate_flags(five).where("duplicate_flag").count() == 4
    assert neighbors.near_duplicate_flags(points([[1.0, 0]])).where("duplicate_flag").count() == 0
    assert neighbors.near_duplicate_flags(points([[0.0, 0]] * 3)).where("duplicate_flag").count() == 0


def brute_silhouette(x, labels, d=None):
    keep = labels >= 0
    x, labels = x[keep], labels[keep]
    if d is None:
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
        out.append((b - a) / max(a, b))
    return np.mean(out)


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_silhouette_equals_brute_force(points, blobs, block_rows):
    x, labels = blobs
    x = np.vstack([x, np.tile(x[0], (30, 1)), [[50.0, 0, 0, 0]]])
    labels = np.concatenate([labels, np.zeros(30, int), [7]])
    df = points(x, labels)
    rows = silhouette.grouped_silhouette(silhouette.labelled(df), block_rows).first()
    assert rows.silhouette == pytest.approx(brute_silhouette(x, labels), abs=1e-7)


def test_linear_silhouette_equals_brute_force_on_squares(points, blobs):
    x, labels = blobs
    x, labels = np.vstack([x, [[50.0, 0, 0, 0]]]), np.concatenate([labels, [7]])
    keep = labels >= 0
    d = ((x[keep][:, None] - x[keep][None]) ** 2).sum(-1)
    got = silhouette.grouped_silhouette_squared(silhouette.labelled(points(x, labels))).first().silhouette
    assert got == pytest.approx(brute_silhouette(x, labels, d), abs=1e-9)
    kinds = silhouette.split_silhouette(silhouette.labelled(points(x, labels)), "squared")
    assert kinds.first().kind == "squared" and kinds.first().silhouette == pytest.approx(got)


def test_silhouette_edge_cases(points):
    x = [[0.0, 0], [1.0, 0], [5.0, 5], [6.0, 5]]
    assert silhouette.silhouette(points(x, [0, 0, 0, 0])).first().silhouette == 0
    assert silhouette.silhouette(points(x, [-1] * 4)).first().silhouette == 0
    assert silhouette.silhouette(points(x, [0, 1, 2, 3])).first().silhouette == 0
    assert silhouette.silhouette(points(x, [0, 0, 1, 1])).first().silhouette > 0.7


def test_core_distance_of_one_sample_is_zero(points):
    assert {r.core for r in neighbors.core_distance(points([[0.0], [3.0]]), 1).collect()} == {0.0}


@pytest.mark.parametrize("cell_rows", [16, 64, 4096])
@pytest.mark.parametrize("kind", ["one_hot", "grid", "hashed"])
def test_neighbours_on_ties_go_to_the_smaller_id(points, cell_rows, kind):
    rng = np.random.default_rng(5)
    if kind == "one_hot":
        x = np.eye(90)
    elif kind == "grid":
        x = np.array([[i, j, k] for i in range(6) for j in range(5) for k in range(4)], dtype=float)
    else:
        x = (rng.random((110, 12)) < 0.15).astype(float)
        x[:, 0] = np.where(x.any(axis=1), x[:, 0], 1.0)
    k = 3
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    want = {i: [int(j) for j in np.lexsort((np.arange(len(x)), d[i]))[:k]] for i in range(len(x))}
    got: dict[int, list[int]] = {}
    for r in neighbors.knn(points(x, partitions=2), k, cell_rows).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.nbr)
    assert got == want
