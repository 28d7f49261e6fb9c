"""Work that holds little at once: rings, matches, k-means rows, fused distances, eigenvector rounds."""

import tracemalloc

import numpy as np
import pytest

from pyspark.sql import functions as F

from labelloom.functions.vectors import squared_distances
from labelloom.operators import cells, fusion, lloyd, neighbors, pairs, silhouette, spectral
from labelloom.scratch import cut


def layout_of(rng, rings):
    pivots = rng.normal(size=(8, 3))
    low = rng.uniform(0, 1, rings)
    one = np.ones(rings, dtype=np.int64)
    at = np.arange(rings)
    return cells.Layout(pivots, at % 8, at // 8, low, low + 0.01, one, one, np.zeros(rings), np.zeros(8), at)


def test_many_rings_are_met_a_few_rows_at_a_time(monkeypatch):
    rng = np.random.default_rng(3)
    layout = layout_of(rng, 20_000)
    x = rng.normal(size=(512, 3))
    tracemalloc.start()
    found = cells.reachable(layout, 1 << 32, x, np.full(512, 0.2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 512 rows by 20,000 rings are 82 MB.
    assert peak < 32 << 20
    for values in (1, 1 << 26):
        monkeypatch.setattr(cells, "STEP_VALUES", values)
        some = cells.reachable(layout, 1 << 32, x[:40], np.full(40, 0.2))
        assert set(some) <= set(found)
    assert (some == cells.reachable(layout, 1 << 32, x[:40], np.full((40, 20_000), 0.2))).all()


def test_rows_meet_many_pivots_a_few_at_a_time():
    rng = np.random.default_rng(8)
    x, pivots = rng.normal(size=(8000, 5)), rng.normal(size=(1024, 5))
    tracemalloc.start()
    near, gap = cells.nearest_pivots(x, pivots)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All at once they are 66 MB, several times.
    assert peak < 16 << 20
    d2 = squared_distances(x, pivots)
    assert (near == d2.argmin(1)).all() and gap == pytest.approx(np.sqrt(d2.min(1)), abs=1e-7)


@pytest.mark.parametrize("symmetric", [False, True])
def test_matches_equal_those_over_all_pairs_and_hold_few_rows(symmetric):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2000, 16))
    x[1000:1800] = x[0] + 0.02 * rng.normal(size=(800, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = rng.permutation(2000)
    one, two = cells.Block(1, ids[:1000], x[:1000], ids[:1000] * 0.0), cells.Block(2, ids[1000:], x[1000:], ids[1000:] * 0.0)
    match, least = neighbors._match_kernel(0.95, symmetric)
    tracemalloc.start()
    parts = list(match(one, [two])) + list(match(two, [two]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # A cell by a cell of ids are 8 MB, of which there were three, besides the products.
    assert peak < 16 << 20
    got = least({c: np.concatenate([p[c] for p in parts]) for c in ("id", "first_id")})
    want = {}
    for i in range(2000):
        for j in np.flatnonzero(x @ x[i] >= 0.95):
            met = i >= 1000 and j >= 1000 or i < 1000 <= j or symmetric and j < 1000 <= i
            if met and ids[j] < ids[i]:
                want[ids[i]] = min(want.get(ids[i], 1 << 60), ids[j])
    assert dict(zip(got["id"].tolist(), got["first_id"].tolist())) == want


def test_sums_of_models_of_unequal_size_and_equally_near_centres():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = rng.integers(1, 7, 5)
        starts = np.r_[0, np.cumsum(sizes)]
        centres, x = rng.integers(0, 3, (starts[-1], 4)) * 1.0, rng.integers(0, 4, (200, 4)) * 1.0
        sums, counts, cost = np.zeros_like(centres), np.zeros(len(centres)), np.zeros(len(centres))
        lloyd._add_sums(x, lloyd._slots_by_k(centres, starts), sums, counts, cost)
        d2 = squared_distances(x, centres)
        for a, b in zip(starts[:-1], starts[1:]):
            near = d2[:, a:b].argmin(1)
            assert (counts[a:b] == np.bincount(near, minlength=b - a)).all()
            for c in range(a, b):
                assert sums[c] == pytest.approx(x[near == c - a].sum(0)) and cost[c] == pytest.approx(d2[near == c - a, c].sum())


@pytest.mark.parametrize("zero", [False, True])
def test_fused_silhouettes_with_and_without_empty_parts(spark, zero):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(60, 3)), rng.normal(size=(60, 2))
    if zero:
        a[:3] = 0
        b[2:5] = 0
    label = rng.integers(0, 3, 60)
    df = cut(spark.createDataFrame([(i, p.tolist(), q.tolist(), int(c)) for i, (p, q, c) in enumerate(zip(a, b, label))], "id long, a array<double>, b array<double>, cluster_id int"))

    def unit(v):
        length = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(length == 0, 1, length)

    for r in fusion.weight_silhouettes(df, ["a", "b"], 3).collect():
        v = unit(np.hstack([r.w0 * unit(a), r.w1 * unit(b)]))
        rows = spark.createDataFrame([(i, p.tolist(), int(c)) for i, (p, c) in enumerate(zip(v, label))], "id long, v array<double>, cluster_id int")
        assert r.silhouette == pytest.approx(silhouette.silhouette_value(rows), abs=1e-9)


def test_one_task_finds_the_vectors_and_sends_no_steps(spark, monkeypatch):
    rng = np.random.default_rng(5)
    n = 60
    rows = [(i, j, 1.0) for i in range(n) for j in range(i + 1, n) if j == i + 1 or rng.random() < 0.05]
    edges = cut(spectral.normalised(spark.createDataFrame(rows, "src long, dst long, weight double")), "edges")
    monkeypatch.setattr(spectral, "HELD_BYTES", 0)
    monkeypatch.setattr(spectral, "HELD_EDGES", 16)
    monkeypatch.setattr(spectral, "_leading_sent", None)
    found, values, residuals = spectral.leading(edges, 3, tolerance=1e-6)
    a = np.zeros((n, n))
    for r in edges.collect():
        a[r.id, r.nbr] += r.w
    x = np.array([r.v for r in found.orderBy("id").collect()])
    assert x.shape == (n, 3) and values == pytest.approx(np.linalg.eigvalsh(a)[::-1][:3], abs=1e-6) and residuals.max() <= 1e-6
    assert np.linalg.norm(a @ x - x * values, axis=0).max() <= 1.1e-6
    with pytest.raises(ValueError, match="not settled"):
        spectral.leading(edges, 3, tolerance=1e-12, rounds=1, degree=2)


def test_each_pair_of_blocks_meets_once(spark, points, monkeypatch):
    rng = np.random.default_rng(12)
    x, labels = rng.normal(size=(90, 3)), rng.integers(0, 3, 90)
    seen = spark.sparkContext.accumulator(0)

    def kernel(grp, left, right):
        for i, j in pairs.block_pairs(left, right):
            seen.add(len(left[i]["id"]) * len(right[j]["id"]))
            yield {"id": left[i]["id"][:1]}

    rows = silhouette.labelled(points(x, labels)).select("grp", "id", "v")
    pairs.pairwise(cut(rows), [], kernel, "id bigint", 8, 1, True).count()
    sizes = [r["count"] for r in rows.groupBy(F.pmod(F.xxhash64("id"), F.lit(12))).count().collect()]
    # All 90 x 90 pairs would be 8,100.
    assert seen.value == (90 * 90 + sum(s * s for s in sizes)) // 2
    got = silhouette.silhouette_rows(silhouette.labelled(points(x, labels)), 8).toPandas().sort_values("id")
    one = silhouette.silhouette_rows(silhouette.labelled(points(x, labels)), 1024).toPandas().sort_values("id")
    assert got["s"].to_numpy() == pytest.approx(one["s"].to_numpy())


def test_tasks_give_memory_back(points, monkeypatch, tmp_path):
    given, real = tmp_path / "given", cells.give_back
    monkeypatch.setattr(cells, "give_back", lambda: (real(), open(given, "a").write("x"))[0])
    x = np.random.default_rng(13).normal(size=(120, 3))
    x /= np.linalg.norm(x, axis=1)[:, None]
    found = {(r.id, r.first_id) for r in neighbors.earliest_matches(points(x), 0.95, 16).collect()}
    assert found == {(i, int(np.flatnonzero(x @ x[i] >= 0.95)[0])) for i in range(120) if (x[:i] @ x[i] >= 0.95).any()}
    # Placing, finding targets and the tiles, each at least once.
    assert len(given.read_text()) >= 3
