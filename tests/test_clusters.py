import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.operators import cluster, crosscheck, density, drift, isolation, lloyd, quality, taxonomy


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def by_id(df, column="cluster_id"):
    return [r[column] for r in df.orderBy("id").collect()]


def test_estimate_k():
    assert [cluster.estimate_k(n, 10) for n in (5, 20, 200, 100000)] == [2, 2, 10, 20]
    assert cluster.candidate_ks(520, 7, 10) == [7, 16, 15, 17]
    with pytest.raises(ValueError):
        cluster.cluster(None, "other")


def test_kmeans_finds_blobs_and_ignores_partitioning(points, blobs):
    x, truth = blobs[0][:120], blobs[1][:120]
    one = by_id(cluster.kmeans(points(x, partitions=1), 3, restarts=3))
    order = np.random.default_rng(0).permutation(120)
    many = by_id(cluster.kmeans(points(x[order], ids=order, partitions=7), 3, restarts=3))
    assert one == many and same_partition(one, truth)
    with pytest.raises(ValueError):
        cluster.kmeans(points(x), 1)


def test_first_starts_look_behind_leading_copies(points):
    x = [[1.0, 1.0]] * 40 + [[2.0, 0.0], [2.0, 0.0], [3.0, 0.0]]
    pts = points(x).select(F.lit(0).cast("bigint").alias("grp"), "id", "v")
    assert lloyd.first_starts(pts, 3)[0].tolist() == [[1.0, 1.0], [2.0, 0.0], [3.0, 0.0]]
    assert lloyd.first_starts(pts, 1)[0].tolist() == [[1.0, 1.0]]
    assert len(lloyd.first_starts(pts, 5)[0]) == 3


def test_lloyd_batches_give_the_same_centres(points, blobs, monkeypatch):
    x = blobs[0]
    pts = points(x).select(F.lit(0).cast("bigint").alias("grp"), "id", "v")
    plain, models = lloyd.kmeans_candidates(pts, [2, 3], restarts=2, iterations=20)
    # Too small for two models at once and for adding up on the driver.
    monkeypatch.setattr(lloyd, "MAX_CENTRE_BYTES", 64)
    _, split = lloyd.kmeans_candidates(pts, [2, 3], restarts=2, iterations=20)
    assert [m.inertia for m in models] == pytest.approx([m.inertia for m in split])


def test_assign_nearest_in_pages(points, spark, monkeypatch):
    x = np.arange(20, dtype=float)[:, None]
    centres = spark.createDataFrame([(i, [float(4 * i)]) for i in range(5)], "cluster_id int, centroid array<double>")
    want = [min(range(5), key=lambda c: (abs(v - 4 * c), c)) for v in range(20)]
    assert by_id(cluster.assign_nearest(points(x), centres), "nearest") == want
    monkeypatch.setattr(cluster, "MAX_CENTRE_BYTES", 16)
    assert by_id(cluster.assign_nearest(points(x), centres), "nearest") == want


def test_graph_cluster_separates_blobs(points, blobs):
    x, truth = blobs[0][:80], blobs[1][:80]
    assert same_partition(by_id(cluster.graph_cluster(points(x), 2)), truth)


def test_density_cluster_blobs_noise_and_bands(points, blobs):
    x, truth = blobs
    whole = density.density_cluster(points(x), 10)
    assert same_partition(by_id(whole), truth)
    pieces = density.density_cluster(points(x), 10, task_edges=30, cell_rows=32)
    assert by_id(whole) == by_id(pieces)
    assert by_id(whole, "probability") == pytest.approx(by_id(pieces, "probability"))


def test_local_trees_hold_the_global_tree(points, blobs, spark):
    x = blobs[0]
    core = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), axis=1)[:, 4]
    rows = [(i, x[i].tolist(), float(core[i])) for i in range(len(x))]
    from labelloom.scratch import cut

    table = cut(spark.createDataFrame(rows, "id long, v array<double>, core double"))
    edges = density.candidate_edges(table, 24).orderBy("w", "a", "b").collect()
    parent = list(range(len(x)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    total, used = 0.0, 0
    for e in edges:
        a, b = find(e.a), find(e.b)
        if a != b:
            parent[a], total, used = b, total + e.w, used + 1
    assert used == len(x) - 1
    assert total == pytest.approx(density.spanning_tree(np.arange(len(x)), x, core)[2].sum())


def test_auto_choice_takes_the_best_silhouette(points, blobs):
    x, truth = blobs[0][:120], blobs[1][:120]
    found, table = cluster.cluster(points(x), "auto", n_clusters=3, restarts=2, iterations=20)
    rows = table.collect()
    assert {r.method for r in rows} == {"hdbscan", "kmeans", "spectral"}
    assert same_partition(by_id(found), truth)


def test_isolation_forest_flags_the_planted_outlier(points):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(size=(99, 4)), [[25.0, 25, 25, 25]]])
    scores = {r.id: r.score for r in isolation.isolation_scores(points(x, partitions=1), trees=30).collect()}
    other = {r.id: r.score for r in isolation.isolation_scores(points(x, partitions=6), trees=30).collect()}
    assert max(scores, key=scores.get) == 99 and scores == other
    flags = quality.isolation_flags(points(x), 0.1)
    assert flags.where("flag").count() == 10
    small = points(x[:9])
    assert quality.isolation_flags(small).where("flag").count() == 0
    assert quality.lof_flags(small).where("flag").count() == 0


def test_coherence_of_a_single_row_is_one(points):
    rows = {r.cluster_id: r.coherence for r in quality.coherence(points([[0.0], [2.0], [9.0]], [0, 0, 1])).collect()}
    assert rows[1] == 1.0 and rows[0] == pytest.approx(np.exp(-1.0))


def test_assess_stays_in_range(points, blobs):
    rows = quality.assess(points(*blobs)).collect()
    assert len(rows) == 125 and all(0 <= r.quality_score <= 1 for r in rows)


def test_label_collisions(spark):
    def pairs(*labels, threshold=0.5):
        df = spark.createDataFrame(list(enumerate(labels)), "cluster_id int, label string")
        return {(r.cluster_a, r.cluster_b): r.similarity for r in crosscheck.label_collisions(df, threshold).collect()}

    assert pairs("Sports News", "sports news", "tech") == {(0, 1): 1.0}
    assert pairs("alpha", "beta", "gamma") == {}
    assert pairs("a b c d", "a b c e", "x", threshold=0.6) == {(0, 1): pytest.approx(0.6)}


def test_split_and_merge_and_outlier(points, blobs):
    x, truth = blobs
    joined = np.where(truth == 1, 0, truth)
    found = crosscheck.split_candidates(points(x, joined)).collect()
    assert [r.cluster_a for r in found] == [0]
    centres = crosscheck.real_centroids(points(x[:120] + 50, truth[:120]))
    assert crosscheck.merge_candidates(centres, 0.85).count() == 3
    lonely = np.vstack([x[:80] + [20, 0, 0, 0], [[-9.0, 0, 0, 0]] * 2])
    centres = crosscheck.real_centroids(points(lonely, np.concatenate([truth[:80], [5, 5]])))
    assert [r.cluster_a for r in crosscheck.outlier_clusters(centres).collect()] == [5]


def test_consistency(spark):
    flags = spark.createDataFrame([("merge_candidate",)] * 3, "flag_type string")
    assert crosscheck.consistency(flags, 2).first().consistency == pytest.approx(0.7)
    assert crosscheck.consistency(flags.where("false"), 0).first().consistency == 1.0


def test_drift_collapse_and_first_iteration(points, blobs):
    x, truth = blobs
    first, centres = drift.measure(points(x, truth), 0)
    second, _ = drift.measure(points(x * 0.2, truth), 1, centres)
    rows = drift.report(first.unionByName(second)).orderBy("iteration").collect()
    assert not rows[0].collapse and not rows[0].rollback and rows[0].centroid_drift == 0
    assert rows[1].collapse and rows[1].rollback and rows[1].health == 0.2


def test_taxonomy_splits_and_respects_gates(points, blobs, spark):
    x, truth = blobs
    df = points(x, np.where(truth == 1, 0, truth))
    labels = spark.createDataFrame([(0, "both", 0.8), (2, "one", 0.6)], "cluster_id int, label string, confidence double")
    tree = taxonomy.discover(df, labels, max_depth=2, min_samples=10, min_silhouette=0.5)
    rows = {r.node_path: r for r in tree.collect()}
    assert {"0", "2", "0/0", "0/1"} == set(rows)
    assert rows["0/0"].label == "both/0" and rows["0/0"].confidence == pytest.approx(0.72)
    assert rows["0/0"].n_samples + rows["0/1"].n_samples == rows["0"].n_samples
    assert taxonomy.flatten(tree).first().children == ["both/0", "both/1"]
    assert taxonomy.stats(tree).first().max_depth == 1
    assert '"label":"both/1"' in taxonomy.nested(tree, 1).where("node_path = '0'").first().json
    flat = taxonomy.discover(df, labels, max_depth=0)
    assert flat.count() == 2


def plain_plus_plus(x, k, seed):
    """k-means++ over all rows, one draw per start."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(x)))]
    while len(chosen) < k:
        gap = ((x[:, None] - x[chosen][None]) ** 2).sum(-1).min(1)
        chosen.append(int(rng.choice(len(x), p=gap / gap.sum())))
    return x[chosen]


def cost(x, centres):
    return float(((x[:, None] - centres[None]) ** 2).sum(-1).min(1).sum())


def test_parallel_starts_are_no_worse_than_plain_ones(points):
    rng = np.random.default_rng(31)
    x = np.vstack([rng.normal(rng.uniform(-20, 20, 3), 1.0, (30, 3)) for _ in range(8)])
    pts = points(x).select(F.lit(0).cast("bigint").alias("grp"), "id", "v")
    found = lloyd.parallel_starts(pts, 8, restarts=20)
    assert sorted(found) == [(0, r) for r in range(20)] and all(len(c) == 8 for c in found.values())
    assert len({tuple(c[0]) for c in found.values()}) > 5  # restarts begin at rows of their own
    plain = [cost(x, plain_plus_plus(x, 8, seed)) for seed in range(20)]
    assert np.median([cost(x, c) for c in found.values()]) <= np.median(plain)
    other = lloyd.parallel_starts(pts.repartition(5), 8, restarts=20)
    assert all(np.array_equal(found[key], other[key]) for key in found)


def test_parallel_starts_of_few_distinct_rows_and_in_batches(points, monkeypatch):
    x = [[0.0, 0.0]] * 30 + [[1.0, 0.0]] * 2 + [[5.0, 5.0]]
    pts = points(x).select((F.col("id") % 2).cast("bigint").alias("grp"), "id", "v")
    found = lloyd.parallel_starts(pts, 4, restarts=3)
    assert {key: len(c) for key, c in found.items()} == {(g, r): 3 if g == 0 else 2 for g in (0, 1) for r in range(3)}
    monkeypatch.setattr(lloyd, "MAX_CENTRE_BYTES", 1)
    again = lloyd.parallel_starts(pts, 4, restarts=3)
    assert all(np.array_equal(found[key], again[key]) for key in found)


def test_farthest_starts(points):
    x = [[0.0], [1.0], [9.0], [4.0], [9.0]]
    pts = points(x).select(F.lit(3).cast("bigint").alias("grp"), "id", "v")
    assert lloyd.spread_starts(pts, 3, 5, starts="farthest")[3, 0].ravel().tolist() == [0.0, 9.0, 4.0]
    assert len(lloyd.spread_starts(pts, 9, 1, starts="farthest")[3, 0]) == 4
