import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelloom.functions.vectors import unit
from labelloom.operators import fusion, represent


def test_unit_keeps_zero(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r.u for r in df.select(unit(F.col("v")).alias("u")).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_hashed_vector_counts_whole_texts(spark):
    text = "Alpha beta ALPHA 42 é " * 3000
    df = spark.createDataFrame([(text,), ("",), (None,)], "t string")
    rows = df.select(represent.hashed_vector(F.col("t"), 32, normalize=False).alias("v")).collect()
    want = np.zeros(32)
    for w, n in (("alpha", 6000), ("beta", 3000)):
        want[represent.bucket_of(w, 32)] += n
    assert rows[0].v == list(want) and sum(rows[1].v) == 0 and sum(rows[2].v) == 0


def test_fusion_has_unit_norm_and_right_width(spark):
    rng = np.random.default_rng(1)
    rows = [(rng.normal(size=16).tolist(), rng.normal(size=16).tolist()) for _ in range(5)]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    for r in df.select(represent.fuse([F.col("a"), F.col("b")], [0.5, 0.5]).alias("f")).collect():
        assert len(r.f) == 32 and np.linalg.norm(r.f) == pytest.approx(1.0)


@given(st.lists(st.floats(0, 10), min_size=1, max_size=5), st.integers(1, 5))
@settings(max_examples=50, deadline=None)
def test_weights_sum_to_one(weights, n):
    assert sum(represent.resolve_weights(n, weights)) == pytest.approx(1.0)


@pytest.mark.parametrize("n, size", [(1, 1), (2, 6), (3, 21)])
def test_simplex_grid(n, size):
    grid = represent.simplex_grid(n)
    assert len(grid) == size and all(sum(w) == pytest.approx(1.0) for w in grid)


def test_weight_search_finds_the_informative_part(points, spark):
    rng = np.random.default_rng(3)
    labels = np.repeat([0, 1, -1], [15, 15, 3])
    a = rng.normal(size=(33, 3))
    b = np.where(labels[:, None] == 0, [[5.0, 0, 0]], [[0, 5.0, 0]]) + rng.normal(0, 0.1, (33, 3))
    df = points(np.hstack([a, b]), labels).select(
        "id", "cluster_id", F.slice("v", 1, 3).alias("a"), F.slice("v", 4, 3).alias("b")
    )
    assert fusion.best_weights(df, ["a", "b"]) == [0.0, 1.0]
    assert fusion.best_weights(df, ["a"]) == [1.0]


def test_pca_components_are_orthonormal_and_ordered(points):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 5)) * np.array([5, 3, 1, 0.5, 0.1])
    reduced, model = represent.reduce_pca(points(x), 3)
    pc = model.pc.toArray()
    assert np.allclose(pc.T @ pc, np.eye(3), atol=1e-8)
    var = np.var(np.array([r.v for r in reduced.collect()]), axis=0)
    assert var[0] > var[1] > var[2]


def test_projection_rejects_bad_sizes(points):
    with pytest.raises(ValueError):
        represent.random_projection(points([[1.0, 2.0]]), 2, 2)
