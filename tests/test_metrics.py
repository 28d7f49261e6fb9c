import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelloom.operators import calls, metrics, provenance, selftrain


def labels(spark, a, b=None):
    rows = list(zip(range(len(a)), a, b or a))
    return spark.createDataFrame(rows, "id long, cluster_id int, other int")


def test_noise_ratio_and_distribution(spark):
    assert metrics.noise_ratio(labels(spark, [0, 1, -1, 0, -1, 2])).first().noise_ratio == pytest.approx(1 / 3)
    assert metrics.noise_ratio(labels(spark, [0]).where("false")).first().noise_ratio == 0
    got = {r.cluster_id: r.n for r in metrics.cluster_distribution(labels(spark, [0, 1, 0, 2, 1, 0])).collect()}
    assert got == {0: 3, 1: 2, 2: 1}


def test_rand_and_mutual_information(spark):
    same = labels(spark, [0, 0, 1, 1, 2, 2], [5, 5, 3, 3, 4, 4])
    assert metrics.adjusted_rand(same, "cluster_id", "other").first()[0] == pytest.approx(1.0)
    assert metrics.nmi(same, "cluster_id", "other").first()[0] == pytest.approx(1.0)
    noise = labels(spark, [-1, -1, -1])
    assert metrics.adjusted_rand(noise, "cluster_id", "other").first()[0] == 0
    assert metrics.nmi(noise, "cluster_id", "other").first()[0] == 0
    mixed = labels(spark, [0, 0, 1, 1, 2, 2], [0, 0, 1, 1, 1, 2])
    assert metrics.adjusted_rand(mixed, "cluster_id", "other").first()[0] == pytest.approx(0.4444444, abs=1e-6)


def test_score_stats(spark):
    ones = spark.createDataFrame([(1.0,)] * 3, "s double")
    row = metrics.score_stats(ones, "s").first()
    assert (row.mean, row.std, row.median) == (1.0, 0.0, 1.0)
    assert metrics.score_stats(ones.where("false"), "s").first().mean == 0


@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60), st.floats(0, 1))
@settings(max_examples=8, deadline=None)
def test_narrowing_quantile_is_exact(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values + values[:1] * 20], "x double")
    want = float(np.quantile(np.array(values + values[:1] * 20), q))
    assert metrics.quantile(df, "x", q, builtin_rows=0) == pytest.approx(want, rel=1e-9, abs=1e-9)
    assert metrics.quantile(df, "x", q) == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_flip_rate(spark):
    a, b = labels(spark, [0, 1, 2, 0, 1]), labels(spark, [0, 1, 2, 1, 1])
    assert selftrain.require_flip_rate(a, b) == pytest.approx(0.2)
    assert selftrain.require_flip_rate(a, a) == 0
    with pytest.raises(ValueError):
        selftrain.require_flip_rate(a, labels(spark, [0, 1]))


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(0, 0.0, 3, 0.5)], False), ([(0, 0.5, 3, 0.5), (1, 0.001, 3, 0.5)], True),
        ([(0, 0.5, 3, 0.5), (1, 0.5, 3, 0.5)], False), ([(0, 0.5, 3, 0.5), (1, 0.001, 4, 0.5)], False),
        ([(0, 0.5, 3, 0.5), (1, 0.001, 3, 0.4)], False),
    ],
)
def test_convergence(spark, rows, want):
    history = spark.createDataFrame(rows, "iteration int, flip_rate double, n_clusters int, silhouette double")
    assert selftrain.convergence(history).orderBy(F.desc("iteration")).first().converged is want


def test_curriculum_is_stricter_later_and_falls_back(spark):
    df = spark.createDataFrame([(i, i % 5 - 1, i / 100) for i in range(100)], "id long, cluster_id int, confidence double")
    first, low = selftrain.curriculum(df, 0)
    later, high = selftrain.curriculum(df, 3)
    assert first.count() == 80 and later.count() < 80 and high > low
    assert selftrain.curriculum(df.where("id < 14"), 9)[0].count() == df.where("id < 14 and cluster_id >= 0").count()
    weights = [r.weight for r in selftrain.curriculum_weights(later).collect()]
    assert min(weights) == pytest.approx(0.1) and max(weights) == pytest.approx(1.0)
    assert {r.weight for r in selftrain.curriculum_weights(df.withColumn("confidence", F.lit(0.5))).collect()} == {1.0}


def test_replication_rounds_half_to_even(spark):
    df = spark.createDataFrame([(w,) for w in (0.1, 0.5, 5 / 6, 1.0)], "weight double")
    got = [r.n for r in df.select(selftrain.copies(F.col("weight")).alias("n")).collect()]
    assert got == [1, 2, 2, 3]


def test_training_refines_every_row(points, blobs):
    x, truth = blobs
    df = points(x, truth).withColumn("confidence", F.lit(0.9))
    refined = {r.id: r.refined for r in selftrain.train_and_refine(df, 0, 4, iterations=60).collect()}
    assert len(refined) == 125
    assert np.mean([refined[i] == truth[i] for i in range(120)]) > 0.95
    with pytest.raises(ValueError):
        selftrain.train_classifier(df.where("id < 5"), 4)
    moved = {r.id: r.refined for r in selftrain.centroid_refine(df, 0).collect()}
    assert all(moved[i] == truth[i] for i in range(120))


def test_purity_skips_zero_vectors(points):
    df = points([[1.0, 0], [1.0, 0], [0.0, 0], [1.0, 1.0], [3.0, 1.0]], [0, 0, 1, 1, 2])
    assert metrics.purity(df).first().purity == pytest.approx(1.0)


def test_calls(spark):
    log = spark.createDataFrame(
        [
            (0, 1, "a", 0, False, 100.0, "", "down"), (1, 1, "b", 1, True, 200.0, "yes", ""),
            (2, 1, "c", 2, True, 50.0, "late", ""), (3, 2, "a", 0, False, 10.0, "", "down"),
            (4, 2, "b", 1, False, 10.0, "", "slow"),
        ],
        "call_id long, request long, provider string, priority long, ok boolean, latency_ms double, text string, error string",
    )
    got = {r.request: r for r in calls.first_success(log).collect()}
    assert (got[1].provider, got[1].answer, got[1].errors) == ("b", "yes", None)
    assert (got[2].provider, got[2].errors) == (None, "a: down; b: slow")
    made = calls.attempts(log)
    assert sorted(r.call_id for r in made.collect()) == [0, 1, 3, 4]
    stats = {r.provider: r for r in calls.provider_stats(made).collect()}
    assert (stats["b"].successes, stats["b"].failures, stats["b"].avg_ms) == (1, 1, 200.0)
    known = spark.createDataFrame([("a",), ("b",), ("z",)], "provider string")
    ranks = [r.provider for r in calls.ucb_rank(made, providers=known).orderBy("rank").collect()]
    assert ranks[0] == "z"
    assert calls.arm_stats(made, providers=known).where("provider = 'z'").first().avg_cost_ms == float("inf")


def test_running_bound_does_not_depend_on_the_ranges(spark):
    rows = [(i, "ab"[i * i % 3 % 2], i % 4 > 0, float(i)) for i in range(60)]
    log = spark.createDataFrame(rows, "call_id long, provider string, ok boolean, latency_ms double")
    small = calls.ucb_running(log, bucket_rows=7).orderBy("call_id").collect()
    large = calls.ucb_running(log).orderBy("call_id").collect()
    assert [(r.pulls, r.total) for r in small] == [(r.pulls, r.total) for r in large]
    assert [r.score for r in small[5:]] == pytest.approx([r.score for r in large[5:]])


def test_provenance(spark):
    history = spark.createDataFrame(
        [(0, 1, "sports", "p1", 0.7), (1, 1, "athletics", "p2", 0.8), (0, 2, "news", "p1", 0.6), (1, 2, "news", "p1", 0.6)],
        "iteration int, cluster_id int, label string, provider string, confidence double",
    )
    changes = provenance.label_history(history).collect()
    assert len(changes) == 1 and changes[0].iteration_history[0].new_label == "athletics"
    explained = provenance.with_explanations(
        history, spark.createDataFrame([(1, "because")], "cluster_id int, explanation string")
    )
    row = provenance.report(explained).first()
    assert (row.total_labels_generated, row.total_labels_explained) == (2, 1)
    assert row.avg_confidence == pytest.approx(0.7)
    assert {r.provider: r.n for r in provenance.provider_usage(history).collect()} == {"p1": 3, "p2": 1}
