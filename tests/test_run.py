import os

import pytest
from pyspark.sql import functions as F

from labelloom import scratch
from labelloom.operators.represent import hashed_vector
from labelloom.plans import full_run
from labelloom.sources.readers import content_hash

TOPICS = ["fish ocean dolphin species", "recipe flour sugar butter", "market stock revenue profit"]


@pytest.fixture(scope="module")
def items(spark):
    rows = [(i, f"{TOPICS[i % 3]} {'abcdefgh'[i % 8] * 4} {TOPICS[i % 3]}") for i in range(60)]
    df = spark.createDataFrame(rows, "pos long, content string")
    return df.select(
        "pos", F.col("pos").cast("string").alias("id"), "content", F.lit("text").alias("modality"),
        F.lit("t").alias("source"), content_hash(F.col("content")).alias("content_hash"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
    )


def test_full_run_labels_topics_and_exports(spark, items, tmp_path):
    def namer(prompts):
        return prompts.select("cluster_id", F.lit("p").alias("provider"), F.lit("Category: unknown").alias("raw"))

    settings = full_run.Settings(
        encoder=lambda c: hashed_vector(c, 32), method="kmeans", n_clusters=3, restarts=2, max_iterations=2,
        kmeans_iterations=20, training_iterations=15, namer=namer, taxonomy=True, min_cluster_size=5,
    )
    result = full_run.run(items, settings)
    rows = result.labeled.collect()
    assert len(rows) == items.select("content").distinct().count()
    assert {r.label for r in rows} == {"marine species", "cooking instructions", "business performance"}
    assert all(0 <= r.quality_score <= 1 for r in rows)
    assert result.metrics.count() == len(rows and result.drift.collect())
    assert result.totals["rows"] == len(rows) and result.totals["rows_per_second"] > 0 and not result.training_errors
    out = str(tmp_path / "out")
    full_run.export(result, out, "json")
    for name in ("dataset", "metadata", "drift_history", "provenance_report", "taxonomy", "validation_flags"):
        assert os.path.isdir(f"{out}/{name}.json")
    assert spark.read.json(f"{out}/provenance_records.json").count() == 3


def test_run_needs_items(items):
    with pytest.raises(ValueError):
        full_run.run(items.where("false"))


def test_written_tables_go_to_the_shared_folder(spark):
    assert scratch.shared_dir(spark).startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_entry_and_oracles_cover_the_queries(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_a_rolled_back_run_keeps_the_rows_of_the_iteration_before(items, monkeypatch):
    from labelloom.operators import drift

    plain = drift.report
    monkeypatch.setattr(drift, "report", lambda *a, **b: plain(*a, **b).withColumn("rollback", F.col("iteration") == 1))
    settings = full_run.Settings(
        encoder=lambda c: hashed_vector(c, 32), method="kmeans", n_clusters=3, restarts=1, max_iterations=3, kmeans_iterations=5,
        training_iterations=5, weighted_training=False, min_cluster_size=5, validate=False, convergence_threshold=-1.0,
    )
    result = full_run.run(items, settings)
    assert result.rolled_back
    assert {r.iteration for r in result.labeled.select("iteration").distinct().collect()} == {0}
