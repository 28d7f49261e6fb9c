"""Queries against their SQL counterparts on the smallest tables."""

import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["events", "documents", "embeddings", "benchmark", "labels", "conversations"]
NAMES = [
    "src_json", "dedup_exact", "embed_hashed_tf", "fuse_embeddings", "assign_nearest", "silhouette_per_cluster",
    "representatives_topk", "clean_response", "top_token_label", "first_success", "ucb_running", "lof_scores",
    "near_dup_pairs", "cluster_coherence", "merge_candidates", "curriculum_weights", "drift_health", "adjusted_rand",
    "kmeans_lloyd", "kmeans_restarts_check", "mst_edges", "graph_embedding_check", "split_candidates", "taxonomy_nodes",
    "cluster_prompts", "provenance_records", "src_csv",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.fixture(scope="module")
def db():
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(rows):
    def value(x):
        if x is None or x != x:
            return "null"
        return f"{x:.6f}" if isinstance(x, float) else str(x)

    return sorted(tuple(value(x) for x in row) for row in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    import __spark_entry__ as entry

    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    rows = plain(got.select(*columns).collect())
    assert rows == plain(want) and rows
