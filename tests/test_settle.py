"""Small tables that joins send to the tasks."""

from labelloom.operators import naming
from labelloom.scratch import settle


def test_small_tables_keep_the_large_side_in_place(spark):
    """Joining a settled table by a key with one hot value must not deal the rows by that key."""
    rows = spark.range(1000).selectExpr("cast(id % 2 as int) as cluster_id", "id", "array(cast(id as double)) as v", "cast(id as string) as content")
    near = naming.centroid_distances(rows, ["content"])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    settled = settle(spark.createDataFrame([(1, ["a"], {"k": 1.0})], "x int, t array<string>, m map<string, double>"))
    assert settled.first().asDict() == {"x": 1, "t": ["a"], "m": {"k": 1.0}}
