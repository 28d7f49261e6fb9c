"""Connected components of an edge table by alternating star contractions.

Every round is two joins and two grouped minima over the edges. Rounds are written to the
shared folder, so lineage stays short and a lost executor costs a re-read. A node with very
many neighbours is a hot join key on one side only, which adaptive execution splits; its
minimum is pre-aggregated before the shuffle. A round's table is deleted once the next is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.scratch import cut, drop


def _towards_minimum(directed: DataFrame) -> DataFrame:
    """For each node u of (u, v): link its neighbours and itself to the least of them."""
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return directed.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _towards_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    joined = _towards_minimum(edges)
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = joined.select("u", F.col("m").alias("v"))
    return moved.unionAll(kept).where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node reachable.

    Loops, repeated edges and nulls in ``edges`` are ignored. An empty table gives an empty result.
    """
    current = cut(
        edges.where(f"{a} <> {b}")
        .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .distinct(),
        "edges",
    )
    seen = _digest(current)
    while seen[0]:
        before, current = current, cut(_small_star(_large_star(current)), "edges")
        drop(before)
        now = _digest(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("g"),
    ).first()
    return row["n"], row["h"], row["g"]
