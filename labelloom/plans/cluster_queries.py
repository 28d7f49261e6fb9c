"""Queries over clustering, neighbours, silhouettes and centroids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from labelloom.functions.vectors import centroids
from labelloom.operators import cluster, crosscheck, density, lloyd, naming, neighbors, silhouette, spectral
from labelloom.plans.registry import (
    CENT_SQL, E_NOISE_SQL, E_SQL, documents, query, r6, table, vectors,
)
from labelloom.scratch import cut

# Shared SQL: silhouettes s(id, cluster_id, s) of the non-noise rows of e.
SIL_SQL = """m AS (SELECT id, cluster_id, v FROM e WHERE cluster_id >= 0),
gaps AS (SELECT p.id, p.cluster_id AS own, q.cluster_id AS other, avg(list_distance(p.v, q.v)) AS g
         FROM m p JOIN m q ON p.id <> q.id GROUP BY ALL),
ab AS (SELECT id, own, max(g) FILTER (WHERE own = other) AS a, min(g) FILTER (WHERE own <> other) AS b
       FROM gaps GROUP BY ALL),
s AS (SELECT id, own AS cluster_id, CASE WHEN a IS NULL THEN 0e0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"""

# Shared SQL: nn(id, nbr, d, r) of the {k} nearest others, ties to the smaller id.
NN_SQL = """nn AS MATERIALIZED (SELECT id, nbr, d, r FROM (
  SELECT p.id, q.id AS nbr, list_distance(p.v, q.v) AS d,
         row_number() OVER (PARTITION BY p.id ORDER BY list_distance(p.v, q.v), q.id) AS r
  FROM e p JOIN e q ON p.id <> q.id) WHERE r <= {k})"""


def points(spark, sf):
    return cut(vectors(spark, sf), "points")


@query("estimate_k", """
SELECT count(*) AS n, greatest(2, least(floor(sqrt(count(*) / 2e0)), least(20, count(*) // 10)))::BIGINT AS k
FROM documents""")
def estimate_k(spark, sf):
    n = table(spark, sf, "documents").count()
    return spark.createDataFrame([(n, cluster.estimate_k(n, 10))], "n bigint, k bigint")


#: Passes of the SQL side, enough to come to rest; the Spark side stops by itself.
REST = 100


def means_sql(name: str, points: str, start: str, steps: int = REST) -> str:
    """{name}(g, k, id, v, c): grouped k-means of points(g, id, v) from start(g, k, c, m) after ``steps`` passes."""
    near = "arg_min(r.c, (list_distance(p.v, r.m), r.c))"
    return f"""{name}_cent(step, g, k, c, m) AS (
  SELECT 0, g, k, c, m FROM {start}
  UNION ALL
  SELECT step + 1, g, k, c, list(x ORDER BY d) FROM (
    SELECT step, g, k, c, d, avg(x) AS x FROM (
      SELECT step, g, k, c, generate_subscripts(v, 1) AS d, unnest(v) AS x FROM (
        SELECT r.step, p.g, r.k, p.id, any_value(p.v) AS v, {near} AS c FROM {points} p JOIN {name}_cent r ON r.g = p.g WHERE r.step < {steps}
        GROUP BY r.step, p.g, r.k, p.id))
    GROUP BY ALL) GROUP BY step, g, k, c),
{name} AS MATERIALIZED (
  SELECT p.g, r.k, p.id, any_value(p.v) AS v, {near} AS c FROM {points} p JOIN {name}_cent r ON r.g = p.g WHERE r.step = {steps} GROUP BY p.g, r.k, p.id)"""


def lloyd_sql(k: int) -> str:
    """k-means at rest, from the k lowest distinct vectors: table assigned(id, v, c)."""
    return f"""one AS MATERIALIZED (SELECT 0 AS g, id, v FROM e),
lowest AS (SELECT 0 AS g, {k} AS k, row_number() OVER (ORDER BY id) - 1 AS c, v AS m FROM (
  SELECT min(id) AS id, v FROM e GROUP BY v ORDER BY 1 LIMIT {k})),
{means_sql("assigned", "one", "lowest")}"""


@query("kmeans_lloyd", f"""
WITH RECURSIVE {E_SQL}, {lloyd_sql(4)} SELECT id, c::BIGINT AS cluster_id FROM assigned""")
def kmeans_lloyd(spark, sf):
    pts = points(spark, sf).select(F.lit(0).cast("bigint").alias("grp"), "id", "v")
    starts = lloyd.first_starts(pts, 4)
    models = lloyd.lloyd(pts, [lloyd.Model(0, 4, 0, starts[0])])
    return lloyd.assign(pts, models).select("id", F.get("labs", F.lit(0)).cast("bigint").alias("cluster_id"))


@query("kmeans_ml")
def kmeans_ml(spark, sf):
    return cluster.kmeans_ml(points(spark, sf), 5)


@query("kmeans_restarts")
def kmeans_restarts(spark, sf):
    return cluster.kmeans(points(spark, sf), 5)


@query("kmeans_restarts_check", "SELECT count(*) AS n, 5::BIGINT AS clusters, 0::BIGINT AS misplaced FROM embeddings")
def kmeans_restarts_check(spark, sf):
    """Rows that lie nearer to the mean of another cluster than to their own: none, at rest."""
    pts = points(spark, sf).select("id", "v")
    found = cut(pts.join(cluster.kmeans(pts, 5), "id"), "found")
    near = cluster.assign_nearest(found.select("id", "v", "cluster_id"), centroids(found, "cluster_id"))
    return near.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cluster_id").alias("clusters"), F.count_if(F.col("nearest") != F.col("cluster_id")).alias("misplaced"),
    )


@query("assign_nearest", f"""
WITH {E_SQL}, {CENT_SQL}
SELECT id, arg_min(cent.cluster_id, (list_distance(v, c), cent.cluster_id))::BIGINT AS nearest,
       round(min(list_distance(v, c)), 6) + 0e0 AS distance
FROM e CROSS JOIN cent GROUP BY id""")
def assign_nearest(spark, sf):
    pts = points(spark, sf)
    return cluster.assign_nearest(pts.select("id", "v"), centroids(pts, "cluster_id")).select(
        "id", F.col("nearest").cast("bigint").alias("nearest"), r6("distance").alias("distance")
    )


@query("core_distance", f"""
WITH {E_SQL}, {NN_SQL.format(k=4)} SELECT id, round(max(d), 6) + 0e0 AS core FROM nn GROUP BY id""")
def core_distance(spark, sf):
    return neighbors.core_distance(points(spark, sf), 5).select("id", r6("core").alias("core"))


@query("mutual_reachability", f"""
WITH {E_SQL}, {NN_SQL.format(k=4)}, core AS (SELECT id, max(d) AS core FROM nn GROUP BY id)
SELECT nn.id, nn.nbr, round(nn.d, 6) + 0e0 AS distance,
       round(greatest(nn.d, a.core, b.core), 6) + 0e0 AS reach
FROM nn JOIN core a ON a.id = nn.id JOIN core b ON b.id = nn.nbr""")
def mutual_reachability(spark, sf):
    pts = points(spark, sf)
    edges = cut(neighbors.knn(pts, 4), "edges")
    cores = neighbors.core_distance(pts, 5, edges)
    return neighbors.mutual_reachability(edges, cores).select(
        "id", "nbr", r6("distance").alias("distance"), r6("reach").alias("reach")
    )


# Prim's algorithm over all pairs: ``done`` marks the rows that the tree holds.
MST_SQL = """core AS (SELECT id, max(d) AS core FROM nn GROUP BY id),
place AS MATERIALIZED (SELECT e.id, core, v, row_number() OVER (ORDER BY e.id) AS i FROM e JOIN core USING (id)),
reach AS MATERIALIZED (
  SELECT a.i AS i, b.i AS j, greatest(list_distance(a.v, b.v), a.core, b.core) AS w FROM place a JOIN place b ON a.i <> b.i),
tree(n, total, done) AS (
  SELECT 1, 0e0, list_transform(range(1, (SELECT count(*) FROM e) + 1), lambda i: i = 1)
  UNION ALL
  SELECT n + 1, total + x.w, list_transform(done, lambda d, i: d OR i = x.j)
  FROM tree, LATERAL (SELECT min({'w': w, 'j': j}) AS p FROM reach WHERE done[i] AND NOT done[j]) q, LATERAL (SELECT q.p.w AS w, q.p.j AS j) x
  WHERE n < (SELECT count(*) FROM e))"""


@query("mst_edges", f"""
WITH RECURSIVE {E_SQL}, {NN_SQL.format(k=4)}, {MST_SQL}
SELECT max(n) - 1 AS edges, round(max(total), 6) + 0e0 AS weight FROM tree""")
def mst_edges(spark, sf):
    tree = density.tree_edges(points(spark, sf), 5)
    return tree.agg(F.count(F.lit(1)).alias("edges"), r6(F.sum("w")).alias("weight"))


@query("knn_graph", f"""
WITH {E_SQL}, {NN_SQL.format(k=9)}
SELECT least(id, nbr) AS src, greatest(id, nbr) AS dst, count(*) * 5e-1 AS weight FROM nn GROUP BY ALL""")
def knn_graph(spark, sf):
    return cluster.knn_graph(points(spark, sf), 10)


@query("graph_cluster")
def graph_cluster(spark, sf):
    return cluster.graph_cluster(points(spark, sf), 5)


@query("graph_embedding_check", f"""
WITH {E_SQL}, {NN_SQL.format(k=9)},
g AS (SELECT least(id, nbr) AS src, greatest(id, nbr) AS dst, count(*) * 5e-1 AS weight FROM nn GROUP BY ALL)
SELECT 5::BIGINT AS vectors, (SELECT count(*) FROM e) AS nodes, count(*) AS edges, sum(weight) + 0e0 AS weight, true AS orthonormal, true AS settled FROM g""")
def graph_embedding_check(spark, sf):
    """Orthonormal to 1e-8 and A v = lambda v to the tolerance, recomputed entry by entry over the edge table."""
    graph = cut(cluster.knn_graph(points(spark, sf), 10), "graph")
    edges = cut(spectral.normalised(graph), "affinity")
    found, values, _ = spectral.leading(edges, 5, 1e-6)
    entries = cut(found.select("id", F.posexplode("v").alias("j", "x")), "entries")
    other = entries.select("id", F.col("j").alias("i"), F.col("x").alias("y"))
    gram = entries.join(other, "id").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("g"))
    off = gram.agg(F.max(F.abs(F.col("g") - (F.col("i") == F.col("j")).cast("double"))).alias("off"))
    scale = spark.createDataFrame([(j, float(v)) for j, v in enumerate(values)], "j int, value double")
    image = edges.join(entries.withColumnRenamed("id", "nbr"), "nbr").groupBy("id", "j").agg(F.sum(F.col("w") * F.col("x")).alias("ax"))
    gap = entries.join(image, ["id", "j"]).join(F.broadcast(scale), "j").withColumn("gap", F.col("ax") - F.col("value") * F.col("x"))
    worst = gap.groupBy("j").agg(F.sqrt(F.sum(F.col("gap") * F.col("gap"))).alias("r")).agg(F.max("r").alias("worst"), F.count(F.lit(1)).alias("vectors"))
    size = graph.agg(F.count(F.lit(1)).alias("edges"), F.sum("weight").alias("weight"))
    return worst.crossJoin(off).crossJoin(size).crossJoin(found.agg(F.count(F.lit(1)).alias("nodes"))).select(
        "vectors", "nodes", "edges", "weight", (F.col("off") <= 1e-8).alias("orthonormal"), (F.col("worst") <= 1e-5).alias("settled"),
    )


@query("auto_select", """
SELECT user_id AS try_order, round(max(value) / 500, 1) AS silhouette FROM events GROUP BY user_id
ORDER BY silhouette DESC, try_order LIMIT 1""")
def auto_select(spark, sf):
    candidates = table(spark, sf, "events").groupBy(F.col("user_id").alias("try_order")).agg(
        F.round(F.max("value") / 500, 1).alias("silhouette")
    )
    return cluster.select_best(candidates)


@query("silhouette_exact", f"""
WITH {E_NOISE_SQL}, {SIL_SQL} SELECT round(avg(s), 6) + 0e0 AS silhouette FROM s""")
def silhouette_exact(spark, sf):
    return silhouette.silhouette(vectors(spark, sf, noise=True)).select(r6("silhouette").alias("silhouette"))


@query("silhouette_per_cluster", f"""
WITH {E_NOISE_SQL}, {SIL_SQL}
SELECT cluster_id::BIGINT AS cluster_id, count(*) AS n, round(avg(s), 6) + 0e0 AS silhouette FROM s GROUP BY 1""")
def silhouette_per_cluster(spark, sf):
    return silhouette.silhouette_per_cluster(vectors(spark, sf, noise=True)).select(
        "cluster_id", "n", r6("silhouette").alias("silhouette")
    )


@query("silhouette_squared", f"""
WITH {E_NOISE_SQL}, {SIL_SQL.replace("avg(list_distance(p.v, q.v))", "avg(list_distance(p.v, q.v) ** 2)")}
SELECT round(avg(s), 6) + 0e0 AS silhouette FROM s""")
def silhouette_squared(spark, sf):
    value = silhouette.silhouette_squared(vectors(spark, sf, noise=True))
    return spark.createDataFrame([(value,)], "silhouette double").select(r6("silhouette").alias("silhouette"))


@query("cluster_metrics", f"""
WITH {E_NOISE_SQL}, {SIL_SQL}
SELECT count(*) AS n_samples, count(DISTINCT cluster_id) FILTER (WHERE cluster_id >= 0) AS n_clusters,
       count(*) FILTER (WHERE cluster_id = -1) AS n_noise,
       round(avg((cluster_id = -1)::INT), 6) + 0e0 AS noise_ratio,
       (SELECT round(avg(s), 6) + 0e0 FROM s) AS silhouette FROM e""")
def cluster_metrics(spark, sf):
    found = cluster.cluster_metrics(cut(vectors(spark, sf, noise=True), "points"))
    return found.select(
        "n_samples", "n_clusters", "n_noise", r6("noise_ratio").alias("noise_ratio"),
        r6("silhouette").alias("silhouette"),
    )


@query("cluster_sizes", "SELECT substr(source, 4)::INT AS cluster_id, count(*) AS n FROM documents GROUP BY 1")
def cluster_sizes(spark, sf):
    return naming.cluster_sizes(documents(spark, sf))


@query("cluster_centroids", f"""
WITH {E_NOISE_SQL}, {CENT_SQL}
SELECT cluster_id, (dim - 1)::BIGINT AS dim, round(x, 6) + 0e0 AS value, n FROM cent_long WHERE cluster_id >= 0""")
def cluster_centroids(spark, sf):
    found = centroids(vectors(spark, sf, noise=True).where("cluster_id >= 0"), "cluster_id")
    return found.select("cluster_id", "n", F.posexplode("centroid").alias("dim", "value")).select(
        "cluster_id", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value"), "n"
    )


@query("centroid_distance", f"""
WITH {E_NOISE_SQL}, {CENT_SQL}
SELECT id, cluster_id, round(list_distance(v, c), 6) + 0e0 AS distance FROM e JOIN cent USING (cluster_id)""")
def centroid_distance(spark, sf):
    return naming.centroid_distances(vectors(spark, sf, noise=True)).select(
        "id", "cluster_id", r6("distance").alias("distance")
    )


@query("centroid_pairs", f"""
WITH {E_NOISE_SQL}, {CENT_SQL}
SELECT a.cluster_id::BIGINT AS cluster_a, b.cluster_id::BIGINT AS cluster_b,
       round(list_cosine_similarity(a.c, b.c), 6) + 0e0 AS cosine, round(list_distance(a.c, b.c), 6) + 0e0 AS distance
FROM cent a JOIN cent b ON a.cluster_id < b.cluster_id WHERE a.cluster_id >= 0""")
def centroid_pairs(spark, sf):
    centres = crosscheck.real_centroids(vectors(spark, sf, noise=True))
    return crosscheck.centroid_pairs(centres).select(
        "cluster_a", "cluster_b", r6("cosine").alias("cosine"), r6("distance").alias("distance")
    )
