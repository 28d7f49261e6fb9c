"""Queries over quality, cross-checks, self-training, drift, the label tree and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.operators import (
    cluster, crosscheck, drift, isolation, metrics, naming, neighbors, quality, selftrain, taxonomy,
)
from labelloom.operators.represent import hashed_vector
from labelloom.plans.cluster_queries import NN_SQL, means_sql
from labelloom.plans.label_queries import _KW_SQL, _KWL_SQL, _LABELS_SQL, _TOKL_SQL, _business, _BUSINESS_SQL, words_sql
from labelloom.plans.registry import (
    CENT_SQL, D_SQL, E_NOISE_SQL, E_SQL, docvec_sql, documents, query, r6, spread, table, vectors,
)
from labelloom.scratch import cut, new_path
from labelloom.sources import sinks


def points(spark, sf, noise=False):
    return cut(vectors(spark, sf, noise), "points")


LOF_SQL = NN_SQL.format(k=20) + """,
kd AS (SELECT id, max(d) AS kd FROM nn GROUP BY id),
lrd AS (SELECT nn.id, 1e0 / (avg(greatest(nn.d, kd.kd)) + 1e-10) AS lrd FROM nn JOIN kd ON kd.id = nn.nbr GROUP BY nn.id),
lof AS (SELECT nn.id, avg(b.lrd) / any_value(a.lrd) AS lof
        FROM nn JOIN lrd a ON a.id = nn.id JOIN lrd b ON b.id = nn.nbr GROUP BY nn.id),
lofflag AS (SELECT id, lof, -lof < (SELECT quantile_cont(-lof, 1e-1) FROM lof) AS flag FROM lof)"""

DIST_SQL = CENT_SQL + """,
dist AS (SELECT id, cluster_id, list_distance(v, c) AS distance FROM e JOIN cent USING (cluster_id)),
distflag AS (SELECT id, -distance < (SELECT quantile_cont(-distance, 1e-1) FROM dist) AS flag FROM dist)"""

DUP = 0.35
QUALITY_SQL = f"""{LOF_SQL}, {DIST_SQL},
dup AS (SELECT DISTINCT q.id FROM e p JOIN e q ON p.id < q.id WHERE list_cosine_similarity(p.v, q.v) >= {DUP}::DOUBLE),
coh AS (SELECT cluster_id, CASE WHEN count(*) < 2 THEN 1e0 ELSE exp(-avg(distance)) END AS coherence, count(*) AS n FROM dist GROUP BY 1),
q AS (SELECT e.id, e.cluster_id, lofflag.flag AS anomaly_flag, dup.id IS NOT NULL AS duplicate_flag,
        4e-1 * (1 - lofflag.flag::INT) + 3e-1 * (dup.id IS NULL)::INT + 3e-1 * coherence AS quality_score
      FROM e JOIN lofflag USING (id) JOIN coh USING (cluster_id) LEFT JOIN dup ON dup.id = e.id)"""


@query("isolation_forest")
def isolation_forest(spark, sf):
    return quality.isolation_flags(points(spark, sf))


@query("isolation_forest_check", """
SELECT count(*) AS n, (count(*) - floor(9e-1 * (count(*) - 1)) - 1)::BIGINT AS n_flagged, count(DISTINCT vec_id) AS n_ids FROM embeddings""")
def isolation_forest_check(spark, sf):
    """Every row once, and the tenth above the 90 % quantile flagged."""
    return quality.isolation_flags(points(spark, sf)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("flag").alias("n_flagged"), F.count_distinct("id").alias("n_ids")
    )


@query("lof_scores", f"WITH {E_SQL}, {LOF_SQL} SELECT id, round(lof, 6) + 0e0 AS lof FROM lof")
def lof_scores(spark, sf):
    return neighbors.lof(points(spark, sf)).select("id", r6("lof").alias("lof"))


@query("lof_flags", f"WITH {E_SQL}, {LOF_SQL} SELECT id, flag FROM lofflag")
def lof_flags(spark, sf):
    return quality.lof_flags(points(spark, sf)).select("id", "flag")


@query("anomaly_ensemble", f"""
WITH {E_SQL}, {LOF_SQL}, {DIST_SQL}
SELECT a.id, (a.flag::INT + b.flag::INT) / 2e0 AS anomaly_score, a.flag AND b.flag AS anomaly_flag
FROM lofflag a JOIN distflag b USING (id)""")
def anomaly_ensemble(spark, sf):
    pts = points(spark, sf)
    far = isolation.flag_top(cut(naming.centroid_distances(pts), "far"), "distance", 0.1)
    return quality.ensemble(quality.lof_flags(pts), far)


def document_vectors(spark, sf, dims=256):
    docs = spread(table(spark, sf, "documents"))
    return cut(docs.select(F.col("doc_id").alias("id"), hashed_vector(F.col("text"), dims).alias("v")), "docvec")


# Pairs are only formed between documents whose vectors differ; equal ones match the first of them.
_MATCH_SQL = f"""{docvec_sql()},
u AS MATERIALIZED (SELECT min(id) AS id, v FROM dv GROUP BY v),
m AS (SELECT q.id, min(p.id) AS first_id FROM u p JOIN u q ON p.id < q.id
      WHERE list_inner_product(p.v, q.v) >= 95e-2 GROUP BY q.id),
f AS (SELECT dv.id, coalesce(m.first_id, u.id) AS first_id FROM dv JOIN u ON u.v = dv.v LEFT JOIN m ON m.id = u.id)"""


@query("near_dup_flags", f"""
WITH {_MATCH_SQL} SELECT doc_id AS id, coalesce(first_id < doc_id, false) AS duplicate_flag
FROM documents LEFT JOIN f ON f.id = doc_id""")
def near_dup_flags(spark, sf):
    return neighbors.near_duplicate_flags(document_vectors(spark, sf), 0.95)


@query("near_dup_pairs", f"WITH {_MATCH_SQL} SELECT id, first_id FROM f WHERE first_id < id")
def near_dup_pairs(spark, sf):
    return neighbors.earliest_matches(document_vectors(spark, sf), 0.95)


@query("cluster_coherence", f"""
WITH {E_NOISE_SQL}, {DIST_SQL}
SELECT cluster_id, CASE WHEN count(*) < 2 THEN 1e0 ELSE round(exp(-avg(distance)), 6) + 0e0 END AS coherence, count(*) AS n
FROM dist GROUP BY 1""")
def cluster_coherence(spark, sf):
    return quality.coherence(points(spark, sf, True)).select("cluster_id", r6("coherence").alias("coherence"), "n")


def scored(spark, sf):
    """Quality of the embeddings with the local outlier factor as the only anomaly method."""
    pts = points(spark, sf, True)
    anomalies = quality.lof_flags(pts).select(
        "id", F.col("flag").cast("double").alias("anomaly_score"), F.col("flag").alias("anomaly_flag")
    )
    duplicates = neighbors.near_duplicate_flags(pts.select("id", "v"), DUP)
    return quality.quality_scores(pts, anomalies, duplicates)


@query("quality_scores", f"""
WITH {E_NOISE_SQL}, {QUALITY_SQL}
SELECT id, cluster_id, round(quality_score, 6) + 0e0 AS quality_score, anomaly_flag, duplicate_flag FROM q""")
def quality_scores(spark, sf):
    return scored(spark, sf).select(
        "id", "cluster_id", r6("quality_score").alias("quality_score"), "anomaly_flag", "duplicate_flag"
    )


@query("quality_stats", f"""
WITH {E_NOISE_SQL}, {QUALITY_SQL}
SELECT round(avg(quality_score), 6) + 0e0 AS mean, round(stddev_pop(quality_score), 6) + 0e0 AS std,
  round(min(quality_score), 6) + 0e0 AS min, round(max(quality_score), 6) + 0e0 AS max,
  round(median(quality_score), 6) + 0e0 AS median FROM q""")
def quality_stats(spark, sf):
    stats = metrics.score_stats(cut(scored(spark, sf), "scored"), "quality_score")
    return stats.select(*[r6(c).alias(c) for c in ("mean", "std", "min", "max", "median")])


@query("quality_filter", f"""
WITH {E_NOISE_SQL}, {QUALITY_SQL} SELECT id, round(quality_score, 6) + 0e0 AS quality_score FROM q WHERE quality_score >= 7e-1""")
def quality_filter(spark, sf):
    return scored(spark, sf).where("quality_score >= 0.7D").select("id", r6("quality_score").alias("quality_score"))


# Cross-checks.  Labels of the clusters are made from their ids so that some collide.
_CLUSTER_LABELS_SQL = """cl AS (SELECT DISTINCT cluster_id, 'topic ' || chr((97 + cluster_id % 4)::INT) AS label FROM e WHERE cluster_id >= 0)"""
_COLLISION_SQL = f"""ln AS (SELECT cluster_id, lower(trim(label)) AS l, list_distinct({words_sql('lower(label)')}) AS w FROM @labels),
coll AS (SELECT a.cluster_id AS cluster_a, b.cluster_id AS cluster_b, CASE WHEN a.l = b.l THEN 1e0
   ELSE len(list_intersect(a.w, b.w))::DOUBLE / len(list_distinct(list_concat(a.w, b.w))) END AS similarity
  FROM ln a JOIN ln b ON a.cluster_id < b.cluster_id)"""


def split_sql(points: str = "pts", ks: tuple[int, ...] = (2,), name: str = "split") -> str:
    """{name}(g, k, id, v, c) and {name}_sil(g, k, s): grouped k-means at rest from the lowest id and successively farthest rows."""
    parts = [f"{name}_s0 AS MATERIALIZED (SELECT g, 0 AS c, arg_min(v, id) AS m FROM {points} GROUP BY g)"]
    for i in range(1, max(ks)):
        parts.append(
            f"""{name}_s{i} AS MATERIALIZED (SELECT * FROM {name}_s{i - 1} UNION ALL
  SELECT g, {i}, arg_max(v, (gap, -id)) FROM (
    SELECT p.g, p.id, any_value(p.v) AS v, min(list_distance(p.v, s.m)) AS gap FROM {points} p JOIN {name}_s{i - 1} s ON s.g = p.g GROUP BY p.g, p.id)
  GROUP BY g)"""
        )
    parts.append(f"{name}_start AS (SELECT g, k, c, m FROM {name}_s{max(ks) - 1}, (SELECT unnest({list(ks)}) AS k) WHERE c < k)")
    parts.append(means_sql(name, points, f"{name}_start"))
    parts.append(
        f"""{name}_gaps AS (SELECT p.g, p.k, p.id, p.c AS own, q.c AS other, avg(list_distance(p.v, q.v)) AS m
  FROM {name} p JOIN {name} q ON p.g = q.g AND p.k = q.k AND p.id <> q.id GROUP BY ALL),
{name}_ab AS (SELECT g, k, id, max(m) FILTER (WHERE own = other) AS a, min(m) FILTER (WHERE own <> other) AS b FROM {name}_gaps GROUP BY ALL),
{name}_sil AS (SELECT g, k, avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS s FROM {name}_ab GROUP BY g, k),
{name}_best AS (SELECT g, arg_max(k, (s, -k)) AS k, max(s) AS s FROM {name}_sil GROUP BY g)"""
    )
    return ",\n".join(parts)


_PTS_SQL = """pts AS MATERIALIZED (SELECT cluster_id AS g, id, v FROM e WHERE cluster_id >= 0 AND cluster_id IN
  (SELECT cluster_id FROM e GROUP BY 1 HAVING count(*) >= 10))"""
SPLIT_AT, MERGE_AT, SIZE_SHARE = 0.02, 0.05, 0.97


def cluster_labels(df):
    ids = df.where("cluster_id >= 0").select("cluster_id").distinct()
    return ids.withColumn("label", F.concat(F.lit("topic "), F.char(F.col("cluster_id") % 4 + 97)))


@query("label_collisions", f"""
WITH {_BUSINESS_SQL}, {_KW_SQL}, {_KWL_SQL}, {_TOKL_SQL}, {_LABELS_SQL}, {_COLLISION_SQL.replace('@labels', 'labels')}
SELECT cluster_a::BIGINT AS cluster_a, cluster_b::BIGINT AS cluster_b, round(similarity, 6) + 0e0 AS similarity FROM coll WHERE similarity >= 3e-1""")
def label_collisions(spark, sf):
    labels = naming.label_clusters(_business(documents(spark, sf)))
    return crosscheck.label_collisions(labels, 0.3).select(
        "cluster_a", "cluster_b", r6("similarity").alias("similarity")
    )


@query("merge_candidates", f"""
WITH {E_NOISE_SQL}, {CENT_SQL} SELECT a.cluster_id::BIGINT AS cluster_a, b.cluster_id::BIGINT AS cluster_b,
  round(list_cosine_similarity(a.c, b.c), 6) + 0e0 AS similarity FROM cent a JOIN cent b ON a.cluster_id < b.cluster_id
WHERE a.cluster_id >= 0 AND list_cosine_similarity(a.c, b.c) >= {MERGE_AT}::DOUBLE""")
def merge_candidates(spark, sf):
    centres = crosscheck.real_centroids(vectors(spark, sf, True))
    return crosscheck.merge_candidates(centres, MERGE_AT).select(
        "cluster_a", "cluster_b", r6("similarity").alias("similarity")
    )


@query("split_candidates", f"""
WITH RECURSIVE {E_NOISE_SQL}, {_PTS_SQL}, {split_sql()}
SELECT g::BIGINT AS cluster_id, round(s, 6) + 0e0 AS silhouette FROM split_sil WHERE s > {SPLIT_AT}::DOUBLE""")
def split_candidates(spark, sf):
    found = crosscheck.split_candidates(vectors(spark, sf, True), SPLIT_AT, starts="farthest")
    return found.select(F.col("cluster_a").alias("cluster_id"), r6("similarity").alias("silhouette"))


_OUTLIER_SQL = f"""means AS (SELECT a.cluster_id, a.n, avg(list_cosine_similarity(a.c, b.c)) AS mean_sim
  FROM cent a JOIN cent b ON a.cluster_id <> b.cluster_id WHERE a.cluster_id >= 0 AND b.cluster_id >= 0 GROUP BY ALL),
outl AS (SELECT cluster_id, n, mean_sim FROM means WHERE mean_sim < 3e-1
  AND n < {SIZE_SHARE}::DOUBLE * (SELECT median(n) FROM cent WHERE cluster_id >= 0))"""


@query("outlier_clusters", f"""
WITH {E_NOISE_SQL}, {CENT_SQL}, {_OUTLIER_SQL}
SELECT cluster_id::BIGINT AS cluster_id, round(mean_sim, 6) + 0e0 AS mean_sim FROM outl""")
def outlier_clusters(spark, sf):
    centres = crosscheck.real_centroids(vectors(spark, sf, True))
    return crosscheck.outlier_clusters(centres, 0.3, SIZE_SHARE).select(
        F.col("cluster_a").alias("cluster_id"), r6("similarity").alias("mean_sim")
    )


_FLAGS_SQL = f"""{CENT_SQL}, {_PTS_SQL}, {split_sql()}, {_CLUSTER_LABELS_SQL}, {_COLLISION_SQL.replace('@labels', 'cl')}, {_OUTLIER_SQL},
flags AS (
  SELECT 'label_collision' AS flag_type, cluster_a, cluster_b, similarity FROM coll WHERE similarity >= 8e-1
  UNION ALL SELECT 'merge_candidate', a.cluster_id, b.cluster_id, list_cosine_similarity(a.c, b.c)
    FROM cent a JOIN cent b ON a.cluster_id < b.cluster_id WHERE a.cluster_id >= 0 AND list_cosine_similarity(a.c, b.c) >= {MERGE_AT}::DOUBLE
  UNION ALL SELECT 'split_candidate', g, NULL, s FROM split_sil WHERE s > {SPLIT_AT}::DOUBLE
  UNION ALL SELECT 'outlier_cluster', cluster_id, NULL, mean_sim FROM outl)"""


def _flags(spark, sf):
    df = points(spark, sf, True)
    return crosscheck.validation_flags(
        df, cluster_labels(df), merge_threshold=MERGE_AT, split_threshold=SPLIT_AT, size_share=SIZE_SHARE,
        starts="farthest",
    )


@query("validation_flags", f"""
WITH RECURSIVE {E_NOISE_SQL}, {_FLAGS_SQL}
SELECT flag_type, cluster_a::BIGINT AS cluster_a, coalesce(cluster_b, -1)::BIGINT AS cluster_b, round(similarity, 6) + 0e0 AS similarity FROM flags""")
def validation_flags(spark, sf):
    return _flags(spark, sf).select("flag_type", "cluster_a", F.coalesce("cluster_b", F.lit(-1)).alias("cluster_b"), r6("similarity").alias("similarity"))


@query("consistency_score", f"""
WITH RECURSIVE {E_NOISE_SQL}, {_FLAGS_SQL}
SELECT count(*) AS n_flags, count(*) FILTER (WHERE flag_type = 'merge_candidate') AS n_merge_candidate,
  count(*) FILTER (WHERE flag_type = 'split_candidate') AS n_split_candidate,
  count(*) FILTER (WHERE flag_type = 'label_collision') AS n_label_collision,
  count(*) FILTER (WHERE flag_type = 'outlier_cluster') AS n_outlier_cluster,
  round(greatest(0e0, 1e0 - 2e-1 * count(*) / (SELECT count(DISTINCT cluster_id) FROM e)), 6) + 0e0 AS consistency FROM flags""")
def consistency_score(spark, sf):
    n = vectors(spark, sf, True).select("cluster_id").distinct().count()
    found = crosscheck.consistency(_flags(spark, sf), n)
    return found.withColumn("consistency", r6("consistency"))


# Self-training.
@query("flip_rate", """
SELECT count(*) AS n, 0::BIGINT AS n_unmatched, round(avg((quality <> toxic)::INT), 6) + 0e0 AS flip_rate FROM labels""")
def flip_rate(spark, sf):
    df = table(spark, sf, "labels")
    old = df.select(F.col("doc_id").alias("id"), F.col("quality").alias("cluster_id"))
    new = df.select(F.col("doc_id").alias("id"), F.col("toxic").alias("cluster_id"))
    return selftrain.flip_rate(old, new).withColumn("flip_rate", r6("flip_rate"))


@query("convergence", """
WITH h AS (SELECT user_id AS iteration, avg(value) / 2500 AS flip_rate, count(DISTINCT event_type) AS n_clusters,
  min(value) / 10 AS silhouette FROM events GROUP BY 1)
SELECT iteration, coalesce(flip_rate < 2e-2 AND n_clusters = lag(n_clusters) OVER w AND silhouette >= lag(silhouette) OVER w - 5e-2, false) AS converged
FROM h WINDOW w AS (ORDER BY iteration)""")
def convergence(spark, sf):
    history = table(spark, sf, "events").groupBy(F.col("user_id").alias("iteration")).agg(
        (F.avg("value") / 2500).alias("flip_rate"), F.count_distinct("event_type").alias("n_clusters"),
        (F.min("value") / 10).alias("silhouette"),
    )
    return selftrain.convergence(history)


def confident(spark, sf):
    """Calls as labelled rows: cluster from the user, noise for errors, confidence from the value."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "error", F.lit(-1)).otherwise(F.col("user_id")).cast("int").alias("cluster_id"),
        F.least(F.lit(1.0), F.col("value") / 200).alias("confidence"),
    )


_CONF_ROWS = """c AS (SELECT event_id AS id, CASE WHEN event_type = 'error' THEN -1 ELSE user_id END AS cluster_id,
  least(1e0, value / 200) AS confidence FROM events),
kept AS (SELECT * FROM c WHERE cluster_id >= 0 AND confidence >= (SELECT quantile_cont(confidence, 3e-1) FROM c WHERE cluster_id >= 0)),
w AS (SELECT id, 1e-1 + 9e-1 * ((confidence - min(confidence) OVER ()) / (max(confidence) OVER () - min(confidence) OVER ())) AS weight FROM kept)"""


@query("curriculum_select", f"WITH {_CONF_ROWS} SELECT id, round(confidence, 6) + 0e0 AS confidence FROM kept")
def curriculum_select(spark, sf):
    kept, _ = selftrain.curriculum(confident(spark, sf), 3)
    return kept.select("id", r6("confidence").alias("confidence"))


@query("curriculum_weights", f"WITH {_CONF_ROWS} SELECT id, round(weight, 6) + 0e0 AS weight FROM w")
def curriculum_weights(spark, sf):
    kept, _ = selftrain.curriculum(confident(spark, sf), 3)
    return selftrain.curriculum_weights(kept).select("id", r6("weight").alias("weight"))


@query("weighted_replicate", f"""
WITH {_CONF_ROWS}, n AS (SELECT id, least(3, greatest(1, round_even(weight * 3e0, 0)::INT)) AS n FROM w)
SELECT id, copy::BIGINT AS copy FROM (SELECT id, unnest(range(1, n + 1)) AS copy FROM n)""")
def weighted_replicate(spark, sf):
    kept, _ = selftrain.curriculum(confident(spark, sf), 3)
    return selftrain.replicate(selftrain.curriculum_weights(kept)).select("id", F.col("copy").cast("bigint").alias("copy"))


def confident_vectors(spark, sf):
    return points(spark, sf, True).withColumn("confidence", (F.lit(1.0) + F.get("v", F.lit(0))) / 2)


@query("mlp_refine")
def mlp_refine(spark, sf):
    return selftrain.train_and_refine(confident_vectors(spark, sf), 1, 64)


@query("mlp_refine_check", "SELECT count(*) AS n, count(DISTINCT vec_id) AS n_ids, 0::BIGINT AS strange FROM embeddings")
def mlp_refine_check(spark, sf):
    """Every row once, noise included, and only clusters that there were."""
    return mlp_refine(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"), F.count_if(~F.col("refined").between(0, 8)).alias("strange")
    )


@query("centroid_refine", f"""
WITH {E_NOISE_SQL}, c AS (SELECT *, (1 + v[1]) / 2 AS confidence FROM e),
kept AS (SELECT * FROM c WHERE cluster_id >= 0 AND confidence >= (SELECT quantile_cont(confidence, 2e-1) FROM c WHERE cluster_id >= 0)),
w AS (SELECT *, 1e-1 + 9e-1 * ((confidence - min(confidence) OVER ()) / (max(confidence) OVER () - min(confidence) OVER ())) AS weight FROM kept),
wl AS (SELECT cluster_id, dim, sum(weight * x) / sum(weight) AS x FROM (
  SELECT cluster_id, weight, generate_subscripts(v, 1) AS dim, unnest(v) AS x FROM w) GROUP BY ALL),
wc AS (SELECT cluster_id, list(x ORDER BY dim) AS m FROM wl GROUP BY 1)
SELECT id, arg_min(wc.cluster_id, (list_distance(v, m), wc.cluster_id)) AS refined FROM e CROSS JOIN wc GROUP BY id""")
def centroid_refine(spark, sf):
    return selftrain.centroid_refine(confident_vectors(spark, sf), 2)


# Labelled documents: rule labels, noise for one source, scores from the lengths.
def labeled_docs(spark, sf):
    docs = documents(spark, sf).withColumn(
        "cluster_id", F.when(F.col("cluster_id") == 0, F.lit(-1)).otherwise(F.col("cluster_id"))
    )
    return naming.join_labels(docs, naming.label_clusters(docs)).select(
        "id", "content", "label", "cluster_id", "confidence",
        (F.col("n_chars") % 1000 / 1000.0).alias("quality_score"), F.lit("text").alias("modality"),
        F.lit(0).alias("iteration"), (F.col("n_chars") > 5000).alias("anomaly_flag"),
        (F.col("lang") == "fr").alias("duplicate_flag"),
    )


_LD_SQL = f"""{D_SQL.replace("substr(source, 4)::INT AS cluster_id", "CASE WHEN source = 'src0' THEN -1 ELSE substr(source, 4)::INT END AS cluster_id")},
{_KW_SQL}, {_KWL_SQL}, {_TOKL_SQL}, {_LABELS_SQL},
ld AS (SELECT id, content, CASE WHEN cluster_id = -1 THEN 'noise' ELSE label END AS label, cluster_id,
  CASE WHEN cluster_id = -1 THEN 0e0 ELSE confidence END AS confidence, n_chars % 1000 / 1000e0 AS quality_score,
  'text' AS modality, 0 AS iteration, n_chars > 5000 AS anomaly_flag, lang = 'fr' AS duplicate_flag
  FROM d JOIN labels USING (cluster_id))"""


@query("dataset_stats", f"""
WITH {_LD_SQL} SELECT count(*) AS n_samples, count(DISTINCT cluster_id) FILTER (WHERE cluster_id >= 0) AS n_clusters,
  count(*) FILTER (WHERE cluster_id = -1) AS n_noise, count(*) FILTER (WHERE anomaly_flag) AS n_anomalies,
  count(*) FILTER (WHERE duplicate_flag) AS n_duplicates, round(avg(quality_score), 6) + 0e0 AS quality_mean,
  round(stddev_pop(quality_score), 6) + 0e0 AS quality_std, round(avg(confidence), 6) + 0e0 AS confidence_mean,
  round(stddev_pop(confidence), 6) + 0e0 AS confidence_std FROM ld""")
def dataset_stats(spark, sf):
    stats = metrics.dataset_stats(labeled_docs(spark, sf))
    doubles = {"quality_mean", "quality_std", "confidence_mean", "confidence_std"}
    return stats.select(*[r6(c).alias(c) if c in doubles else c for c in stats.columns])


@query("label_distribution", f"WITH {_LD_SQL} SELECT label, count(*) AS n FROM ld GROUP BY 1")
def label_distribution(spark, sf):
    return metrics.label_distribution(labeled_docs(spark, sf))


@query("quality_histogram", f"""
WITH {_LD_SQL}, b AS (SELECT min(quality_score) AS lo, max(quality_score) AS hi FROM ld)
SELECT least(30, floor((quality_score - lo) / ((hi - lo) / 30)) + 1)::BIGINT AS bin, count(*) AS n FROM ld, b GROUP BY 1""")
def quality_histogram(spark, sf):
    return metrics.histogram(labeled_docs(spark, sf), "quality_score")


@query("cluster_ranking", f"""
WITH {_LD_SQL} SELECT cluster_id, count(*) AS size, arg_min(label, id) AS label FROM ld WHERE cluster_id >= 0 GROUP BY 1""")
def cluster_ranking(spark, sf):
    return metrics.cluster_ranking(labeled_docs(spark, sf))


@query("review_sample", f"""
WITH {_LD_SQL}, hi AS (SELECT id FROM ld ORDER BY confidence DESC, id DESC LIMIT 3), lo AS (SELECT id FROM ld ORDER BY confidence, id LIMIT 3),
mid AS (SELECT id FROM ld WHERE id NOT IN (SELECT id FROM hi UNION ALL SELECT id FROM lo) ORDER BY md5(id || ':42'), id LIMIT 4)
SELECT 'high confidence' AS grp, id FROM hi UNION ALL SELECT 'middle', id FROM mid UNION ALL SELECT 'low confidence', id FROM lo""")
def review_sample(spark, sf):
    return metrics.review_sample(labeled_docs(spark, sf)).select("grp", "id")


@query("iteration_metrics", f"""
WITH {E_NOISE_SQL}, {DIST_SQL}, l AS (SELECT cluster_id, (1 + v[1]) / 2 AS quality_score FROM e),
coh AS (SELECT cluster_id, CASE WHEN count(*) < 2 THEN 1e0 ELSE exp(-avg(distance)) END AS coherence FROM dist WHERE cluster_id >= 0 GROUP BY 1)
SELECT 2::BIGINT AS iteration, 25e-2 AS silhouette, count(DISTINCT cluster_id) FILTER (WHERE cluster_id >= 0) AS n_clusters,
  round(avg((cluster_id = -1)::INT), 6) + 0e0 AS noise_ratio, 1e-1 AS flip_rate,
  (SELECT round(avg(coherence), 6) + 0e0 FROM coh) AS purity, round(avg(quality_score), 6) + 0e0 AS quality_mean,
  round(stddev_pop(quality_score), 6) + 0e0 AS quality_std FROM l""")
def iteration_metrics(spark, sf):
    df = confident_vectors(spark, sf).withColumnRenamed("confidence", "quality_score")
    row = selftrain.iteration_metrics(df, 2, 0.25, 0.1)
    return row.select(
        F.col("iteration").cast("bigint").alias("iteration"), "silhouette", "n_clusters",
        r6("noise_ratio").alias("noise_ratio"), "flip_rate", r6("purity").alias("purity"),
        r6("quality_mean").alias("quality_mean"), r6("quality_std").alias("quality_std"),
    )


@query("cluster_purity", f"""
WITH {E_NOISE_SQL}, {CENT_SQL}, p AS (SELECT cluster_id, avg(list_cosine_similarity(v, c)) AS p FROM e JOIN cent USING (cluster_id)
  WHERE cluster_id >= 0 AND n >= 2 GROUP BY 1) SELECT round(avg(p), 6) + 0e0 AS purity FROM p""")
def cluster_purity(spark, sf):
    return metrics.purity(points(spark, sf, True)).select(r6("purity").alias("purity"))


@query("noise_ratio", f"WITH {E_NOISE_SQL} SELECT round(avg((cluster_id = -1)::INT), 6) + 0e0 AS noise_ratio FROM e")
def noise_ratio(spark, sf):
    return metrics.noise_ratio(vectors(spark, sf, True)).select(r6("noise_ratio").alias("noise_ratio"))


@query("cluster_distribution", f"WITH {E_NOISE_SQL} SELECT cluster_id, count(*) AS n FROM e GROUP BY 1")
def cluster_distribution(spark, sf):
    return metrics.cluster_distribution(vectors(spark, sf, True))


@query("adjusted_rand", """
WITH n AS (SELECT quality AS a, toxic AS b, count(*)::DOUBLE AS n FROM labels GROUP BY ALL),
t AS (SELECT sum(n) AS n, sum(n * n) AS s FROM n), ra AS (SELECT sum(n * n) AS sa FROM (SELECT sum(n) AS n FROM n GROUP BY a)),
cb AS (SELECT sum(n * n) AS sb FROM (SELECT sum(n) AS n FROM n GROUP BY b)),
x AS (SELECT s - n AS tp, sb - s AS fp, sa - s AS fn, n * n - sa - sb + s AS tn FROM t, ra, cb)
SELECT round(2 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)), 6) + 0e0 AS adjusted_rand FROM x""")
def adjusted_rand(spark, sf):
    found = metrics.adjusted_rand(table(spark, sf, "labels"), "quality", "toxic")
    return found.select(r6("adjusted_rand").alias("adjusted_rand"))


@query("nmi", """
WITH n AS (SELECT quality AS a, toxic AS b, count(*) / sum(count(*)) OVER () AS p FROM labels GROUP BY ALL),
pa AS (SELECT a, sum(p) AS pa FROM n GROUP BY a), pb AS (SELECT b, sum(p) AS pb FROM n GROUP BY b)
SELECT round((SELECT sum(p * ln(p / (pa * pb))) FROM n JOIN pa USING (a) JOIN pb USING (b))
  / (((SELECT -sum(pa * ln(pa)) FROM pa) + (SELECT -sum(pb * ln(pb)) FROM pb)) / 2), 6) + 0e0 AS nmi""")
def nmi(spark, sf):
    return metrics.nmi(table(spark, sf, "labels"), "quality", "toxic").select(r6("nmi").alias("nmi"))


# Drift.
_INTER_SQL = """inter AS (SELECT avg(list_distance(a.c, b.c)) AS inter FROM cent a JOIN cent b ON a.cluster_id < b.cluster_id WHERE a.cluster_id >= 0)"""
_INTRA_SQL = """intra AS (SELECT avg(variance) AS intra FROM (SELECT cluster_id, avg(list_distance(v, c) ** 2) AS variance
  FROM e JOIN cent USING (cluster_id) WHERE cluster_id >= 0 AND n >= 2 GROUP BY 1))"""


@query("inter_cluster_distance", f"""
WITH {E_NOISE_SQL}, {CENT_SQL}, {_INTER_SQL} SELECT round(inter, 6) + 0e0 AS inter_cluster_distance FROM inter""")
def inter_cluster_distance(spark, sf):
    centres = crosscheck.real_centroids(vectors(spark, sf, True))
    return drift.inter_cluster_distance(centres).select(r6("inter_cluster_distance").alias("inter_cluster_distance"))


@query("intra_cluster_variance", f"""
WITH {E_NOISE_SQL}, {CENT_SQL}, {_INTRA_SQL} SELECT round(intra, 6) + 0e0 AS intra_cluster_variance FROM intra""")
def intra_cluster_variance(spark, sf):
    df = points(spark, sf, True)
    found = drift.intra_cluster_variance(df, crosscheck.real_centroids(df))
    return found.select(r6("intra_cluster_variance").alias("intra_cluster_variance"))


def moved(spark, sf):
    """The embeddings before and after every row moves to its nearest centroid."""
    from labelloom.functions.vectors import centroids

    before = points(spark, sf)
    found = cluster.assign_nearest(before.select("id", "v"), centroids(before, "cluster_id"))
    return before, cut(found.select("id", "v", F.col("nearest").alias("cluster_id")), "moved")


_MOVED_SQL = f"""{E_SQL}, {CENT_SQL},
e2 AS MATERIALIZED (SELECT id, v, arg_min(cent.cluster_id, (list_distance(v, c), cent.cluster_id)) AS cluster_id FROM e CROSS JOIN cent GROUP BY id, v),
cent_long2 AS (SELECT cluster_id, dim, avg(x) AS x, count(*) AS n FROM (SELECT cluster_id, generate_subscripts(v, 1) AS dim, unnest(v) AS x FROM e2) GROUP BY ALL),
cent2 AS (SELECT cluster_id, list(x ORDER BY dim) AS c, max(n) AS n FROM cent_long2 GROUP BY cluster_id),
shift AS (SELECT avg(list_distance(a.c, b.c)) AS shift FROM cent a JOIN cent2 b USING (cluster_id))"""


@query("centroid_drift", f"WITH {_MOVED_SQL} SELECT round(shift, 6) + 0e0 AS centroid_drift FROM shift")
def centroid_drift(spark, sf):
    before, after = moved(spark, sf)
    found = drift.centroid_drift(crosscheck.real_centroids(before), crosscheck.real_centroids(after))
    return found.select(r6("centroid_drift").alias("centroid_drift"))


_DRIFT_ROWS = """h AS (SELECT user_id AS iteration, avg(value) - 45 AS inter, stddev_pop(value) / 10 AS intra, max(value) / 100 AS shift
  FROM events GROUP BY 1),
p AS (SELECT *, lag(inter) OVER (ORDER BY iteration) AS prev FROM h),
f AS (SELECT *, coalesce(prev <> 0 AND inter / prev < 3e-1, false) AS collapse, coalesce(prev <> 0 AND shift / prev > 2, false) AS divergence FROM p)"""


def drift_rows(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("iteration")).agg(
        (F.avg("value") - 45).alias("inter_cluster_distance"),
        (F.stddev_pop("value") / 10).alias("intra_cluster_variance"),
        (F.max("value") / 100).alias("centroid_drift"),
    )


@query("drift_flags", f"WITH {_DRIFT_ROWS} SELECT iteration, collapse, divergence FROM f")
def drift_flags(spark, sf):
    return drift.report(drift_rows(spark, sf)).select("iteration", "collapse", "divergence")


@query("drift_health", f"""
WITH {_DRIFT_ROWS} SELECT iteration, round(CASE WHEN collapse OR divergence THEN 2e-1
  WHEN intra > 0 THEN least(1e0, inter / (intra + 1e-8) / 5) WHEN inter > 0 THEN 1e0 ELSE 5e-1 END, 6) + 0e0 AS health FROM f""")
def drift_health(spark, sf):
    return drift.report(drift_rows(spark, sf)).select("iteration", r6("health").alias("health"))


@query("drift_report", f"""
WITH {_MOVED_SQL}, {_INTER_SQL}, {_INTRA_SQL},
inter2 AS (SELECT avg(list_distance(a.c, b.c)) AS inter FROM cent2 a JOIN cent2 b ON a.cluster_id < b.cluster_id),
intra2 AS (SELECT avg(variance) AS intra FROM (SELECT cluster_id, avg(list_distance(v, c) ** 2) AS variance
  FROM e2 JOIN cent2 USING (cluster_id) WHERE n >= 2 GROUP BY 1)),
h AS (SELECT 0 AS iteration, inter, intra, 0e0 AS shift, NULL::DOUBLE AS prev FROM inter, intra
      UNION ALL SELECT 1, inter2.inter, intra2.intra, shift, inter.inter FROM inter2, intra2, shift, inter),
f AS (SELECT *, coalesce(inter / prev < 3e-1, false) AS collapse, coalesce(shift / prev > 2, false) AS divergence FROM h)
SELECT iteration::BIGINT AS iteration, round(inter, 6) + 0e0 AS inter_cluster_distance, round(intra, 6) + 0e0 AS intra_cluster_variance,
  round(shift, 6) + 0e0 AS centroid_drift, collapse, divergence, collapse OR divergence AS rollback,
  round(CASE WHEN collapse OR divergence THEN 2e-1 ELSE least(1e0, inter / (intra + 1e-8) / 5) END, 6) + 0e0 AS health FROM f""")
def drift_report(spark, sf):
    before, after = moved(spark, sf)
    first, centres = drift.measure(before, 0)
    second, _ = drift.measure(after, 1, centres)
    found = drift.report(first.unionByName(second))
    return found.select(
        F.col("iteration").cast("bigint").alias("iteration"),
        *[r6(c).alias(c) for c in ("inter_cluster_distance", "intra_cluster_variance", "centroid_drift", "health")],
        "collapse", "divergence", "rollback",
    )


# The label tree, from a fixed start, so that SQL can follow it.
_BEST_SQL = f"{_PTS_SQL}, {split_sql('pts', (2, 3, 4, 5))}"


@query("subcluster_best_k", f"""
WITH RECURSIVE {E_NOISE_SQL}, {_BEST_SQL} SELECT g::BIGINT AS cluster_id, k::BIGINT AS k, round(s, 6) + 0e0 AS silhouette FROM split_best""")
def subcluster_best_k(spark, sf):
    df = points(spark, sf, True).where("cluster_id >= 0").select(
        F.col("cluster_id").cast("bigint").alias("grp"), "id", "v"
    )
    sizes = {r.grp: r["count"] for r in df.groupBy("grp").count().collect()}
    _, best = taxonomy.best_splits(df, sizes, starts="farthest")
    return spark.createDataFrame(
        [(g, k, round(s, 6)) for g, _, k, s in best], "cluster_id bigint, k bigint, silhouette double"
    )


TREE_DEPTH, TREE_ROWS = 3, 5


def _tree_sql() -> str:
    """tree(node_path, parent_path, label, level, n_samples, confidence): every level splits the nodes that the one above left large enough."""
    parts = [f"""n0 AS (SELECT cluster_id::VARCHAR AS node_path, NULL AS parent_path, 'topic ' || chr((97 + cluster_id % 4)::INT) AS label, 0 AS level,
  count(*) AS n_samples, 5e-1 AS confidence FROM e WHERE cluster_id >= 0 GROUP BY cluster_id),
r0 AS MATERIALIZED (SELECT cluster_id::VARCHAR AS g, id, v FROM e WHERE cluster_id >= 0)"""]
    for i in range(TREE_DEPTH):
        parts.append(f"p{i} AS MATERIALIZED (SELECT r{i}.* FROM r{i} JOIN n{i} ON node_path = g WHERE n_samples >= {2 * TREE_ROWS})")
        parts.append(split_sql(f"p{i}", (2, 3, 4, 5), f"t{i}"))
        parts.append(f"""c{i} AS (SELECT t.g, t.c, count(*) AS n, min(t.id) AS first FROM t{i} t JOIN t{i}_best b ON b.g = t.g AND b.k = t.k
  WHERE b.s >= {SPLIT_AT}::DOUBLE GROUP BY t.g, t.c),
o{i} AS (SELECT g, c, n, row_number() OVER (PARTITION BY g ORDER BY first) - 1 AS at FROM c{i}),
n{i + 1} AS (SELECT o.g || '/' || o.at AS node_path, o.g AS parent_path, p.label || '/' || o.at AS label, {i + 1} AS level, o.n AS n_samples, p.confidence * 9e-1 AS confidence
  FROM o{i} o JOIN n{i} p ON p.node_path = o.g WHERE o.n >= {TREE_ROWS}),
r{i + 1} AS MATERIALIZED (SELECT o.g || '/' || o.at AS g, t.id, t.v FROM t{i} t JOIN t{i}_best b ON b.g = t.g AND b.k = t.k JOIN o{i} o ON o.g = t.g AND o.c = t.c)""")
    parts.append("tree AS (" + " UNION ALL ".join(f"SELECT * FROM n{i}" for i in range(TREE_DEPTH + 1)) + ")")
    return ",\n".join(parts)


_TREE_SQL = _tree_sql()


def tree(spark, sf):
    df = points(spark, sf, True)
    labels = cluster_labels(df).withColumn("confidence", F.lit(0.5))
    return taxonomy.discover(
        df, labels, max_depth=TREE_DEPTH, min_samples=TREE_ROWS, min_silhouette=SPLIT_AT, starts="farthest"
    )


@query("taxonomy_nodes", f"""
WITH RECURSIVE {E_NOISE_SQL}, {_TREE_SQL}
SELECT node_path, parent_path, label, level::BIGINT AS level, n_samples, round(confidence, 6) + 0e0 AS confidence FROM tree""")
def taxonomy_nodes(spark, sf):
    return tree(spark, sf).select(
        "node_path", "parent_path", "label", F.col("level").cast("bigint").alias("level"), "n_samples",
        r6("confidence").alias("confidence"),
    )


@query("taxonomy_stats", f"WITH RECURSIVE {E_NOISE_SQL}, {_TREE_SQL} SELECT count(*) AS total_nodes, max(level)::BIGINT AS max_depth FROM tree")
def taxonomy_stats(spark, sf):
    return taxonomy.stats(tree(spark, sf)).select("total_nodes", F.col("max_depth").cast("bigint").alias("max_depth"))


@query("taxonomy_flatten", f"""
WITH RECURSIVE {E_NOISE_SQL}, {_TREE_SQL}
SELECT p.label, string_agg(c.label, '|' ORDER BY c.node_path) AS children FROM tree c JOIN tree p ON c.parent_path = p.node_path
GROUP BY p.node_path, p.label""")
def taxonomy_flatten(spark, sf):
    return taxonomy.flatten(tree(spark, sf)).select("label", F.array_join("children", "|").alias("children"))


@query("taxonomy_deep")
def taxonomy_deep(spark, sf):
    df = points(spark, sf, True)
    labels = cluster_labels(df).withColumn("confidence", F.lit(0.5))
    return taxonomy.discover(df, labels, min_silhouette=0.01)


@query("taxonomy_deep_check", """
SELECT count(DISTINCT label) AS roots, count(*) AS root_rows, 0::BIGINT AS broken, 0::BIGINT AS overfull FROM embeddings WHERE label <> 9""")
def taxonomy_deep_check(spark, sf):
    """Roots are the clusters, every node hangs one level below a larger one, and children do not outgrow their parent."""
    nodes = cut(taxonomy_deep(spark, sf), "tree")
    up = nodes.select(F.col("node_path").alias("p"), F.col("level").alias("p_level"), F.col("n_samples").alias("p_rows"))
    kids = nodes.where("parent_path is not null").join(up, F.col("parent_path") == F.col("p"), "left")
    roots = nodes.where("parent_path is null").agg(F.count(F.lit(1)).alias("roots"), F.sum("n_samples").alias("root_rows"))
    broken = kids.agg(F.count_if(F.col("p").isNull() | (F.col("level") != F.col("p_level") + 1) | (F.col("n_samples") > F.col("p_rows"))).alias("broken"))
    full = kids.groupBy("p").agg(F.sum("n_samples").alias("s"), F.max("p_rows").alias("m")).agg(F.count_if(F.col("s") > F.col("m")).alias("overfull"))
    # Three tables of one row each.
    return roots.join(broken, F.lit(True)).join(full, F.lit(True))


# Sinks: write, read back.
_SINK_SQL = f"""WITH {_LD_SQL} SELECT id, md5(content) AS content_md5, label, cluster_id, round(confidence, 6) + 0e0 AS confidence,
  quality_score, modality, iteration, anomaly_flag, duplicate_flag FROM ld"""


def _back(df):
    return df.select(
        F.col("id").cast("bigint").alias("id"), F.md5("content").alias("content_md5"), "label",
        F.col("cluster_id").cast("int").alias("cluster_id"), r6(F.col("confidence").cast("double")).alias("confidence"),
        F.col("quality_score").cast("double").alias("quality_score"), "modality",
        F.col("iteration").cast("int").alias("iteration"), F.col("anomaly_flag").cast("boolean").alias("anomaly_flag"),
        F.col("duplicate_flag").cast("boolean").alias("duplicate_flag"),
    )


@query("sink_csv_roundtrip", _SINK_SQL)
def sink_csv_roundtrip(spark, sf):
    path = sinks.write_csv(labeled_docs(spark, sf), new_path(spark, "export"))
    return _back(spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"'))


@query("sink_json_roundtrip", _SINK_SQL)
def sink_json_roundtrip(spark, sf):
    return _back(spark.read.json(sinks.write_json(labeled_docs(spark, sf), new_path(spark, "export"))))


@query("sink_parquet_roundtrip", _SINK_SQL)
def sink_parquet_roundtrip(spark, sf):
    return _back(spark.read.parquet(sinks.write_parquet(labeled_docs(spark, sf), new_path(spark, "export"))))
