"""Queries over sources, cleaning and representation."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.functions.text import strip
from labelloom.functions.vectors import unit
from labelloom.operators import clean, fusion, represent
from labelloom.plans.registry import (
    D_SQL, E_NOISE_SQL, E_SQL, TF_SQL, documents, query, r6, strip_sql, table, vectors,
)
from labelloom.scratch import cut, new_path
from labelloom.sources import readers

_CONTENT = strip_sql("text")


def write_csv_source(df, spark, quote_all=True):
    path = new_path(spark, "source-csv")
    df.write.csv(path, header=True, quoteAll=quote_all, escape='"', ignoreLeadingWhiteSpace=False,
                 ignoreTrailingWhiteSpace=False)
    return path


@query("src_csv", f"""
SELECT doc_id::VARCHAR AS id, 'text' AS modality, sha256({_CONTENT}) AS content_hash,
       length({_CONTENT})::BIGINT AS n_chars
FROM documents WHERE length({_CONTENT}) > 0""")
def src_csv(spark, sf):
    docs = table(spark, sf, "documents")
    path = write_csv_source(docs.select(F.col("doc_id").alias("id"), F.col("text").alias("content")), spark)
    return readers.read_csv(spark, path).select(
        "id", "modality", "content_hash", F.length("content").cast("bigint").alias("n_chars")
    )


@query("src_json", f"""
SELECT doc_id::VARCHAR AS id, sha256({_CONTENT}) AS content_hash, lang, n_chars::VARCHAR AS n_chars,
       'crawl' AS source_tag
FROM documents WHERE length({_CONTENT}) > 0""")
def src_json(spark, sf):
    path = new_path(spark, "source-json")
    table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), "lang", "n_chars",
        F.col("source").alias("tag"),
    ).write.json(path)
    items = readers.read_json(spark, path, metadata={"tag": "crawl"}, lines=True)
    return items.select(
        "id", "content_hash", F.col("metadata")["lang"].alias("lang"),
        F.col("metadata")["n_chars"].alias("n_chars"), F.col("metadata")["tag"].alias("source_tag"),
    )


@query("src_text_lines", f"""
WITH lines AS (SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line FROM documents)
SELECT sha256({strip_sql('line')}) AS content_hash, count(*) AS n
FROM lines WHERE length({strip_sql('line')}) > 0 GROUP BY 1""")
def src_text_lines(spark, sf):
    path = new_path(spark, "source-text")
    table(spark, sf, "documents").select("text").write.text(path)
    return readers.read_text_lines(spark, path).groupBy("content_hash").agg(F.count(F.lit(1)).alias("n"))


@query("text_line_numbers", f"""
WITH lines AS (SELECT doc_id, generate_subscripts(l, 1) AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS l FROM documents))
SELECT doc_id, line_no::BIGINT AS line_no, md5({strip_sql('line')}) AS line_md5
FROM lines WHERE length({strip_sql('line')}) > 0""")
def text_line_numbers(spark, sf):
    lines = readers.number_lines(table(spark, sf, "documents"), "doc_id", "text")
    return lines.select("doc_id", "line_no", F.md5("content").alias("line_md5"))


@query("src_folder", f"""
SELECT item_id, sha256({_CONTENT}) AS content_hash FROM benchmark WHERE length({_CONTENT}) > 0""")
def src_folder(spark, sf):
    path = new_path(spark, "source-folder")
    table(spark, sf, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    return readers.read_folder(spark, path).select(
        F.regexp_extract("source", r"item_id=(\d+)", 1).cast("bigint").alias("item_id"), "content_hash"
    )


@query("src_union", f"""
SELECT 'csv' AS origin, doc_id::VARCHAR AS id, sha256({_CONTENT}) AS content_hash FROM documents
WHERE length({_CONTENT}) > 0
UNION ALL
SELECT 'json', item_id::VARCHAR, sha256({_CONTENT}) FROM benchmark WHERE length({_CONTENT}) > 0""")
def src_union(spark, sf):
    docs = table(spark, sf, "documents")
    csv = write_csv_source(docs.select(F.col("doc_id").alias("id"), F.col("text").alias("content")), spark)
    json = new_path(spark, "source-json")
    table(spark, sf, "benchmark").select(
        F.col("item_id").alias("id"), F.col("text").alias("content")
    ).write.json(json)
    parts = [(0, readers.read_csv(spark, csv)), (1, readers.read_json(spark, json, lines=True))]
    return readers.concat_in_order(parts).select(
        F.when(F.col("source") == csv, F.lit("csv")).otherwise(F.lit("json")).alias("origin"), "id", "content_hash"
    )


@query("content_hash", "SELECT doc_id, sha256(text) AS content_hash FROM documents")
def content_hash(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", readers.content_hash(F.col("text")).alias("content_hash")
    )


@query("dedup_exact", """
SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash, min(lang) AS lang FROM documents GROUP BY 2""")
def dedup_exact(spark, sf):
    items = table(spark, sf, "documents").select(
        F.col("doc_id").alias("pos"), readers.content_hash(F.col("text")).alias("content_hash"), "lang", "text"
    )
    return clean.deduplicate(items).select(F.col("pos").alias("doc_id"), "content_hash", "lang")


def _doubtful_items(spark, sf):
    return table(spark, sf, "documents").select(
        F.when(F.col("source") != "src3", F.col("doc_id").cast("string")).alias("id"),
        F.when(F.col("source") == "src5", F.lit("")).when(F.col("source") != "src4", F.col("text")).alias("content"),
        F.when(F.col("lang") == "fr", F.lit("audio")).otherwise(F.lit("text")).alias("modality"),
    )


@query("validate_items", """
SELECT CASE WHEN source = 'src3' THEN 'missing id' WHEN source = 'src4' THEN 'missing content'
            WHEN source = 'src5' OR length(text) = 0 THEN 'empty content'
            WHEN lang = 'fr' THEN 'unknown modality' ELSE 'valid' END AS reason,
       count(*) AS n FROM documents GROUP BY 1""")
def validate_items(spark, sf):
    checked = _doubtful_items(spark, sf).withColumn("reason", clean.invalid_reason())
    return checked.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("check_vectors", """
SELECT count(*) AS n_rows, min(len(embedding))::BIGINT AS min_dim, max(len(embedding))::BIGINT AS max_dim,
       count(*) FILTER (WHERE len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) > 0) AS n_not_finite,
       min(len(embedding)) = max(len(embedding)) AND
       count(*) FILTER (WHERE len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) > 0) = 0 AS is_valid
FROM embeddings""")
def check_vectors(spark, sf):
    return clean.check_vectors(vectors(spark, sf))


@query("check_labels", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE label - 2 IS NULL) AS n_missing,
       count(*) FILTER (WHERE label - 2 < -1) AS n_below_noise,
       count(*) FILTER (WHERE label - 2 < -1 OR label IS NULL) = 0 AS is_valid FROM embeddings""")
def check_labels(spark, sf):
    return clean.check_labels(vectors(spark, sf).withColumn("cluster_id", F.col("cluster_id") - 2))


@query("check_scores", """
SELECT count(*) AS n_rows, 0::BIGINT AS n_nan, count(*) FILTER (WHERE value / 300 > 1) AS n_out_of_range,
       count(*) FILTER (WHERE value / 300 > 1) = 0 AS is_valid FROM events""")
def check_scores(spark, sf):
    return clean.check_scores(table(spark, sf, "events").withColumn("score", F.col("value") / 300), "score")


@query("check_domain", """
SELECT count(*) FILTER (WHERE role IN ('user', 'assistant')) AS n_inside,
       count(*) FILTER (WHERE role NOT IN ('user', 'assistant')) AS n_outside FROM conversations""")
def check_domain(spark, sf):
    return clean.check_domain(table(spark, sf, "conversations"), "role", ["user", "assistant"])


@query("filter_noise", f"""
WITH {E_NOISE_SQL} SELECT cluster_id, count(*) AS n FROM e WHERE cluster_id >= 0 GROUP BY 1""")
def filter_noise(spark, sf):
    return clean.without_noise(vectors(spark, sf, noise=True)).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("embed_hashed_tf", f"""
WITH {TF_SQL.format(dims=256)} SELECT doc_id, bucket, tf FROM tf""")
def embed_hashed_tf(spark, sf):
    docs = documents(spark, sf).select(
        F.col("id").alias("doc_id"), represent.hashed_vector(F.col("content"), 256, normalize=False).alias("v")
    )
    return represent.long_form(docs, "doc_id").select(
        "doc_id", F.col("dim").cast("bigint").alias("bucket"), F.col("value").alias("tf")
    )


@query("embed_hashed_tfidf", f"""
WITH {TF_SQL.format(dims=256)},
df AS (SELECT bucket, count(*) AS df FROM tf GROUP BY bucket),
w AS (SELECT doc_id, bucket, tf * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1) AS w
      FROM tf JOIN df USING (bucket))
SELECT doc_id, bucket, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) + 0e0 AS weight FROM w""")
def embed_hashed_tfidf(spark, sf):
    docs = cut(documents(spark, sf).select(
        F.col("id").alias("doc_id"), represent.hashed_vector(F.col("content"), 256, normalize=False).alias("v")
    ), "tf")
    return represent.long_form(represent.tfidf(docs), "doc_id").select(
        "doc_id", F.col("dim").cast("bigint").alias("bucket"), r6("value").alias("weight")
    )


@query("l2_normalize", f"""
WITH {E_SQL}, s AS (SELECT id, list_transform(v, lambda x: x * (1 + cluster_id)) AS v FROM e),
n AS (SELECT id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM s)
SELECT id, (generate_subscripts(v, 1) - 1)::BIGINT AS dim,
       round(unnest(v) / n, 6) + 0e0 AS value FROM n""")
def l2_normalize(spark, sf):
    scaled = vectors(spark, sf).withColumn(
        "v", F.transform("v", lambda x: x * (F.lit(1.0) + F.col("cluster_id")))
    )
    return scaled.select("id", F.posexplode(unit(F.col("v"))).alias("dim", "value")).select(
        "id", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value")
    )


@query("random_projection", f"""
WITH {E_SQL}, x AS (SELECT id, generate_subscripts(v, 1) - 1 AS i, unnest(v) AS x FROM e),
signs AS (SELECT i, j, CASE WHEN ('0x' || substr(md5('42:' || j || ':' || i), 1, 1))::INT % 2 = 0 THEN 1e0 ELSE -1e0 END AS s
          FROM range(0, 64) a(i), range(0, 8) b(j))
SELECT id, j::BIGINT AS dim, round(sum(x * s) / sqrt(8e0), 6) + 0e0 AS value
FROM x JOIN signs USING (i) GROUP BY id, j""")
def random_projection(spark, sf):
    reduced = represent.random_projection(vectors(spark, sf), 64, 8)
    return reduced.select("id", F.posexplode("v").alias("dim", "value")).select(
        "id", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value")
    )


@query("reduce_pca")
def reduce_pca(spark, sf):
    reduced, _ = represent.reduce_pca(vectors(spark, sf), 8)
    return reduced.select("id", F.posexplode("v").alias("dim", "value"))


@query("reduce_pca_check", "SELECT count(*) AS n, 8::BIGINT AS dims, 0::BIGINT AS correlated, true AS ordered FROM embeddings")
def reduce_pca_check(spark, sf):
    """The components are uncorrelated and stand in order of their variance."""
    reduced, _ = represent.reduce_pca(vectors(spark, sf), 8)
    part = lambda i: F.get("v", F.lit(i))
    pairs = [(i, j) for i in range(8) for j in range(i)]
    one = reduced.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("v")).cast("bigint").alias("dims"),
        F.array(*[F.covar_samp(part(i), part(j)) for i, j in pairs]).alias("c"),
        F.array(*[F.var_samp(part(i)) for i in range(8)]).alias("s"),
    )
    return one.select(
        "n", "dims", F.size(F.filter("c", lambda x: F.abs(x) > 1e-9)).cast("bigint").alias("correlated"),
        (F.col("s") == F.reverse(F.array_sort("s"))).alias("ordered"),
    )


_FUSED = """fused AS (
  SELECT id, cluster_id, list_concat(
    list_transform(a, lambda x: x / na * {w0}), list_transform(b, lambda x: x / nb * {w1})) AS f
  FROM (SELECT id, cluster_id, v[1:32] AS a, v[33:64] AS b,
               sqrt(list_sum(list_transform(v[1:32], lambda x: x * x))) AS na,
               sqrt(list_sum(list_transform(v[33:64], lambda x: x * x))) AS nb FROM e))"""


def _halves(spark, sf):
    return vectors(spark, sf).select(
        "id", "cluster_id", F.slice("v", 1, 32).alias("a"), F.slice("v", 33, 32).alias("b")
    )


@query("fuse_embeddings", f"""
WITH {E_SQL}, {_FUSED.format(w0='(2e0/3)', w1='(1e0/3)')}
SELECT id, (generate_subscripts(f, 1) - 1)::BIGINT AS dim,
       round(unnest(f) / sqrt(list_sum(list_transform(f, lambda x: x * x))), 6) + 0e0 AS value FROM fused""")
def fuse_embeddings(spark, sf):
    halves = _halves(spark, sf)
    fused = represent.fuse([F.col("a"), F.col("b")], [2.0, 1.0])
    return halves.select("id", F.posexplode(fused).alias("dim", "value")).select(
        "id", F.col("dim").cast("bigint").alias("dim"), r6("value").alias("value")
    )


@query("fusion_weight_search", f"""
WITH {E_SQL},
parts AS (SELECT id, cluster_id, list_transform(a, lambda x: x / na) AS a, list_transform(b, lambda x: x / nb) AS b
  FROM (SELECT id, cluster_id, v[1:32] AS a, v[33:64] AS b,
               sqrt(list_sum(list_transform(v[1:32], lambda x: x * x))) AS na,
               sqrt(list_sum(list_transform(v[33:64], lambda x: x * x))) AS nb FROM e)),
grid AS (SELECT i AS cand, i / 5e0 AS w0, (5 - i) / 5e0 AS w1 FROM range(0, 6) t(i)),
gaps AS MATERIALIZED (SELECT p.id, p.cluster_id AS own, q.cluster_id AS other,
         list_distance(p.a, q.a) ** 2 AS da, list_distance(p.b, q.b) ** 2 AS db
  FROM parts p JOIN parts q ON p.id <> q.id),
means AS (SELECT cand, id, own, other, avg(sqrt((w0*w0*da + w1*w1*db) / (w0*w0 + w1*w1))) AS m
  FROM gaps, grid GROUP BY ALL),
ab AS (SELECT cand, id, max(m) FILTER (WHERE own = other) AS a, min(m) FILTER (WHERE own <> other) AS b
  FROM means GROUP BY cand, id)
SELECT cand::BIGINT AS cand, w0, w1, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) + 0e0 AS silhouette
FROM ab JOIN grid USING (cand) GROUP BY ALL""")
def fusion_weight_search(spark, sf):
    found = fusion.weight_silhouettes(_halves(spark, sf), ["a", "b"])
    return found.select(F.col("cand").cast("bigint").alias("cand"), "w0", "w1", r6("silhouette").alias("silhouette"))
