"""Named queries over the test tables, each next to its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.scratch import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Round to six places; adding zero turns -0.0 into 0.0."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def vectors(spark: SparkSession, sf_dir: str, noise: bool = False) -> DataFrame:
    """(id, v, cluster_id) of the embeddings; with ``noise`` label 9 stands for noise."""
    df = spread(table(spark, sf_dir, "embeddings"))
    label = F.when(F.col("label") == 9, F.lit(-1)).otherwise(F.col("label")) if noise else F.col("label")
    return df.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"),
        label.alias("cluster_id"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, content, cluster_id, ...) of the documents; the source number stands for the cluster."""
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"),
        F.substring("source", 4, 9).cast("int").alias("cluster_id"), "lang", "source", "n_chars",
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a log of namer calls."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("call_id"), F.col("user_id").alias("request"),
        F.col("event_type").alias("provider"), (F.col("event_type") != "error").alias("ok"),
        (F.col("value") * 10).alias("latency_ms"),
    )


# Shared pieces of the SQL side.
E_SQL = "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label AS cluster_id FROM embeddings)"
E_NOISE_SQL = (
    "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v,"
    " CASE WHEN label = 9 THEN -1 ELSE label END AS cluster_id FROM embeddings)"
)
D_SQL = (
    "d AS (SELECT doc_id AS id, text AS content, substr(source, 4)::INT AS cluster_id,"
    " lang, source, n_chars FROM documents)"
)
CALLS_SQL = (
    "calls AS (SELECT event_id AS call_id, user_id AS request, event_type AS provider,"
    " event_type <> 'error' AS ok, value * 10 AS latency_ms FROM events)"
)
CENT_SQL = """cent_long AS (
  SELECT cluster_id, dim, avg(x) AS x, count(*) AS n
  FROM (SELECT cluster_id, generate_subscripts(v, 1) AS dim, unnest(v) AS x FROM e) GROUP BY ALL),
cent AS (SELECT cluster_id, list(x ORDER BY dim) AS c, max(n) AS n FROM cent_long GROUP BY cluster_id)"""
STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}\x{{1c}}-\x{{1f}}\x{{85}}]+|[\s\p{{Z}}\x{{1c}}-\x{{1f}}\x{{85}}]+$', '', 'g')"
TF_SQL = """tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS t FROM documents),
tf AS (SELECT doc_id, ('0x' || substr(md5(t), 1, 8))::BIGINT % {dims} AS bucket, count(*)::DOUBLE AS tf
       FROM tok GROUP BY ALL)"""


def strip_sql(expr: str) -> str:
    return STRIP.format(expr)


def docvec_sql(dims: int = 256) -> str:
    """dv(id, v): unit hashed vectors of the documents that have tokens."""
    return (
        TF_SQL.format(dims=dims)
        + f""",
norms AS (SELECT doc_id, sqrt(sum(tf * tf)) AS n FROM tf GROUP BY doc_id),
grid AS (SELECT doc_id, b FROM norms, range(0, {dims}) t(b)),
dv AS (SELECT g.doc_id AS id, list(coalesce(tf.tf, 0) / n.n ORDER BY g.b) AS v
       FROM grid g JOIN norms n USING (doc_id)
       LEFT JOIN tf ON tf.doc_id = g.doc_id AND tf.bucket = g.b GROUP BY g.doc_id)"""
    )
