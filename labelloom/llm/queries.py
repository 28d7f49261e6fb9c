"""Queries over the test tables that apply one operator each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import (
    collocations, crf_quality, fm_decontaminate, fm_toxicity, license_scan, metric_join, paragraph_minhash, pfair_mix, shuffle_shards,
    simhash, token_output, url_filter, vector_codes,
)
from labelloom.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


@query("op1_simhash_groups")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op2_token_ids")
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = token_output.by_key(read(spark, sf_dir, "documents"))
    return token_output.token_table(ordered, public_tokenizers.path("byte_bpe_50k.json"))


@query("op6_quality_crf")
def quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = crf_quality.train(docs, read(spark, sf_dir, "labels"))
    return crf_quality.score(docs, model).select(
        "doc_id", crf_quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS_SQL = (
    f"coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []::VARCHAR[])"
)
OP8_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[k : k + 9], ' ') AS p
        FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM win),
placed AS (SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS p
       FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS k)),
hit AS (SELECT doc_id, k, size, item_id FROM placed JOIN win USING (size, p)),
words AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (
  SELECT doc_id, unnest(range(k, k + size)) AS i FROM (SELECT DISTINCT doc_id, k, size FROM hit)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op8_fm_decontaminate", OP8_SQL)
def fm_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_decontaminate.find(read(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return fm_decontaminate.digest(found)


@query("op3_shuffle_shards")
def shuffle_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle_shards.sharded(read(spark, sf_dir, "documents"), 40).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


# Fetch dates and a dated list that follow from the pages: a third of the hosts, a fifth of the domains and a
# seventh of the first path prefixes are listed, some are removed again, and some of those return.
def _number(column: str, at: int) -> str:
    return f"cast(conv(substr(md5({column}), {at}, 6), 16, 10) as bigint)"


def dated_list(pages: DataFrame) -> DataFrame:
    known = pages.select(F.explode(url_filter.names("url")).alias("n")).select("n.kind", "n.pattern").distinct()
    share = "case kind when 'host' then 3 when 'domain' then 5 else 7 end"
    listed = known.where(f"{_number('pattern', 1)} % ({share}) = 0").select(
        "kind", "pattern", F.expr(f"case {_number('pattern', 7)} % 3 when 0 then 'adult' when 1 then 'spam' else 'malware' end").alias("category"),
        F.expr(f"date_add(date'2024-01-01', cast({_number('pattern', 13)} % 200 as int))").alias("first"),
        F.expr(f"cast(1 + {_number('pattern', 19)} % 90 as int)").alias("stay"),
        F.expr(f"cast({_number('pattern', 25)} % 4 as int)").alias("fate"),
    )
    events = F.array(
        F.struct(F.lit("add").alias("action"), F.col("first").alias("at")),
        F.struct(F.when(F.col("fate") >= 1, F.lit("remove")).alias("action"), F.expr("date_add(first, stay)").alias("at")),
        F.struct(F.when(F.col("fate") == 3, F.lit("add")).alias("action"), F.expr("date_add(first, 2 * stay)").alias("at")),
    )
    return listed.select("kind", "pattern", "category", F.explode(events).alias("e")).select(
        "kind", "pattern", "category", "e.action", "e.at"
    ).where("action is not null")


def captures(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_id", "url", F.expr(f"date_add(date'2024-01-01', cast({_number('cast(page_id as string)', 1)} % 366 as int))").alias("fetched")
    )


OP5_SQL = r"""
WITH c AS (
  SELECT page_id, url, DATE '2024-01-01' + (('0x' || substr(md5(page_id::VARCHAR), 1, 6))::BIGINT % 366)::INT AS fetched,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
p AS (SELECT *, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM c),
k AS (
  SELECT page_id, fetched, 'host' AS kind, host AS pattern FROM p WHERE host IS NOT NULL
  UNION ALL
  SELECT page_id, fetched, 'domain', array_to_string(labels[i:], '.') FROM p, range(1, 64) r(i)
  WHERE host IS NOT NULL AND len(labels) >= 2 AND i <= len(labels) - 1
  UNION ALL
  SELECT page_id, fetched, 'prefix', lower(host || '/' || array_to_string(parts[:i], '/')) FROM p, range(1, 256) r(i)
  WHERE host IS NOT NULL AND i <= len(parts)),
known AS (SELECT DISTINCT kind, pattern FROM k),
n AS (SELECT kind, pattern, ('0x' || substr(md5(pattern), 1, 6))::BIGINT AS a, ('0x' || substr(md5(pattern), 7, 6))::BIGINT AS b,
             ('0x' || substr(md5(pattern), 13, 6))::BIGINT AS d, ('0x' || substr(md5(pattern), 19, 6))::BIGINT AS e,
             ('0x' || substr(md5(pattern), 25, 6))::BIGINT AS f FROM known),
l AS (SELECT kind, pattern, CASE b % 3 WHEN 0 THEN 'adult' WHEN 1 THEN 'spam' ELSE 'malware' END AS category,
             DATE '2024-01-01' + (d % 200)::INT AS first, (1 + e % 90)::INT AS stay, f % 4 AS fate
      FROM n WHERE a % (CASE kind WHEN 'host' THEN 3 WHEN 'domain' THEN 5 ELSE 7 END) = 0),
spans AS (
  SELECT kind, pattern, category, first AS since, CASE WHEN fate >= 1 THEN first + stay END AS until FROM l
  UNION ALL SELECT kind, pattern, category, first + 2 * stay, NULL FROM l WHERE fate = 3),
hit AS (SELECT k.page_id, count(*) AS n_entries, string_agg(DISTINCT category, ',' ORDER BY category) AS categories, min(since) AS listed_since
        FROM k JOIN spans s ON s.kind = k.kind AND s.pattern = k.pattern AND s.since <= k.fetched AND (s.until IS NULL OR k.fetched < s.until)
        GROUP BY k.page_id)
SELECT c.page_id, c.host, c.fetched::VARCHAR AS fetched, hit.page_id IS NOT NULL AS blocked, coalesce(n_entries, 0) AS n_entries,
       coalesce(categories, '') AS categories, listed_since::VARCHAR AS listed_since
FROM c LEFT JOIN hit USING (page_id)
"""


@query("op5_url_filter", OP5_SQL)
def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    found = url_filter.evaluate(captures(pages), dated_list(pages))
    return found.select(
        "page_id", "host", F.col("fetched").cast("string").alias("fetched"), "blocked", "n_entries", "categories",
        F.col("listed_since").cast("string").alias("listed_since"),
    )


OP9_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c
"""


@query("op9_metric_range_join", OP9_SQL)
def metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metric_join.near_duplicates(read(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


OP10_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(strlen(text), 0) + 1 AS size FROM documents),
o AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id ROWS UNBOUNDED PRECEDING) - size AS off FROM d),
p AS (SELECT *, floor(off / 1048576)::BIGINT AS block FROM o),
s AS (SELECT source, sqrt(sum(size)) AS w, ceil(sum(size) / 1048576)::BIGINT AS b FROM d GROUP BY source),
a AS (SELECT list(source ORDER BY source) AS names, list(w ORDER BY source) AS w, list(b ORDER BY source) AS b, sum(b) AS n FROM s),
wins AS (
  SELECT x.source, k.k AS block,
         floor((SELECT sum(least(y.w * (k.k / x.w), y.b)) FROM s y) + 1e-9)::BIGINT AS release,
         ceil((SELECT sum(least(y.w * ((k.k + 1) / x.w), y.b)) FROM s y) - 1e-9)::BIGINT AS deadline
  FROM s x, LATERAL (SELECT unnest(range(x.b)) AS k) k),
win AS (SELECT i - 1 AS i, w.block, w.release, w.deadline FROM wins w, a, LATERAL (SELECT list_position(a.names, w.source) AS i)),
lists AS (SELECT list(r ORDER BY i) AS r, list(d ORDER BY i) AS d FROM (
  SELECT i, list(release ORDER BY block) AS r, list(deadline ORDER BY block) AS d FROM win GROUP BY i)),
run(t, done, i, k) AS (
  SELECT 0::BIGINT, list_transform((SELECT b FROM a), lambda x: 0::BIGINT), NULL::BIGINT, NULL::BIGINT
  UNION ALL
  SELECT t + 1, list_transform(done, lambda x, j: CASE WHEN j = pick.i THEN x + 1 ELSE x END), pick.i, done[pick.i]
  FROM run, a, lists, LATERAL (
    SELECT list_sort(list_transform(
      list_filter(range(1, len(a.b) + 1), lambda j: done[j] < a.b[j] AND lists.r[j][done[j] + 1] <= t),
      lambda j: {'d': lists.d[j][done[j] + 1], 'i': j}))[1].i AS i) pick
  WHERE t < a.n)
SELECT p.doc_id, p.source, p.block, r.t - 1 AS slot, p.off::BIGINT AS "offset"
FROM run r JOIN a ON r.i IS NOT NULL JOIN p ON p.source = a.names[r.i] AND p.block = r.k
"""


@query("op10_pfair_mix", OP10_SQL)
def pfair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mix.mix(read(spark, sf_dir, "documents")).select("doc_id", "source", "block", "slot", "offset")


@query("op4_license_scan")
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


@query("op7_paragraph_minhash")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_minhash.repeated_spans(read(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(translate(text, '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT lang, row_number() OVER () AS id, piece FROM p),
w AS (SELECT lang, id, unnest(w) AS w1, unnest(range(len(w))) AS i FROM (
  SELECT lang, id, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM numbered)),
t AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4 FROM w WINDOW o AS (PARTITION BY id ORDER BY i)),
f AS MATERIALIZED (
  SELECT lang, 1 AS m, w1 AS phrase, count(*) AS f FROM t GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM t WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM t WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM t WHERE w4 IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE m > 1 AND f >= 30),
known AS MATERIALIZED (SELECT concat(lang, '.', phrase) AS key, f FROM f WHERE f >= 30),
cuts AS MATERIALIZED (SELECT c.*, k, array_to_string(w[:k], ' ') AS x, array_to_string(w[k + 1 :], ' ') AS y FROM c, LATERAL (SELECT unnest(range(1, m)) AS k)),
s AS (SELECT cuts.*, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f + r.f))::BIGINT AS score
      FROM cuts JOIN known l ON l.key = concat(cuts.lang, '.', x) JOIN known r ON r.key = concat(cuts.lang, '.', y)),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[i : i + j - 1], ' ') AS phrase, max(a) AS longer
  FROM c, LATERAL (SELECT unnest(range(2, m)) AS j), LATERAL (SELECT unnest(range(1, m - j + 2)) AS i) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN inner_ USING (lang, phrase) JOIN n USING (lang)
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000
"""


@query("op11_collocations", OP11_SQL)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_sql(rounds: int = 6) -> str:
    """Rounds of assignment to the nearest entry and floored means, one after the other."""
    nearest = """(
  SELECT vec_id, p, min({{'d': d, 'e': e}}).e AS e, min({{'d': d, 'e': e}}).d AS d FROM (
    SELECT x.vec_id, x.p, c.e, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts x JOIN book{k} c ON c.p = x.p) GROUP BY vec_id, p)"""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"near{k} AS MATERIALIZED {nearest.format(k=k)}")
        if k < rounds:
            steps.append(f"""sums{k} AS (
  SELECT p, e, i, sum(x)::HUGEINT AS s, count(*) AS n
  FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM near{k} JOIN parts USING (vec_id, p)) GROUP BY ALL)""")
            steps.append(f"""mean{k} AS (SELECT p, e, list((((s - (((s % n) + n) % n)) / n))::BIGINT ORDER BY i) AS v FROM sums{k} GROUP BY p, e)""")
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e)""")
    chain = ",\n".join(steps)
    return f"""
WITH q AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
parts AS MATERIALIZED (SELECT vec_id, p, v[(p * len(v) // 8 + 1)::INT : ((p + 1) * len(v) // 8)::INT] AS v FROM q, range(8) r(p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts
  WHERE vec_id IN (SELECT vec_id FROM q ORDER BY vec_id LIMIT 16)),
{chain},
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS h FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN q USING (vec_id), digest
"""


@query("op12_vector_codes", op12_sql())
def coded_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(read(spark, sf_dir, "embeddings"))


@query("op13_toxicity_fm")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fm_toxicity.train(docs, read(spark, sf_dir, "labels"))
    return fm_toxicity.score(docs, model).select(
        "doc_id", fm_toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
