"""Queries over naming, responses, the call log and provenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.functions import text
from labelloom.operators import calls as log
from labelloom.operators import naming, provenance
from labelloom.operators.represent import hashed_vector
from labelloom.plans.registry import (
    CALLS_SQL, CENT_SQL, D_SQL, E_NOISE_SQL, E_SQL, calls, documents, docvec_sql, query, r6, strip_sql, table, vectors,
)
from labelloom.scratch import cut

_WS = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"


def quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def words_sql(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{_WS}+'), lambda w: w <> '')"


def clean_sql(col: str) -> str:
    after = "coalesce(" + ", ".join(
        f"CASE WHEN contains(lower({col}), '{s}') THEN substr({col}, instr(lower({col}), '{s}') + {len(s)}) END"
        for s in text.RESPONSE_SEPARATORS
    ) + f", {col}, '')"
    line = strip_sql(f"split_part(regexp_replace({after}, '[*_`~]', '', 'g'), chr(10), 1)")
    line = f"regexp_replace({line}, '^\\p{{Nd}}+[.)]{_WS}*', '')"
    line = f"regexp_replace({line}, '^[-•]{_WS}*', '')"
    kept = f"regexp_replace({line}, '[^\\p{{L}}\\p{{N}}_\\s\\p{{Z}}\\x{{1c}}-\\x{{1f}}\\x{{85}}/-]', '', 'g')"
    return f"array_to_string(list_slice({words_sql(kept)}, 1, 3), ' ')"


def normalize_sql(expr: str) -> str:
    low = f"regexp_replace({strip_sql(f'lower({expr})')}, '{_WS}+', ' ', 'g')"
    return (
        f"nullif(CASE WHEN length({low}) > 50 THEN regexp_replace(substr({low}, 1, 50), ' [^ ]*$', '')"
        f" ELSE {low} END, '')"
    )


def validate_sql(col: str) -> str:
    parts = words_sql(col)
    telling = f"list_filter({parts}, lambda w: lower(w) NOT IN ({quoted(text.FILLER_WORDS)}) AND length(w) > 2)"
    return (
        f"CASE WHEN coalesce(length({col}), 0) = 0 THEN 'unlabeled' WHEN len({parts}) > 3 THEN"
        f" coalesce(({telling})[1], ({parts})[1]) ELSE {strip_sql(col)} END"
    )


# Responses made from the turns: a preamble with a separator for some roles.
_RESPONSE = (
    "CASE role WHEN 'user' THEN 'Sure! Category: **' || text ELSE '1. ' || text END"
)


def responses(spark, sf):
    c = table(spark, sf, "conversations")
    made = F.when(F.col("role") == "user", F.concat(F.lit("Sure! Category: **"), "text")).otherwise(
        F.concat(F.lit("1. "), "text")
    )
    return c.select("conv_id", "turn", "role", "text", made.alias("response"))


@query("clean_response", f"""
WITH r AS (SELECT conv_id, turn, {_RESPONSE} AS response FROM conversations)
SELECT conv_id, turn, {clean_sql('response')} AS label FROM r""")
def clean_response(spark, sf):
    return responses(spark, sf).select("conv_id", "turn", text.clean_response(F.col("response")).alias("label"))


@query("normalize_label", f"""
WITH r AS (SELECT conv_id, turn, {_RESPONSE} AS response FROM conversations),
c AS (SELECT conv_id, turn, {clean_sql('response')} AS label FROM r)
SELECT conv_id, turn, {normalize_sql('label')} AS label, {normalize_sql('response')} AS long_label FROM c JOIN r USING (conv_id, turn)""")
def normalize_label(spark, sf):
    return responses(spark, sf).select(
        "conv_id", "turn", text.normalize_label(text.clean_response(F.col("response"))).alias("label"),
        text.normalize_label(F.col("response")).alias("long_label"),
    )


@query("validate_label", f"""
WITH r AS (SELECT conv_id, turn, {normalize_sql('text')} AS label FROM conversations)
SELECT conv_id, turn, {validate_sql('label')} AS label FROM r""")
def validate_label(spark, sf):
    return responses(spark, sf).select(
        "conv_id", "turn", text.validate_label(text.normalize_label(F.col("text"))).alias("label")
    )


@query("representatives_topk", f"""
WITH {E_NOISE_SQL}, {CENT_SQL}
SELECT * FROM (SELECT cluster_id, id, row_number() OVER (PARTITION BY cluster_id ORDER BY list_distance(v, c), id) AS rank
               FROM e JOIN cent USING (cluster_id) WHERE cluster_id >= 0) WHERE rank <= 5""")
def representatives_topk(spark, sf):
    return naming.representatives(vectors(spark, sf, noise=True), 5).select(
        "cluster_id", "id", F.col("rank").cast("bigint").alias("rank")
    )


REP_DIMS = 64


def reps_sql(i: int, source: str) -> str:
    """f{i}(cluster_id, content, rank): the five rows of each cluster of ``source`` nearest to its centroid; needs ev(id, v)."""
    return f"""m{i} AS MATERIALIZED (SELECT s.id, s.cluster_id, s.content, ev.v FROM {source} s JOIN ev USING (id) WHERE s.cluster_id >= 0),
cc{i} AS (SELECT cluster_id, list(x ORDER BY dim) AS c FROM (
  SELECT cluster_id, dim, avg(x) AS x FROM (SELECT cluster_id, generate_subscripts(v, 1) AS dim, unnest(v) AS x FROM m{i}) GROUP BY ALL) GROUP BY 1),
f{i} AS (SELECT cluster_id, content, rank FROM (
  SELECT cluster_id, content, row_number() OVER (PARTITION BY cluster_id ORDER BY list_distance(v, c), id) AS rank FROM m{i} JOIN cc{i} USING (cluster_id))
  WHERE rank <= 5)"""


_EV_SQL = docvec_sql(REP_DIMS) + f""",
ev AS MATERIALIZED (SELECT doc_id AS id, coalesce(v, list_transform(range({REP_DIMS}), lambda x: 0e0)) AS v FROM documents LEFT JOIN dv ON id = doc_id)"""


def _representatives(docs):
    """The five documents of each cluster nearest to the centroid of its hashed vectors."""
    return naming.representatives(docs.withColumn("v", hashed_vector(F.col("content"), REP_DIMS)), 5, keep=["content"])


_PROMPT_SQL = (
    "'Which topic do these samples share?' || chr(10) || string_agg(rank || '. ' || substr(content, 1, 200), chr(10)"
    " ORDER BY rank) || chr(10) || 'Answer with one to three words only.' || chr(10) || 'Topic:'"
)


@query("cluster_prompts", f"""
WITH {D_SQL}, {_EV_SQL}, {reps_sql(0, 'd')} SELECT cluster_id, {_PROMPT_SQL} AS prompt FROM f0 GROUP BY 1""")
def cluster_prompts(spark, sf):
    return naming.prompts(_representatives(documents(spark, sf)))


def _score_sql(words: list[str]) -> str:
    return " + ".join(f"(length(t) - length(replace(t, '{w}', ''))) // {len(w)}" for w in words)


_KW_SQL = "kw AS (SELECT cluster_id, {} FROM (SELECT cluster_id, lower(content) AS t FROM d) GROUP BY 1)".format(
    ", ".join(f"sum({_score_sql(ws)})::BIGINT AS s{i}" for i, ws in enumerate(naming.DOMAIN_KEYWORDS.values()))
)
_KWL_SQL = "kwl AS (SELECT cluster_id, greatest(s0, s1, s2, s3) AS score, CASE WHEN greatest(s0, s1, s2, s3) = 0 THEN NULL {} END AS label FROM kw)".format(
    " ".join(f"WHEN s{i} = greatest(s0, s1, s2, s3) THEN '{n}'" for i, n in enumerate(naming.DOMAIN_KEYWORDS))
)
_TOKL_SQL = f"""tk AS (SELECT cluster_id, id, generate_subscripts(ts, 1) AS ix, unnest(ts) AS t FROM (
  SELECT cluster_id, id, regexp_extract_all(lower(content), '[a-zA-Z][a-zA-Z-]{{2,}}') AS ts FROM d)),
tc AS (SELECT cluster_id, t, count(*) AS n, min((id, ix)) AS first FROM tk WHERE t NOT IN ({quoted(naming.STOPWORDS)}) GROUP BY ALL),
tr AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, first) AS r FROM tc),
tokl AS (SELECT cluster_id, string_agg(t, ' ' ORDER BY r) AS label FROM tr WHERE r <= 2 GROUP BY 1)"""


def _business(df):
    """Documents with a few domain words put in for three clusters, so keyword labels occur."""
    extra = (
        F.when(F.col("cluster_id") == 1, F.lit(" market stocks and egg models"))
        .when(F.col("cluster_id") == 2, F.lit(" the dolphin species of the ocean"))
        .when(F.col("cluster_id") == 3, F.lit(" recipe: flour, eggs"))
        .otherwise(F.lit(""))
    )
    return df.withColumn("content", F.concat("content", extra))


_BUSINESS_SQL = D_SQL.replace(
    "text AS content",
    "text || CASE source WHEN 'src1' THEN ' market stocks and egg models' WHEN 'src2' THEN"
    " ' the dolphin species of the ocean' WHEN 'src3' THEN ' recipe: flour, eggs' ELSE '' END AS content",
)


@query("keyword_label", f"""
WITH {_BUSINESS_SQL}, {_KW_SQL}, {_KWL_SQL} SELECT cluster_id, label, score FROM kwl""")
def keyword_label(spark, sf):
    return naming.keyword_labels(_business(documents(spark, sf)))


@query("top_token_label", f"WITH {D_SQL}, {_TOKL_SQL} SELECT cluster_id, label FROM tokl")
def top_token_label(spark, sf):
    return naming.token_labels(documents(spark, sf))


_CONF_SQL = """least(1e0, greatest(0e0, 6e-1 * least(1e0, n / 50e0) + 4e-1 * CASE
  WHEN label IN ('unlabeled', 'unknown', 'noise') OR starts_with(label, 'cluster_') THEN 3e-1
  WHEN len(regexp_split_to_array(label, ' ')) <= 3 THEN 9e-1 ELSE 6e-1 END))"""


@query("label_confidence", f"""
WITH l AS (SELECT user_id, count(*) AS n, CASE user_id % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN 'cluster_' || user_id
  WHEN 2 THEN 'news' ELSE 'a b c d e' END AS label FROM events GROUP BY user_id)
SELECT user_id, n, label, round({_CONF_SQL}, 6) + 0e0 AS confidence FROM l""")
def label_confidence(spark, sf):
    sized = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    kind = F.col("user_id") % 4
    label = (
        F.when(kind == 0, F.lit("unknown"))
        .when(kind == 1, F.concat(F.lit("cluster_"), F.col("user_id").cast("string")))
        .when(kind == 2, F.lit("news"))
        .otherwise(F.lit("a b c d e"))
    )
    named = sized.withColumn("label", label)
    return named.withColumn("confidence", r6(naming.confidence(F.col("label"), F.col("n"))))


@query("default_labels", f"""
WITH {E_NOISE_SQL} SELECT DISTINCT cluster_id, CASE WHEN cluster_id = -1 THEN 'noise' ELSE 'cluster_' || cluster_id END AS label,
  CASE WHEN cluster_id = -1 THEN 0e0 ELSE 5e-1 END AS confidence FROM e""")
def default_labels(spark, sf):
    return naming.default_labels(vectors(spark, sf, noise=True).select("cluster_id").distinct())


_LABELS_SQL = f"""sizes AS (SELECT cluster_id, count(*) AS n FROM d GROUP BY 1),
named AS (SELECT cluster_id, n, coalesce(kwl.label, tokl.label, 'unlabeled') AS label
          FROM sizes LEFT JOIN kwl USING (cluster_id) LEFT JOIN tokl USING (cluster_id)),
labels AS (SELECT cluster_id, n, label, {_CONF_SQL} AS confidence FROM named)"""


@query("label_clusters", f"""
WITH {_BUSINESS_SQL}, {_KW_SQL}, {_KWL_SQL}, {_TOKL_SQL}, {_LABELS_SQL}
SELECT cluster_id, label, round(confidence, 6) + 0e0 AS confidence, n FROM labels""")
def label_clusters(spark, sf):
    return naming.label_clusters(_business(documents(spark, sf))).select(
        "cluster_id", "label", r6("confidence").alias("confidence"), "n"
    )


@query("label_clusters_responses", f"""
WITH {_BUSINESS_SQL}, {_KW_SQL}, {_KWL_SQL}, {_TOKL_SQL}, sizes AS (SELECT cluster_id, count(*) AS n FROM d GROUP BY 1),
answers AS (SELECT conv_id AS cluster_id, arg_min({normalize_sql(clean_sql('text'))}, turn) AS answer FROM conversations
            WHERE role = 'assistant' GROUP BY 1),
checked AS (SELECT cluster_id, answer, {validate_sql('answer')} AS label FROM answers),
named AS (SELECT cluster_id, n, CASE WHEN c.cluster_id IS NOT NULL AND c.answer IS NULL THEN 'cluster_' || cluster_id
   WHEN c.label NOT IN ('unlabeled', 'unknown') THEN c.label ELSE coalesce(kwl.label, tokl.label, 'unlabeled') END AS label
   FROM sizes LEFT JOIN kwl USING (cluster_id) LEFT JOIN tokl USING (cluster_id) LEFT JOIN checked c USING (cluster_id))
SELECT cluster_id, label, round({_CONF_SQL}, 6) + 0e0 AS confidence, n FROM named""")
def label_clusters_responses(spark, sf):
    answers = responses(spark, sf).where("role = 'assistant'").groupBy(F.col("conv_id").alias("cluster_id")).agg(
        F.min_by(F.struct(text.normalize_label(text.clean_response(F.col("text"))).alias("label")), "turn").alias("a")
    ).select("cluster_id", F.col("a.label").alias("label"))
    return naming.label_clusters(_business(documents(spark, sf)), answers).select(
        "cluster_id", "label", r6("confidence").alias("confidence"), "n"
    )


@query("label_join", f"""
WITH {D_SQL}, {_KW_SQL}, {_KWL_SQL}, {_TOKL_SQL}, {_LABELS_SQL}
SELECT id, coalesce(label, 'unknown') AS label, coalesce(round(confidence, 6) + 0e0, 0e0) AS confidence
FROM d LEFT JOIN labels USING (cluster_id)""")
def label_join(spark, sf):
    docs = documents(spark, sf)
    labels = naming.label_clusters(docs)
    return naming.join_labels(docs, labels).select("id", "label", r6("confidence").alias("confidence"))


@query("label_jaccard", f"""
WITH p AS (SELECT conv_id, turn, {clean_sql('text')} AS a,
                  lag({clean_sql('text')}) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations),
n AS (SELECT conv_id, turn, {strip_sql('lower(a)')} AS a, {strip_sql('lower(b)')} AS b FROM p WHERE b IS NOT NULL),
w AS (SELECT *, list_distinct({words_sql('a')}) AS wa, list_distinct({words_sql('b')}) AS wb FROM n)
SELECT conv_id, turn, round(CASE WHEN a = b OR len(list_distinct(list_concat(wa, wb))) = 0 THEN 1e0
  ELSE len(list_intersect(wa, wb))::DOUBLE / len(list_distinct(list_concat(wa, wb))) END, 6) + 0e0 AS similarity FROM w""")
def label_jaccard(spark, sf):
    from pyspark.sql import Window

    cleaned = responses(spark, sf).select("conv_id", "turn", text.clean_response(F.col("text")).alias("a"))
    pairs = cleaned.withColumn("b", F.lag("a").over(Window.partitionBy("conv_id").orderBy("turn")))
    return pairs.where("b is not null").select(
        "conv_id", "turn", r6(text.label_similarity(F.col("a"), F.col("b"))).alias("similarity")
    )


# Call log: a request is a conversation, its turns are the providers in order.
_TURNS_SQL = """t AS (SELECT conv_id AS request, turn AS priority, role || turn AS provider, length(text) % 3 = 0 AS ok,
  md5(text) AS text, 'no answer in ' || length(text) AS error FROM conversations)"""


def turns(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select(
        F.col("conv_id").alias("request"), F.col("turn").alias("priority"),
        F.concat("role", F.col("turn").cast("string")).alias("provider"),
        (F.length("text") % 3 == 0).alias("ok"), F.md5("text").alias("text"),
        F.concat(F.lit("no answer in "), F.length("text").cast("string")).alias("error"),
    )


@query("first_success", f"""
WITH {_TURNS_SQL}
SELECT request, arg_min(provider, priority) FILTER (WHERE ok) AS provider, arg_min(text, priority) FILTER (WHERE ok) AS answer,
       CASE WHEN NOT bool_or(ok) THEN string_agg(provider || ': ' || error, '; ' ORDER BY priority) END AS errors
FROM t GROUP BY request""")
def first_success(spark, sf):
    return log.first_success(turns(spark, sf))


@query("provider_attempts", f"""
WITH {_TURNS_SQL}, s AS (SELECT request, min(priority) AS stop_at FROM t WHERE ok GROUP BY 1)
SELECT request, priority, provider, ok FROM t LEFT JOIN s USING (request) WHERE stop_at IS NULL OR priority <= stop_at""")
def provider_attempts(spark, sf):
    return log.attempts(turns(spark, sf)).select("request", "priority", "provider", "ok")


@query("provider_stats", f"""
WITH {CALLS_SQL.replace("event_type <> 'error'", "user_id % 3 <> 0")}
SELECT provider, count(*) FILTER (WHERE ok) AS successes, count(*) FILTER (WHERE NOT ok) AS failures,
  round(100e0 * avg(ok::INT), 6) + 0e0 AS success_pct, round(coalesce(avg(latency_ms) FILTER (WHERE ok), 0e0), 6) + 0e0 AS avg_ms
FROM calls GROUP BY 1""")
def provider_stats(spark, sf):
    made = calls(spark, sf).withColumn("ok", F.col("request") % 3 != 0)
    return log.provider_stats(made).select(
        "provider", "successes", "failures", r6("success_pct").alias("success_pct"), r6("avg_ms").alias("avg_ms")
    )


_REWARD = "CASE WHEN ok THEN 5e-1 + 5e-1 * greatest(0e0, 1e0 - latency_ms / 5000e0) ELSE 0e0 END"


@query("call_reward", f"WITH {CALLS_SQL} SELECT call_id, round({_REWARD}, 6) + 0e0 AS reward FROM calls")
def call_reward(spark, sf):
    return calls(spark, sf).select("call_id", r6(log.reward(F.col("ok"), F.col("latency_ms"))).alias("reward"))


@query("arm_stats", f"""
WITH {CALLS_SQL} SELECT provider, count(*) AS pulls, round(avg({_REWARD}), 6) + 0e0 AS avg_reward,
  round(avg(latency_ms), 6) + 0e0 AS avg_cost_ms, round(avg(ok::INT), 6) + 0e0 AS success_rate FROM calls GROUP BY 1""")
def arm_stats(spark, sf):
    return log.arm_stats(calls(spark, sf)).select(
        "provider", "pulls", r6("avg_reward").alias("avg_reward"), r6("avg_cost_ms").alias("avg_cost_ms"),
        r6("success_rate").alias("success_rate"),
    )


@query("ucb_rank", f"""
WITH {CALLS_SQL}, a AS (SELECT provider, count(*) AS pulls, avg({_REWARD}) AS r FROM calls GROUP BY 1),
s AS (SELECT provider, pulls, r + 1e-1 * sqrt(2 * ln(sum(pulls) OVER ()) / pulls) AS score FROM a)
SELECT provider, pulls, round(score, 6) + 0e0 AS score, row_number() OVER (ORDER BY score DESC, provider) AS rank FROM s""")
def ucb_rank(spark, sf):
    return log.ucb_rank(calls(spark, sf)).select("provider", "pulls", r6("score").alias("score"), "rank")


@query("ucb_running", f"""
WITH {CALLS_SQL}, r AS (SELECT call_id, provider, {_REWARD} AS reward FROM calls),
h AS (SELECT call_id, provider, count(*) OVER p AS pulls, sum(reward) OVER p AS total_reward, count(*) OVER a AS total FROM r
  WINDOW p AS (PARTITION BY provider ORDER BY call_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         a AS (ORDER BY call_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT call_id, provider, pulls, total,
  CASE WHEN pulls > 0 THEN round(total_reward / pulls + 1e-1 * sqrt(2 * ln(total) / pulls), 6) + 0e0 END AS score FROM h""")
def ucb_running(spark, sf):
    return log.ucb_running(calls(spark, sf)).select(
        "call_id", "provider", "pulls", "total", r6("score").alias("score")
    )


# Provenance: two naming rounds over all documents; before the second, the long ones move to cluster 0.
_MOVED = "CASE WHEN n_chars >= 800 THEN 0 ELSE cluster_id END"


def _history(spark, sf):
    docs = cut(documents(spark, sf), "docs")
    moved = docs.withColumn("cluster_id", F.expr(_MOVED).cast("int"))
    rounds = []
    for i, part in enumerate((docs, moved)):
        reps = cut(_representatives(part).select("cluster_id", "id", "rank", "content"), "reps")
        rounds.append(provenance.records(naming.label_clusters(part), naming.prompts(reps), reps, i))
    return cut(rounds[0].unionByName(rounds[1]), "history")


_HISTORY_SQL = f"""full_{D_SQL},
{{}}
h AS (SELECT 0 AS iteration, * FROM labels0 UNION ALL SELECT 1, * FROM labels1)"""


def _round_sql(i: int, source: str) -> str:
    """labels{i}: rule-based labels of one round, with every helper table renamed."""
    body = f"d AS (SELECT * FROM {source}), {_KW_SQL}, {_KWL_SQL}, {_TOKL_SQL}, {_LABELS_SQL}"
    return f"labels{i} AS (WITH {body} SELECT cluster_id, label, confidence, n FROM labels),"


_MOVED_D = f"(SELECT * REPLACE (({_MOVED})::INT AS cluster_id) FROM full_d)"
_HISTORY = _HISTORY_SQL.format(_round_sql(0, "full_d") + "\n" + _round_sql(1, _MOVED_D))


@query("provenance_records", f"""
WITH {_HISTORY}, {_EV_SQL}, {reps_sql(0, 'full_d')}, {reps_sql(1, _MOVED_D)},
f AS (SELECT 0 AS iteration, * FROM f0 UNION ALL SELECT 1, * FROM f1),
p AS (SELECT iteration, cluster_id, md5({_PROMPT_SQL}) AS prompt_md5, count(*) AS n_samples FROM f GROUP BY ALL)
SELECT iteration::BIGINT AS iteration, cluster_id, label, 'rule' AS provider, prompt_md5, n_samples, round(confidence, 6) + 0e0 AS confidence,
  round(least(1e0, n / 50e0), 6) + 0e0 AS size_confidence,
  CASE WHEN label IN ('unlabeled', 'unknown', 'noise') THEN 3e-1 ELSE 9e-1 END AS label_quality
FROM h LEFT JOIN p USING (iteration, cluster_id)""")
def provenance_records(spark, sf):
    return _history(spark, sf).select(
        F.col("iteration").cast("bigint").alias("iteration"), "cluster_id", "label", "provider",
        F.md5("prompt").alias("prompt_md5"), F.size("representatives").cast("bigint").alias("n_samples"),
        r6("confidence").alias("confidence"), r6(F.col("breakdown")["size_confidence"]).alias("size_confidence"),
        F.col("breakdown")["label_quality"].alias("label_quality"),
    )


@query("label_history", f"""
WITH {_HISTORY}, l AS (SELECT *, lag(label) OVER (PARTITION BY cluster_id ORDER BY iteration) AS prev_label FROM h)
SELECT cluster_id, iteration::BIGINT AS iteration, prev_label, label AS new_label FROM l WHERE prev_label <> label""")
def label_history(spark, sf):
    return provenance.label_changes(_history(spark, sf)).select(
        "cluster_id", F.col("iteration").cast("bigint").alias("iteration"), "prev_label", "new_label"
    )


_EXPLAINED = """sized AS (SELECT cluster_id, count(*) AS n FROM full_d GROUP BY 1),
x AS (SELECT cluster_id, 'rows: ' || n AS explanation FROM sized WHERE n >= (SELECT avg(n) FROM sized))"""


@query("provenance_report", f"""
WITH {_HISTORY}, {_EXPLAINED}, last AS (SELECT cluster_id, arg_max(confidence, iteration) AS confidence FROM h GROUP BY 1)
SELECT count(*) AS total_labels_generated, count(*) FILTER (WHERE cluster_id IN (SELECT cluster_id FROM x)) AS total_labels_explained,
       round(avg(confidence), 6) + 0e0 AS avg_confidence FROM last""")
def provenance_report(spark, sf):
    explained = _explanations(spark, sf)
    return provenance.report(provenance.with_explanations(_history(spark, sf), explained)).select(
        "total_labels_generated", "total_labels_explained", r6("avg_confidence").alias("avg_confidence")
    )


def _explanations(spark, sf):
    """Explanations of the clusters that have at least the mean number of rows."""
    sizes = documents(spark, sf).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(sizes.agg(F.avg("n").alias("mean")), F.col("n") >= F.col("mean")).select(
        "cluster_id", F.concat(F.lit("rows: "), F.col("n").cast("string")).alias("explanation")
    )


@query("explanations_join", f"""
WITH {_HISTORY}, {_EXPLAINED}
SELECT iteration::BIGINT AS iteration, cluster_id, coalesce(explanation, '') AS explanation FROM h LEFT JOIN x USING (cluster_id)""")
def explanations_join(spark, sf):
    return provenance.with_explanations(_history(spark, sf), _explanations(spark, sf)).select(
        F.col("iteration").cast("bigint").alias("iteration"), "cluster_id", "explanation"
    )
