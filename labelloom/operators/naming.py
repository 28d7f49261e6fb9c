"""Naming clusters: representatives, prompts, keyword and token labels, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.text import count_substrings, validate_label, words
from labelloom.functions.vectors import centroids, distance
from labelloom.scratch import settle

# Keyword lists per domain label, earlier domain wins a tie.
DOMAIN_KEYWORDS = {
    "business performance": [
        "revenue", "stock", "market", "profit", "sales", "earnings", "margin", "analyst",
    ],
    "ai ml concepts": [
        "machine", "learning", "neural", "transformer", "nlp", "model", "models", "vision",
    ],
    "cooking instructions": [
        "recipe", "bake", "flour", "egg", "eggs", "sugar", "butter", "ingredients", "mixing",
    ],
    "marine species": [
        "species", "fish", "dolphin", "marine", "sea", "ocean", "biologists", "cetacean",
    ],
}

# Words that never become a token label.
STOPWORDS = [
    "the", "and", "for", "with", "that", "this", "from", "into", "were", "was", "are", "have",
    "has", "had", "their", "them", "they", "then", "than", "about", "over", "under", "after",
    "before", "during", "while", "onto", "between", "among", "found", "identified", "newly",
    "discovered", "calls", "requires",
]

TOKEN = "([a-zA-Z][a-zA-Z-]{2,})"
EMPTY_PROMPT = "No samples were given. Name their shared topic in one to three words."


def cluster_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


def centroid_distances(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Distance of every row to the centroid of its own group (noise is a group too)."""
    centres = settle(centroids(df, "cluster_id"), "centroids")
    return df.join(centres.drop("n"), "cluster_id").select(
        "cluster_id", "id", *(keep or []), distance(F.col("v"), F.col("centroid")).alias("distance")
    )


def representatives(df: DataFrame, k: int = 5, keep: list[str] | None = None) -> DataFrame:
    """The k rows of every cluster nearest to its centroid, ties to the smaller id.

    The rank filter cuts every task's rows to k per cluster before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("cluster_id").orderBy("distance", "id"))
    near = centroid_distances(df.where("cluster_id >= 0"), keep)
    return near.withColumn("rank", rank).where(F.col("rank") <= k)


def prompts(reps: DataFrame) -> DataFrame:
    """One prompt per cluster from (cluster_id, rank, content); samples cut at 200 characters."""
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", F.substring("content", 1, 200).alias("text")))),
        lambda s: F.concat(s["rank"].cast("string"), F.lit(". "), s["text"]),
    )
    return reps.groupBy("cluster_id").agg(
        F.concat(
            F.lit("Which topic do these samples share?\n"),
            F.array_join(lines, "\n"),
            F.lit("\nAnswer with one to three words only.\nTopic:"),
        ).alias("prompt")
    )


def keyword_scores(df: DataFrame) -> DataFrame:
    """Occurrences of every domain's keywords per cluster, one row per cluster."""
    low = F.lower("content")
    return df.groupBy("cluster_id").agg(
        *[
            F.sum(count_substrings(low, keywords)).alias(f"s{i}")
            for i, keywords in enumerate(DOMAIN_KEYWORDS.values())
        ]
    )


def keyword_labels(df: DataFrame) -> DataFrame:
    """(cluster_id, label, score): best scoring domain, NULL label when nothing occurs."""
    names = list(DOMAIN_KEYWORDS)
    best = F.greatest(*[F.col(f"s{i}") for i in range(len(names))])
    label = F.coalesce(*[F.when(F.col(f"s{i}") == best, F.lit(n)) for i, n in enumerate(names)])
    return keyword_scores(df).select(
        "cluster_id", F.when(best > 0, label).alias("label"), best.alias("score")
    )


def label_tokens(content: Column) -> Column:
    return F.regexp_extract_all(F.lower(content), F.lit(TOKEN), F.lit(1))


def token_labels(df: DataFrame, top: int = 2) -> DataFrame:
    """(cluster_id, label): most common tokens, ties by first appearance.

    Counts and first rows are plain partial sums over numbers.  The place inside
    a row only matters between tokens that tie in both, so only the rows in
    which such tokens first appear are looked at again.
    """
    tokens = df.select("cluster_id", "id", F.explode(label_tokens(F.col("content"))).alias("token")).where(
        ~F.col("token").isin(STOPWORDS)
    )
    counts = tokens.groupBy("cluster_id", "token").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first")
    )
    place = F.rank().over(Window.partitionBy("cluster_id").orderBy(F.desc("n"), "first"))
    best = settle(counts.withColumn("place", place).where(F.col("place") <= top), "token_candidates")
    tied = best.groupBy("cluster_id", "place").count().where(F.col("count") > 1)
    if tied.isEmpty():
        ordered = best.withColumn("ix", F.lit(0))
    else:
        again = df.join(best.select("cluster_id", F.col("first").alias("id")).distinct(), ["cluster_id", "id"])
        places = again.select(
            "cluster_id", F.col("id").alias("first"), F.posexplode(label_tokens(F.col("content"))).alias("ix", "token")
        )
        ordered = (
            places.join(best, ["cluster_id", "first", "token"])
            .groupBy("cluster_id", "token", "n", "first")
            .agg(F.min("ix").alias("ix"))
        )
    rank = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("n"), "first", "ix"))
    kept = ordered.withColumn("rank", rank).where(F.col("rank") <= top)
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "token"))), lambda s: s["token"]), " "
    )
    return kept.groupBy("cluster_id").agg(joined.alias("label"))


def confidence(label: Column, size: Column) -> Column:
    """0.6 times the size part (full at 50 rows) plus 0.4 times the label part."""
    weak = label.isin("unlabeled", "unknown", "noise") | label.startswith("cluster_")
    quality = label_quality(label, weak)
    total = F.lit(0.6) * F.least(F.lit(1.0), size / F.lit(50.0)) + F.lit(0.4) * quality
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), total))


def label_quality(label: Column, weak: Column | None = None) -> Column:
    if weak is None:
        weak = label.isin("unlabeled", "unknown", "noise") | label.startswith("cluster_")
    return (
        F.when(weak, F.lit(0.3)).when(F.size(words(label)) <= 3, F.lit(0.9)).otherwise(F.lit(0.6))
    )


def default_labels(clusters: DataFrame) -> DataFrame:
    """``cluster_N`` with 0.5 and ``noise`` with 0 for a table of cluster ids."""
    noise = F.col("cluster_id") == -1
    return clusters.select(
        "cluster_id",
        F.when(noise, F.lit("noise"))
        .otherwise(F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string")))
        .alias("label"),
        F.when(noise, F.lit(0.0)).otherwise(F.lit(0.5)).alias("confidence"),
    )


def label_clusters(df: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """(cluster_id, label, confidence, n) for every cluster of (cluster_id, id, content).

    ``responses`` (cluster_id, label) holds the namer's normalised answers; a
    NULL answer is a failed call and gives ``cluster_N``.  A weak answer, and
    every cluster when there are no responses, is named by keywords, then by
    tokens.  Noise is always ``noise`` with confidence 0.
    """
    sizes = cluster_sizes(df)
    real = df.where("cluster_id >= 0")
    rule = (
        sizes.join(keyword_labels(real).select("cluster_id", F.col("label").alias("kw")), "cluster_id", "left")
        .join(token_labels(real).select("cluster_id", F.col("label").alias("tok")), "cluster_id", "left")
        .withColumn("rule", F.coalesce("kw", "tok", F.lit("unlabeled")))
    )
    if responses is None:
        named = rule.withColumn("label", F.col("rule"))
    else:
        given = responses.select("cluster_id", F.col("label").alias("answer"), F.lit(True).alias("asked"))
        checked = validate_label(F.col("answer"))
        named = rule.join(given, "cluster_id", "left").withColumn(
            "label",
            F.when(
                F.col("asked") & F.col("answer").isNull(),
                F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string")),
            )
            .when(F.col("asked") & ~checked.isin("unlabeled", "unknown"), checked)
            .otherwise(F.col("rule")),
        )
    noise = F.col("cluster_id") == -1
    return named.select(
        "cluster_id",
        F.when(noise, F.lit("noise")).otherwise(F.col("label")).alias("label"),
        F.when(noise, F.lit(0.0)).otherwise(confidence(F.col("label"), F.col("n"))).alias("confidence"),
        "n",
    )


def join_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Attach label and confidence; clusters without one give ('unknown', 0)."""
    small = settle(labels.select("cluster_id", "label", "confidence"), "cluster_labels")
    return (
        df.join(small, "cluster_id", "left")
        .withColumn("label", F.coalesce("label", F.lit("unknown")))
        .withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    )
