"""Quantiles, agreement measures, dataset statistics and review tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.vectors import centroids, cosine, norm
from labelloom.scratch import settle

BUILTIN_ROWS = 1_000_000
HISTOGRAM_BINS = 4096


def _order_statistic(values: DataFrame, rank: int, low: float, high: float) -> float:
    """The value with ``rank`` smaller or equal ones before it, by narrowing histograms.

    Each pass counts rows per bin; the driver sees at most HISTOGRAM_BINS counts.
    """
    before = 0
    while low < high:
        width = (high - low) / HISTOGRAM_BINS
        inside = values.where((F.col("x") >= low) & (F.col("x") <= high))
        if width == 0 or low + width == low:
            break
        bin_no = F.least(F.floor((F.col("x") - low) / width), F.lit(HISTOGRAM_BINS - 1))
        bins = sorted(
            inside.groupBy(bin_no.alias("bin")).agg(
                F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
            ).collect()
        )
        for b in bins:
            if before + b.n > rank:
                low, high = b.low, b.high
                break
            before += b.n
    return low


def quantile(df: DataFrame, column: str, q: float, builtin_rows: int = BUILTIN_ROWS) -> float | None:
    """Exact quantile with linear interpolation; NULL values are ignored.

    The built-in keeps all distinct values in one place, so it is only used up
    to ``builtin_rows`` rows.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where("x is not null")
    span = values.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    if span.n == 0:
        return None
    if span.n <= builtin_rows:
        return values.agg(F.percentile("x", F.lit(float(q))).alias("p")).first().p
    at = q * (span.n - 1)
    lower = _order_statistic(values, math.floor(at), span.low, span.high)
    upper = _order_statistic(values, math.ceil(at), span.low, span.high)
    return lower + (upper - lower) * (at - math.floor(at))


def noise_ratio(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return df.agg(
        F.coalesce(F.avg((F.col(cluster) == -1).cast("double")), F.lit(0.0)).alias("noise_ratio")
    )


def cluster_distribution(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))


def purity(df: DataFrame, cluster: str = "cluster_id", v: str = "v") -> DataFrame:
    """Mean over clusters of two or more rows of the mean cosine to the centroid.

    A cluster with a zero vector or a zero centroid is left out.
    """
    members = df.where(F.col(cluster) >= 0)
    centres = settle(
        centroids(members, cluster, v).where((F.col("n") >= 2) & (norm(F.col("centroid")) > 0)),
        "purity_centroids",
    )
    per_cluster = (
        members.join(centres, cluster)
        .groupBy(cluster)
        .agg(
            F.avg(cosine(F.col(v), F.col("centroid"))).alias("mean_cosine"),
            F.count_if(norm(F.col(v)) == 0).alias("n_zero"),
        )
        .where("n_zero = 0")
    )
    return per_cluster.agg(F.coalesce(F.avg("mean_cosine"), F.lit(0.0)).alias("purity"))


def _contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    return (
        df.where((F.col(a) >= 0) & (F.col(b) >= 0))
        .groupBy(F.col(a).alias("a"), F.col(b).alias("b"))
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labellings of the same rows; noise in either is left out."""
    cells = settle(_contingency(df, a, b), "contingency")
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0.0)).alias("n"), F.sum(F.col("n") * F.col("n")).alias("s"))
    rows = cells.groupBy("a").agg(F.sum("n").alias("n")).agg(F.sum(F.col("n") * F.col("n")).alias("sa"))
    cols = cells.groupBy("b").agg(F.sum("n").alias("n")).agg(F.sum(F.col("n") * F.col("n")).alias("sb"))
    t, ra, cb = total.first(), rows.first(), cols.first()
    n, s, sa, sb = t.n, t.s or 0.0, ra.sa or 0.0, cb.sb or 0.0
    tp, fp, fn, tn = s - n, sb - s, sa - s, n * n - sa - sb + s
    if n < 2:
        value = 0.0
    elif fp == 0 and fn == 0:
        value = 1.0
    else:
        value = 2 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn))
    return df.sparkSession.createDataFrame([(float(value),)], "adjusted_rand double")


def nmi(df: DataFrame, a: str, b: str) -> DataFrame:
    """Normalised mutual information with the arithmetic mean of the entropies."""
    cells = settle(_contingency(df, a, b), "contingency")
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0.0)).alias("n")).first().n

    def entropy(side: str) -> tuple[float, int]:
        p = F.col("n") / total
        r = cells.groupBy(side).agg(F.sum("n").alias("n")).agg(
            F.sum(-p * F.log(p)).alias("h"), F.count(F.lit(1)).alias("k")
        ).first()
        return r.h, r.k

    if total < 2:
        value = 0.0
    else:
        (ha, ka), (hb, kb) = entropy("a"), entropy("b")
        p = F.col("n") / total
        hab = cells.agg(F.sum(-p * F.log(p)).alias("h")).first().h
        mutual = max(0.0, ha + hb - hab)
        value = 1.0 if ka == kb == 1 else (mutual / ((ha + hb) / 2) if ha + hb > 0 else 0.0)
    return df.sparkSession.createDataFrame([(float(value),)], "nmi double")


def score_stats(df: DataFrame, score: str) -> DataFrame:
    """Mean, population deviation, extremes and median of a score; zeros when empty."""
    middle = quantile(df, score, 0.5)
    c = F.col(score)
    return df.agg(
        *[
            F.coalesce(expr, F.lit(0.0)).alias(name)
            for name, expr in (
                ("mean", F.avg(c)), ("std", F.stddev_pop(c)), ("min", F.min(c)), ("max", F.max(c)),
            )
        ]
    ).withColumn("median", F.lit(middle if middle is not None else 0.0))


def dataset_stats(labeled: DataFrame) -> DataFrame:
    """One row of counts and score statistics of a labelled table."""
    zero = F.lit(0.0)
    return labeled.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_distinct(F.when(F.col("cluster_id") >= 0, F.col("cluster_id"))).alias("n_clusters"),
        F.count_if(F.col("cluster_id") == -1).alias("n_noise"),
        F.count_if("anomaly_flag").alias("n_anomalies"),
        F.count_if("duplicate_flag").alias("n_duplicates"),
        F.coalesce(F.avg("quality_score"), zero).alias("quality_mean"),
        F.coalesce(F.stddev_pop("quality_score"), zero).alias("quality_std"),
        F.coalesce(F.avg("confidence"), zero).alias("confidence_mean"),
        F.coalesce(F.stddev_pop("confidence"), zero).alias("confidence_std"),
    )


def label_distribution(labeled: DataFrame) -> DataFrame:
    return labeled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, score: str, bins: int = 30) -> DataFrame:
    """Counts per equal bin between the smallest and largest score; the last bin is closed."""
    span = df.agg(F.min(score).alias("low"), F.max(score).alias("high")).first()
    low, high = span.low, span.high
    if low is None:
        return df.select(F.lit(0).cast("bigint").alias("bin"), F.lit(0).cast("bigint").alias("n")).where("false")
    if low == high:
        low, high = low - 0.5, high + 0.5
    bin_no = F.least(
        F.width_bucket(F.col(score), F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins).cast("bigint")
    )
    return df.groupBy(bin_no.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def cluster_ranking(labeled: DataFrame, order: str = "id") -> DataFrame:
    """Size and first label of every cluster, noise left out; sort by size to rank."""
    return (
        labeled.where("cluster_id >= 0")
        .groupBy("cluster_id")
        .agg(F.count(F.lit(1)).alias("size"), F.min_by("label", order).alias("label"))
    )


def review_sample(
    labeled: DataFrame, ends: int = 3, middle: int = 4, seed: int = 42, id_: str = "id"
) -> DataFrame:
    """A report of the most and least confident rows and some hashed picks between them."""
    keyed = labeled.withColumn("_key", F.md5(F.concat(F.col(id_).cast("string"), F.lit(f":{seed}"))))
    high = keyed.orderBy(F.desc("confidence"), F.desc(id_)).limit(ends)
    low = keyed.orderBy("confidence", id_).limit(ends)
    taken = settle(high.select(id_).union(low.select(id_)).distinct(), "review_ends")
    between = keyed.join(taken, id_, "left_anti").orderBy("_key", id_).limit(middle)
    return (
        high.withColumn("grp", F.lit("high confidence"))
        .unionByName(between.withColumn("grp", F.lit("middle")))
        .unionByName(low.withColumn("grp", F.lit("low confidence")))
        .drop("_key")
    )
