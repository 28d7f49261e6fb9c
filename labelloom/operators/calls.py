"""Analytics over a log of namer calls.

Calls: call_id BIGINT, request BIGINT, provider STRING, priority BIGINT,
ok BOOLEAN, latency_ms DOUBLE, and optionally text and error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.scratch import settle


def first_success(calls: DataFrame, text: str = "text", error: str = "error") -> DataFrame:
    """Per request: the answer of the first successful call in priority order, or all errors.

    Both parts are partial aggregates; the error list only covers requests
    without a success and its length is the number of providers.
    """
    won = calls.groupBy("request").agg(
        F.min_by(F.struct("priority", "provider", text), F.when(F.col("ok"), F.col("priority"))).alias("win"),
        F.max("ok").alias("any_ok"),
    )
    failed = (
        calls.join(won.where("not any_ok").select("request"), "request")
        .groupBy("request")
        .agg(F.array_sort(F.collect_list(F.struct("priority", "provider", error))).alias("all"))
        .select(
            "request",
            F.array_join(
                F.transform("all", lambda s: F.concat(s["provider"], F.lit(": "), s[error])), "; "
            ).alias("errors"),
        )
    )
    return won.join(failed, "request", "left").select(
        "request",
        F.when(F.col("any_ok"), F.col("win.provider")).alias("provider"),
        F.when(F.col("any_ok"), F.col(f"win.{text}")).alias("answer"),
        "errors",
    )


def attempts(calls: DataFrame) -> DataFrame:
    """Calls that were really made: up to and including the request's first success."""
    first_ok = calls.where("ok").groupBy("request").agg(F.min("priority").alias("stop_at"))
    return (
        calls.join(first_ok, "request", "left")
        .where(F.col("stop_at").isNull() | (F.col("priority") <= F.col("stop_at")))
        .drop("stop_at")
    )


def provider_stats(calls: DataFrame) -> DataFrame:
    """Successes, failures, success percentage and mean time of the successes."""
    ok = F.col("ok")
    return calls.groupBy("provider").agg(
        F.count_if(ok).alias("successes"),
        F.count_if(~ok).alias("failures"),
        (F.lit(100.0) * F.avg(ok.cast("double"))).alias("success_pct"),
        F.coalesce(F.avg(F.when(ok, F.col("latency_ms"))), F.lit(0.0)).alias("avg_ms"),
    )


def reward(ok: Column, latency_ms: Column, quality_weight: float = 0.5) -> Column:
    """0 for a failure, otherwise the quality weight plus a bonus for speed below 5 s."""
    bonus = F.greatest(F.lit(0.0), F.lit(1.0) - latency_ms / F.lit(5000.0))
    return F.when(ok, F.lit(quality_weight) + F.lit(1 - quality_weight) * bonus).otherwise(F.lit(0.0))


def arm_stats(calls: DataFrame, quality_weight: float = 0.5, providers: DataFrame | None = None) -> DataFrame:
    """Pulls, mean reward, mean cost and success rate; a provider without calls costs infinity."""
    stats = calls.groupBy("provider").agg(
        F.count(F.lit(1)).alias("pulls"),
        F.avg(reward(F.col("ok"), F.col("latency_ms"), quality_weight)).alias("avg_reward"),
        F.avg("latency_ms").alias("avg_cost_ms"),
        F.avg(F.col("ok").cast("double")).alias("success_rate"),
    )
    if providers is None:
        return stats
    return providers.join(stats, "provider", "left").select(
        "provider",
        F.coalesce("pulls", F.lit(0)).alias("pulls"),
        F.coalesce("avg_reward", F.lit(0.0)).alias("avg_reward"),
        F.coalesce("avg_cost_ms", F.lit(float("inf"))).alias("avg_cost_ms"),
        F.coalesce("success_rate", F.lit(0.0)).alias("success_rate"),
    )


def upper_bound(avg_reward: Column, pulls: Column, total: Column, exploration: float) -> Column:
    return avg_reward + F.lit(exploration) * F.sqrt(F.lit(2.0) * F.log(total) / pulls)


def ucb_rank(
    calls: DataFrame, exploration: float = 0.1, quality_weight: float = 0.5,
    providers: DataFrame | None = None,
) -> DataFrame:
    """Providers ranked for the next call: unused ones first, then by upper confidence bound."""
    arms = settle(arm_stats(calls, quality_weight, providers), "arms")
    total = arms.agg(F.sum("pulls").alias("n")).first().n or 0
    scored = arms.withColumn(
        "score",
        F.when(
            F.col("pulls") > 0,
            upper_bound(F.col("avg_reward"), F.col("pulls"), F.lit(float(max(total, 1))), exploration),
        ),
    )
    # One row per provider.
    order = Window.orderBy(F.desc_nulls_first("score"), "provider")
    return scored.select(
        "provider", "pulls", "score", F.row_number().over(order).cast("bigint").alias("rank")
    )


def ucb_running(
    calls: DataFrame, exploration: float = 0.1, quality_weight: float = 0.5, bucket_rows: int = 4096
) -> DataFrame:
    """Score of the chosen provider just before every logged call, in call_id order.

    Running sums are built in two steps, per range of call ids and inside a
    range, so neither a busy provider nor the whole log is one window.
    """
    scored = calls.select(
        "call_id", "provider",
        reward(F.col("ok"), F.col("latency_ms"), quality_weight).alias("reward"),
        F.floor(F.col("call_id") / F.lit(bucket_rows)).cast("bigint").alias("bucket"),
    )
    sums = scored.groupBy("bucket", "provider").agg(
        F.count(F.lit(1)).alias("n"), F.sum("reward").alias("r")
    )
    earlier = lambda w: w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_provider = sums.select(
        "bucket", "provider",
        F.coalesce(F.sum("n").over(earlier(Window.partitionBy("provider"))), F.lit(0)).alias("pulls0"),
        F.coalesce(F.sum("r").over(earlier(Window.partitionBy("provider"))), F.lit(0.0)).alias("reward0"),
    )
    # One row per range of ids.
    overall = sums.groupBy("bucket").agg(F.sum("n").alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(earlier(Window)), F.lit(0)).alias("total0")
    )
    inside = lambda *keys: (
        Window.partitionBy(*keys).orderBy("call_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    within = scored.select(
        "call_id", "provider", "bucket",
        F.count(F.lit(1)).over(inside("bucket", "provider")).alias("pulls1"),
        F.coalesce(F.sum("reward").over(inside("bucket", "provider")), F.lit(0.0)).alias("reward1"),
        F.count(F.lit(1)).over(inside("bucket")).alias("total1"),
    )
    pulls, total = F.col("pulls0") + F.col("pulls1"), F.col("total0") + F.col("total1")
    mean = (F.col("reward0") + F.col("reward1")) / pulls
    return within.join(per_provider, ["bucket", "provider"]).join(overall, "bucket").select(
        "call_id", "provider", pulls.alias("pulls"), total.alias("total"),
        F.when(pulls > 0, upper_bound(mean, pulls, total, exploration)).alias("score"),
    )
