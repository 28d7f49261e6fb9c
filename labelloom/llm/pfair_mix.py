"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL functions only.

The documents of a source stand in a fixed order (hash of the key) and are cut into blocks of equal bytes. All
sources are consumed together in an ideal flow in which each active source gets its weight's share of every slot;
a source that runs out leaves its share to the others. In that flow block k of a source with weight w runs from
virtual time k / w to (k + 1) / w, and virtual time v is real time T(v) = sum over sources of min(w v, blocks).
So the block is released at floor T(k / w) and due at ceil T((k + 1) / w). Earliest deadline first serves one
released block per slot. As the flow itself meets every window, so does this schedule, and no source is ever a
whole block ahead of or behind its share.

Documents are only counted and summed to find blocks; the schedule is a fold over block numbers of all sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.common import cut

BLOCK_BYTES = 1024 * 1024
#: Hash ranges into which every source is cut for its running sums.
BUCKETS = 4096
#: Slots that the fold appends at once.
FRAME = 256


def _size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def blocks(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
           block_bytes: int = BLOCK_BYTES, whole: bool = False) -> DataFrame:
    """(key, source, size, offset, block[, row]): place of every document in its source; ``whole`` adds all columns as ``row``.

    The offset is a running sum of sizes (UTF-8 bytes plus one) in the order of md5(key), key. It is summed in
    BUCKETS hash ranges of each source, so a hot source is never one window. Null sources count as ''.
    """
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(source), F.lit("")).alias("source"), _size(text).alias("size"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("h"), *([F.struct(*docs.columns).alias("row")] if whole else []),
    )
    leading = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    placed = rows.withColumn("bucket", F.floor(leading * F.lit(BUCKETS) / F.lit(2**32)))
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("bytes"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    before = sums.select("source", "bucket", (F.sum("bytes").over(upto) - F.col("bytes")).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "key", "size").rowsBetween(Window.unboundedPreceding, 0)
    offset = F.col("before") + F.col("running") - F.col("size")
    return (
        placed.withColumn("running", F.sum("size").over(inside)).join(before, ["source", "bucket"])
        .select("key", "source", "size", offset.alias("offset"), F.floor(offset / F.lit(block_bytes)).alias("block"), *(["row"] if whole else []))
    )


_TIME = "aggregate(zip_with(w, b, (x, y) -> least(x * ({v}), cast(y as double))), 0D, (x, y) -> x + y)"


def _release(i: str, k: str) -> str:
    return f"cast(floor({_TIME.format(v=f'({k}) / w[{i}]')} + 1e-9) as bigint)"


def _deadline(i: str, k: str) -> str:
    return f"cast(ceil({_TIME.format(v=f'({k} + 1) / w[{i}]')} - 1e-9) as bigint)"


def schedule(sources: DataFrame) -> DataFrame:
    """(source, block, slot, release, deadline) for sources given as (source, weight, blocks).

    Weights are relative; missing and non-positive ones count as a billionth of the sum, so that such sources
    follow when the others have run out. Sources without blocks are passed over.
    """
    row = (
        sources.where("blocks > 0").groupBy()
        .agg(F.array_sort(F.collect_list(F.struct(F.col("source"), F.coalesce("weight", F.lit(0.0)).cast("double").alias("w"), F.col("blocks").cast("long").alias("b")))).alias("all"))
        .select("all", F.expr("aggregate(all, 0D, (x, s) -> x + greatest(s.w, 0D))").alias("sum"))
        .select(
            F.expr("transform(all, s -> s.source)").alias("names"),
            F.expr("transform(all, s -> greatest(s.w, if(sum > 0, sum, 1D) * 1e-9))").alias("w"),
            F.expr("transform(all, s -> s.b)").alias("b"),
            F.expr("sequence(0, size(all) - 1)").alias("ids"),
            F.expr("aggregate(all, 0L, (x, s) -> x + s.b)").alias("n"),
        )
        .where("n > 0")
    )
    pick = (
        "array_min(transform(filter(ids, i -> a.done[i] < b[i] and a.r[i] <= a.t),"
        " i -> named_struct('d', a.d[i], 'i', i))).i"
    )
    served = (
        "named_struct('t', a.t + 1L, 'done', transform(a.done, (x, i) -> if(i = p, x + 1L, x)),"
        f" 'r', transform(a.r, (x, i) -> if(i = p, {_release('i', 'a.done[i] + 1L')}, x)),"
        f" 'd', transform(a.d, (x, i) -> if(i = p, {_deadline('i', 'a.done[i] + 1L')}, x)),"
        " 'seq', concat(a.seq, array(named_struct('i', p, 'k', a.done[p], 'r', a.r[p], 'd', a.d[p]))))"
    )
    item = "struct<i:int,k:bigint,r:bigint,d:bigint>"
    frame = (
        f"aggregate(sequence(1L, least({FRAME}L, n - s.t)),"
        f" named_struct('t', s.t, 'done', s.done, 'r', s.r, 'd', s.d, 'seq', cast(array() as array<{item}>)),"
        f" (a, j) -> transform(array({pick}), p -> {served})[0],"
        " a -> named_struct('t', a.t, 'done', a.done, 'r', a.r, 'd', a.d, 'out', concat(s.out, array(a.seq))))"
    )
    fold = (
        f"aggregate(sequence(0L, cast(floor((n - 1) / {FRAME}) as bigint)),"
        f" named_struct('t', 0L, 'done', transform(b, x -> 0L), 'r', transform(b, x -> 0L),"
        f" 'd', transform(ids, i -> {_deadline('i', '0L')}), 'out', cast(array() as array<array<{item}>>)),"
        f" (s, f) -> {frame}, s -> s.out)"
    )
    frames = row.select("names", F.posexplode(F.expr(fold)).alias("f", "seq"))
    return frames.select("names", "f", F.posexplode("seq").alias("j", "e")).select(
        F.expr("names[e.i]").alias("source"), F.col("e.k").alias("block"),
        (F.col("f").cast("long") * FRAME + F.col("j")).alias("slot"), F.col("e.r").alias("release"), F.col("e.d").alias("deadline"),
    )


def _planned(sizes: DataFrame, weights: DataFrame | None) -> DataFrame:
    """Schedule of sources given as (source, bytes, blocks)."""
    if weights is None:
        return schedule(sizes.select("source", F.sqrt("bytes").alias("weight"), "blocks"))
    wanted = weights.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.sum("weight").alias("weight"))
    return schedule(sizes.join(wanted, "source", "left").select("source", "weight", "blocks"))


def _sizes(rows: DataFrame, block_bytes: int) -> DataFrame:
    return rows.groupBy("source").agg(F.sum("size").alias("bytes"), F.ceil(F.sum("size") / F.lit(block_bytes)).alias("blocks"))


def in_mixed_order(docs: DataFrame, weights: DataFrame | None = None, key: str = "doc_id", source: str = "source", text: str = "text",
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Whole rows of ``docs`` in the mixed order of ``mix``: ranges of slots, sorted within each.

    Every row comes out once, with all its columns, whatever their names and however often its key occurs; rows with
    null keys have their place too. Rows travel with their place instead of being joined back by key.
    """
    size = docs.select(F.coalesce(F.col(source), F.lit("")).alias("source"), _size(text).alias("size"))
    plan = cut(_planned(_sizes(size, block_bytes), weights).select("source", "block", "slot"), "schedule")
    placed = blocks(docs, key, source, text, block_bytes, whole=True).join(plan, ["source", "block"])
    return placed.select("slot", "offset", "row").repartitionByRange("slot").sortWithinPartitions("slot", "offset").select("row.*")


def mix(docs: DataFrame, weights: DataFrame | None = None, key: str = "doc_id", source: str = "source", text: str = "text",
        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, source, block, slot, release, deadline, offset): every document once, in the slot of its block.

    The mixed order is by slot, then offset. ``weights`` has columns source and weight; without it a source weighs
    the square root of its bytes. A block of no document (inside a text longer than a block) keeps its slot.
    Rows with equal keys stand side by side. An empty table gives no rows. Other columns are not read.
    """
    placed = blocks(docs, key, source, text, block_bytes)
    return placed.join(_planned(_sizes(placed, block_bytes), weights), ["source", "block"]).select(
        F.col("key").alias(key), F.col("source").alias(source), "block", "slot", "release", "deadline", "offset",
    )
