"""Global shuffle of records into shards in two passes.

Pass one scatters records by a seeded hash of their key into buckets that fit a task's memory. Pass two draws a
Fisher-Yates permutation of each bucket from a generator seeded with the bucket's number. Buckets in a row, each
permuted, are a uniform random order of all records. Records are numbered in that order and cut into shards whose
row counts differ by at most one.

The scatter depends on a hash of key and text only, so no hot source or group of copies fills one bucket;
only rows that are equal in both meet there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from labelloom.llm.common import whole_runs
from labelloom.scratch import new_path

#: Bytes of text that a bucket should hold.
BUCKET_BYTES = 16 * 1024 * 1024
SEED = 20_240_229


def permutation(n: int, seed: int, bucket: int) -> np.ndarray:
    """Fisher-Yates order of n records, the same for the same seed and bucket on every machine."""
    return np.random.Generator(np.random.PCG64([seed, bucket, n])).permutation(n)


def shuffled(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = SEED,
             bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Null texts and null keys are ordinary values. Rows with equal key and text keep an arbitrary order among
    themselves. An empty table stays empty. Columns called shard, slot, _bucket, _at or _all are not allowed.
    """
    clash = {"shard", "slot", "_bucket", "_at", "_all"} & set(docs.columns)
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 16)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    hashed = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    scattered = docs.withColumn("_bucket", F.pmod(hashed, F.lit(buckets)))
    counts = scattered.groupBy("_bucket").agg(F.count(F.lit(1)).alias("rows"))
    # One marker row per bucket travels with its records: where the bucket begins in the global order, and how many
    # records there are. So the records need no join, whatever the number of buckets.
    order = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    names = docs.columns
    markers = counts.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields], "_bucket",
        (F.sum("rows").over(order) - F.col("rows")).alias("_at"), F.sum("rows").over(Window.partitionBy()).alias("_all"),
    )
    nothing = F.lit(None).cast("long")
    every = scattered.select(*names, "_bucket", nothing.alias("_at"), nothing.alias("_all")).unionAll(markers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, lambda t: t.column("_bucket").to_numpy(), 1):
            numbers = table.column("_bucket").to_numpy()
            starts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])
            for at, end in zip(starts, np.r_[starts[1:], numbers.size], strict=True):
                marker, n = table.slice(at, 1), int(end - at) - 1
                before, total = marker.column("_at")[0].as_py(), marker.column("_all")[0].as_py()
                part = table.slice(at + 1, n).take(pa.array(permutation(n, seed, int(numbers[at]))))
                part = part.set_column(len(names) + 1, "_at", pa.array(np.arange(before, before + n)))
                part = part.set_column(len(names) + 2, "_all", pa.array(np.full(n, total)))
                yield from part.combine_chunks().to_batches(max_chunksize=4096)

    schema = StructType([StructField(f.name, f.dataType, True) for f in every.schema.fields])
    placed = (
        every.repartition(F.col("_bucket")).sortWithinPartitions("_bucket", F.col("_at").isNull(), hashed, key)
        .mapInArrow(run, schema)
    )
    at = F.col("_at")
    # Shards 0 .. r - 1 take q + 1 rows, the others q.
    q = F.floor(F.col("_all") / F.lit(shards))
    r = F.col("_all") % shards
    in_large = at < r * (q + 1)
    large = F.floor(at / (q + 1))
    small = r + F.floor((at - r * (q + 1)) / F.greatest(q, F.lit(1)))
    numbered = placed.withColumn("shard", F.when(in_large, large).otherwise(small).cast("int"))
    begin = F.col("shard") * q + F.least(F.col("shard").cast("long"), r)
    return numbered.withColumn("slot", (at - begin).cast("long")).select(*names, "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int, **options) -> None:
    """Write the shuffled records as one folder per shard, rows in slot order within each file."""
    shuffled(docs, shards, **options).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def sharded(docs: DataFrame, shards: int, **options) -> DataFrame:
    """Write to a new folder of the shared directory and read the records back, with shard and slot."""
    spark = docs.sparkSession
    path = new_path(spark, "shards")
    write_shards(docs, path, shards, **options)
    fields = [f for f in docs.schema.fields]
    return spark.read.schema(
        docs.limit(0).withColumn("slot", F.lit(0).cast("long")).withColumn("shard", F.lit(0).cast("int")).schema
    ).parquet(path).select(*[f.name for f in fields], "shard", "slot")
