"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.scratch import cut, spread

__all__ = ["bounded_batches", "cut", "give_back", "join_labels", "read", "spread", "tidied", "tiles", "whole_runs", "word_bytes", "word_table"]

#: Upper bound on the bytes that Spark puts into one Arrow batch, so that long texts do not pile up in a worker.
BATCH_BYTES = 8 * 1024 * 1024


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder, over at least as many partitions as there are cores."""
    bounded_batches(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


#: ASCII letters to lower case; what is neither an ASCII letter, an ASCII digit nor non-ASCII to a space.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def word_table() -> bytes:
    """What each byte of a text becomes in its words."""
    return _WORD


def word_bytes(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of UTF-8 text: runs of ASCII letters, ASCII digits and non-ASCII characters."""
    return data.translate(_WORD).split()


def whole_runs(
    batches: Iterable[pa.RecordBatch], key: Callable[[pa.Table], np.ndarray], rows: int = 200_000
) -> Iterator[pa.Table]:
    """Regroup sorted batches into tables of about ``rows`` rows that never cut a run of equal keys.

    ``key`` gives one comparable integer per row. A single run may be longer than ``rows``;
    callers bound runs before they sort.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        keys = key(table)
        cut_at = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut_at:
            yield table.slice(0, cut_at)
            table = table.slice(cut_at)
        held = table.to_batches()
        count = table.num_rows
    if count:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Give memory that this worker no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` that gives memory back when it ends.

    Workers outlive their tasks; what one stage leaves in their pools would be missing in the next.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def tiles(rows: DataFrame, by: list[str], member: str, most: int) -> DataFrame:
    """``rows`` with columns chunk, other and tile: groups of more than ``most`` rows become tiles of two hashed chunks.

    Chunk x of a group meets chunk y in one tile, so every pair of members shares a tile and none is unbounded.
    A row of a group of c chunks is written c times, with its own chunk and the other one of the tile; rows of
    ordinary groups once, with zeros.
    """
    hot = cut(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > most), "hot")
    if hot.isEmpty():
        return rows.withColumns({c: F.lit(0) for c in ("chunk", "other", "tile")})
    chunks = hot.select(*by, F.ceil(F.col("rows") / F.lit(most)).cast("int").alias("chunks"))
    return (
        rows.join(chunks, by, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("chunk", F.pmod(F.xxhash64(member), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .withColumn("tile", F.least("chunk", "other") * F.col("chunks") + F.greatest("chunk", "other"))
        .drop("chunks")
    )


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Lower ``label`` (indices of representatives) in place until a[i] and b[i] agree for every i."""
    while a.size:
        while True:
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label[:] = jump
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
