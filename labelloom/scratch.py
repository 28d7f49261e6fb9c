"""Cutting lineage through tables written to the cluster's shared folder.

Loops and reused intermediate results are written as parquet instead of being
kept on executors: a lost executor then costs a re-read, not a re-computation,
and the written size gives Spark a true size for its broadcast decision.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest small table that is marked for broadcast.
SMALL_BYTES = 32 << 20

_local_roots: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    app = context.applicationId
    if configured:
        return f"{configured.rstrip('/')}/labelloom/{app}"
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="labelloom-")
    return _local_roots[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._cut_path = path
    return written


def drop(written: DataFrame) -> None:
    """Delete a table written by ``cut`` that nothing will read again."""
    spark = written.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(written._cut_path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def settle(df: DataFrame, name: str = "small", max_rows: int = 20_000) -> DataFrame:
    """Fix a table that is expected to be small.

    Up to ``max_rows`` rows become a local table. Spark does not know its size, so one of at most
    ``SMALL_BYTES`` is marked for broadcast: the large side of a join then stays where it is and is not
    dealt by a key with few, uneven values. Anything larger is written with ``cut`` and joined by size.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        local = df.sparkSession.createDataFrame(rows, df.schema)
        return F.broadcast(local) if sum(map(_size, rows)) <= SMALL_BYTES else local
    return cut(df, name)


def give_back() -> None:
    """Give memory that this worker no longer uses back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _size(value) -> int:
    """Rough bytes of a collected value."""
    if isinstance(value, str | bytes):
        return len(value) + 8
    if isinstance(value, dict):
        return sum(_size(x) for pair in value.items() for x in pair)
    if isinstance(value, list | tuple):
        return 8 * len(value) + (sum(map(_size, value)) if value and isinstance(value[0], str | list | tuple | dict) or isinstance(value, tuple) else 0)
    return 8


def parallelism(spark: SparkSession) -> int:
    """Task count for compute-heavy stages whose input is small in bytes."""
    return max(
        spark.sparkContext.defaultParallelism,
        min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism),
    )


def spread(scan: DataFrame) -> DataFrame:
    """Repartition a scan that has fewer splits than the cluster has cores.

    Large tables have many splits and pass through without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
