"""All pairs of a small table, or of blocks of a large one, without emitting them.

For values that are *defined* over all pairs (mean distances).  Only what the
kernel reduces a block and a whole tile of blocks to leaves the task.  A table of
at most ``BLOCK_BYTES`` travels to the tasks as one block; a larger one is packed into
blocks of bounded size, which are dealt to tiles that meet through an equi-join: a block is
sent once per tile, and there are only as many tiles as cores and memory ask for.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType

from labelloom.functions.vectors import from_bytes, matrix, to_bytes
from labelloom.operators.cells import TILE_BYTES, meet
from labelloom.scratch import cut, settle

BLOCK_ROWS = 1024
BLOCK_BYTES = 16 << 20
TABLE_ROWS = 4096


def as_array(column: pa.Array) -> np.ndarray:
    if pa.types.is_list(column.type):
        return matrix(column)
    return column.to_numpy(zero_copy_only=False)


def pairwise(
    points: DataFrame, columns: list[str], kernel: Callable, schema: str, block_rows: int = BLOCK_ROWS, out_rows: int = 1, both: bool = False
) -> DataFrame:
    """Run ``kernel(grp, a, bs)`` for every block of a group and every tile of its blocks.

    ``points`` is a written table with ``grp`` BIGINT, ``id`` BIGINT, ``v`` and
    the further ``columns``; ``a`` and the members of ``bs`` map column names to arrays.
    ``out_rows`` is the number of rows that the kernel yields per point of ``a``; it bounds a tile's result.
    With ``both`` two tiles meet once for both directions: ``kernel(grp, left, right)`` gets the blocks of both, one list
    twice where a tile meets itself, and yields what it found for the points of each.
    """
    session = points.sparkSession
    names = ["id", "v", *columns]
    fields = [part.split() for part in schema.split(",")]
    sizes = points.groupBy("grp").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size("v")).cast("bigint").alias("width")
    ).withColumn("n_blocks", F.ceil(F.col("rows") / F.lit(block_rows)).cast("bigint"))
    in_bytes = F.col("rows") * 8 * (F.col("width") + len(names))
    out_bytes = F.col("rows") * (8 * len(fields) * out_rows)
    for_cores = math.ceil(math.sqrt(4 * session.sparkContext.defaultParallelism))
    side = lambda *most: F.least("n_blocks", F.greatest(F.lit(for_cores), *[F.ceil(x / F.lit(TILE_BYTES)) for x in most])).cast("bigint")
    blocks = settle(
        sizes.select("grp", "n_blocks", side(in_bytes, out_bytes).alias("a_side"), side(in_bytes, out_bytes if both else F.lit(0)).alias("b_side")), "blocks"
    )
    types = {c: points.schema[c].dataType for c in names}
    wide = {c: isinstance(types[c], ArrayType) for c in names}
    entries = {c: types[c].elementType if wide[c] else types[c] for c in names}
    kinds = {c: np.int64 if isinstance(entries[c], IntegralType) else np.float64 for c in names}
    heads = ["grp", "block", "a_side", "b_side"]

    def pack(group: pa.Table) -> pa.Table:
        raw = {c: pa.array([to_bytes(group[c])], type=pa.binary()) for c in names}
        return pa.table({**{c: group[c].slice(0, 1) for c in heads}, "n": pa.array([group.num_rows]), **raw})

    packed = cut(
        points.join(blocks, "grp")
        .select("grp", F.pmod(F.xxhash64("id"), F.col("n_blocks")).alias("block"), "a_side", "b_side", *names)
        .groupBy(*heads)
        .applyInArrow(pack, ", ".join(f"{c} bigint" for c in [*heads, "n"]) + ", " + ", ".join(f"{c} binary" for c in names)),
        "packed_blocks",
    )
    tile = lambda own: (F.col("block") % F.col(own))
    every = lambda other: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))
    if both:
        upto = lambda first, last: F.explode(F.sequence(first, last))
        left = packed.select("grp", tile("a_side").alias("a_tile"), upto(tile("a_side"), F.col("a_side") - 1).alias("b_tile"), "n", *names)
        right = packed.select("grp", upto(F.lit(0).cast("bigint"), tile("a_side")).alias("a_tile"), tile("a_side").alias("b_tile"), "n", *names)
    else:
        left = packed.select("grp", tile("a_side").alias("a_tile"), every("b_side").alias("b_tile"), "n", *names)
        right = packed.select("grp", every("a_side").alias("a_tile"), tile("b_side").alias("b_tile"), "n", *names)

    def unpack(rows: pa.Table) -> list[dict]:
        return [
            {c: from_bytes(batch[c][row], batch["n"][row].as_py(), kinds[c], wide[c]) for c in names}
            for batch in rows.to_batches() for row in range(batch.num_rows)
        ]

    arrow = {c: {"bigint": pa.int64(), "int": pa.int32()}.get(t, pa.float64()) for c, t in fields}

    def run(a_rows: pa.Table, b_rows: pa.Table) -> pa.Table:
        none = pa.table({c: pa.array([], type=t) for c, t in arrow.items()})
        if not a_rows.num_rows or not b_rows.num_rows:
            return none
        grp, bs = a_rows["grp"][0].as_py(), unpack(b_rows)
        if both:
            found = kernel(grp, bs if a_rows["a_tile"][0].as_py() == a_rows["b_tile"][0].as_py() else unpack(a_rows), bs)
        else:
            found = (out for a in unpack(a_rows) for out in kernel(grp, a, bs))
        return pa.concat_tables([none, *(pa.table({c: pa.array(out[c], type=t) for c, t in arrow.items()}) for out in found)]).combine_chunks()

    return meet(left, right, ["grp", "a_tile", "b_tile"], run, schema)


def block_pairs(left: list[dict], right: list[dict]) -> Iterator[tuple[int, int]]:
    """Places of the pairs of blocks of two tiles, or of one tile with itself, each pair once."""
    for i in range(len(left)):
        for j in range(i if right is left else 0, len(right)):
            yield i, j


def against_table(points: DataFrame, columns: list[str], kernel: Callable, schema: str) -> DataFrame:
    """``pairwise`` for a table that usually fits one block, such as cluster centroids."""
    names = ["grp", "id", "v", *columns]
    rows = points.select(*names).limit(TABLE_ROWS + 1).collect()
    width = max((len(r.v) for r in rows), default=0)
    if len(rows) > TABLE_ROWS or len(rows) * width * 8 > BLOCK_BYTES:
        return pairwise(cut(points.select(*names), "pair_table"), columns, kernel, schema)
    rows = sorted(rows, key=lambda r: (r.grp, r.id))
    fixed = points.sparkSession.createDataFrame(rows, points.select(*names).schema)
    out_names = [part.split()[0] for part in schema.split(",")]
    groups: dict[int, list] = {}
    for r in rows:
        groups.setdefault(r.grp, []).append(r)
    table = {
        g: {c: np.array([r[c] for r in members]) for c in names[1:]} for g, members in groups.items()
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grp = batch["grp"].to_numpy(zero_copy_only=False)
            for g in np.unique(grp):
                at = np.flatnonzero(grp == g)
                part = batch.take(pa.array(at))
                side = {c: as_array(part[c]) for c in names[1:]}
                for out in kernel(int(g), side, [table[int(g)]]):
                    yield pa.RecordBatch.from_arrays([pa.array(out[c]) for c in out_names], out_names)

    return fixed.mapInArrow(run, schema)
