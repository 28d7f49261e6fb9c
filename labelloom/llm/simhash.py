"""SimHash near-duplicates through a Gray-ordered hierarchical index.

1. Every text becomes a 64-bit fingerprint, the bitwise majority of its shingle hashes.
2. Equal fingerprints are collapsed; only distinct ones are searched.
3. Two fingerprints within three bits agree on one of four 16-bit blocks, and then on one of four
   12-bit blocks of the rest. So each fingerprint is written in 16 bit orders, each with another pair
   of blocks in front. Rows that share those 28 bits form a group; a group is the top node of an index.
4. Inside a partition rows are sorted by Gray rank. Consecutive fingerprints of a group form a leaf,
   consecutive leaves an upper node, and each node factors out the bits that all below it share (mask and
   pattern). A search adds up differences on the way down; a node beyond the radius is pruned with all
   below it, and a node whose free bits cannot exceed the radius is accepted with all below it.
5. Each group gives back a forest (at most one edge per fingerprint), never all its pairs.

Groups above ``TILE`` fingerprints are dealt over pairs of hashed chunks, so no task holds an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import cut, join_labels, tidied, tiles, whole_runs
from labelloom.operators.graph import components

RADIUS = 3
SEED = 42
FANOUT = 16
#: Most fingerprints of a group that one tile takes from each of two chunks.
TILE = 8192
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(data: bytes | None, words: int = 3) -> int:
    """Bit j is set if it is set in over half of the hashes of the shingles, repeats included."""
    w = data.lower().split() if data else []
    if not w:
        return 0
    h = xxhash.xxh64_intdigest
    if len(w) < words:
        hashes = [h(b" ".join(w), SEED)]
    else:
        hashes = [h(b" ".join(s), SEED) for s in zip(*(w[i:] for i in range(words)))]
    n = len(hashes)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = np.array(hashes[at : at + 65536], np.uint64)
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(_BITS[2 * votes > n].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3) -> DataFrame:
    """(key, fp): one 64-bit fingerprint, as a signed long, per row of ``docs``; null and empty texts give zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["key", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").cast("binary").alias("data"))
    return rows.mapInArrow(tidied(run), "key long, fp long").withColumnRenamed("key", key)


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in Gray order."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def gray_code(rank: np.ndarray) -> np.ndarray:
    return rank ^ (rank >> np.uint64(1))


def orders(code: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The 16 bit orders of each code, each with another 16-bit and then another 12-bit block in front."""
    blocks = [(code >> np.uint64(48 - 16 * i)) & np.uint64(0xFFFF) for i in range(4)]
    for a in range(4):
        rest = [blocks[i] for i in range(4) if i != a]
        tail = (rest[0] << np.uint64(32)) | (rest[1] << np.uint64(16)) | rest[2]
        subs = [(tail >> np.uint64(36 - 12 * i)) & np.uint64(0xFFF) for i in range(4)]
        for c in range(4):
            others = [subs[i] for i in range(4) if i != c]
            low = (others[0] << np.uint64(24)) | (others[1] << np.uint64(12)) | others[2]
            yield 4 * a + c, (blocks[a] << np.uint64(48)) | (subs[c] << np.uint64(36)) | low


def _differing(bits: np.ndarray) -> np.ndarray:
    """Set bits of each code (one line of one or more 64-bit words)."""
    return np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


class GrayIndex:
    """Nodes over codes (lines of one or more 64-bit words) in Gray order. ``group`` is a non-decreasing number per code."""

    def __init__(self, codes: np.ndarray, group: np.ndarray, fanout: int = FANOUT) -> None:
        self.codes = codes
        #: From the leaves upwards: (first item, end item, mask, pattern); items are nodes of the level below.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        ones, zeros, owner = codes, ~codes, group  # bits that are one (zero) in all below
        while True:
            n = owner.size
            new = np.r_[True, owner[1:] != owner[:-1]]
            begin = np.flatnonzero(new)
            within = np.arange(n) - np.repeat(begin, np.diff(np.r_[begin, n]))
            first = np.flatnonzero(within % fanout == 0)
            end = np.r_[first[1:], n]
            ones, zeros = np.bitwise_and.reduceat(ones, first, axis=0), np.bitwise_and.reduceat(zeros, first, axis=0)
            self.levels.append((first, end, ones | zeros, ones))
            owner = owner[first]
            if np.unique(owner).size == owner.size:
                break
        self.group_of_root = owner

    def span(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end code below each node."""
        first, end = self.levels[level][0][nodes], self.levels[level][1][nodes]
        for below in range(level - 1, -1, -1):
            starts, ends = self.levels[below][0], self.levels[below][1]
            first, end = starts[first], ends[end - 1]
        return first, end

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, first, end): all codes of first..end in the query's group are within ``radius``.

        Only codes behind the query in Gray order are given, so each pair comes once.
        """
        codes, top = self.codes, len(self.levels) - 1
        q = queries
        owner = self._root_of(q)
        node = owner
        for level in range(top, -1, -1):
            first, end, mask, pattern = (x[node] for x in self.levels[level])
            last = self.span(level, node)[1]
            # Bits factored out above are part of this node's mask as well; the sum is over all of them.
            away = _differing((codes[q] ^ pattern) & mask)
            keep = (away <= radius) & (last > q + 1)
            q, node, first, end, mask, away = (x[keep] for x in (q, node, first, end, mask, away))
            free = 64 * codes.shape[1] - _differing(mask)
            whole = away + free <= radius
            if whole.any():
                a, b = self.span(level, node[whole])
                yield q[whole], np.maximum(a, q[whole] + 1), b
            q, first, end = q[~whole], first[~whole], end[~whole]
            sizes = end - first
            at = np.repeat(first, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            q, node = np.repeat(q, sizes), at
        hit = (node > q) & (_differing(codes[q] ^ codes[node]) <= radius)
        yield q[hit], node[hit], node[hit] + 1

    def _root_of(self, q: np.ndarray) -> np.ndarray:
        at = q
        for first, _, _, _ in self.levels:
            at = np.searchsorted(first, at, "right") - 1
        return at


def forest(codes: np.ndarray, group: np.ndarray, radius: int = RADIUS, pairs: int = 60_000) -> np.ndarray:
    """For each code the least index of those linked with it inside its group, itself included.

    Codes are looked up in slabs, so that at most about ``pairs`` pairs of a code and a node are open at once.
    """
    codes = codes.reshape(group.size, -1)
    index = GrayIndex(codes, group)
    slab = max(1, pairs // max(1, int(np.bincount(group).max(initial=1))))
    label = np.arange(group.size)
    for at in range(0, group.size, slab):
        for q, first, end in index.search(np.arange(at, min(at + slab, group.size)), radius):
            # A run is linked to the query, so its members hang together: chain them without listing pairs.
            join_labels(label, q, first)
            long = end - first > 1
            if long.any():
                step = np.zeros(group.size + 1, np.int64)
                np.add.at(step, first[long], 1)
                np.add.at(step, end[long] - 1, -1)
                inside = np.flatnonzero(np.cumsum(step)[:-1] > 0)
                join_labels(label, inside, inside + 1)
    return label


def _links(codes: DataFrame, radius: int, tile: int) -> DataFrame:
    """(a, b): a forest over the representatives of distinct codes (rep, fp) within ``radius`` bits."""
    if radius > 3:
        raise ValueError("sixteen bit orders find pairs of at most three differing bits")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for p, code in orders(fp):
                ranks = gray_rank(code)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(fp.size, p, np.int32)), pa.array((ranks >> np.uint64(36)).astype(np.int64)),
                        pa.array(ranks.view(np.int64)), batch.column(0),
                    ],
                    names=["p", "lead", "rank", "rep"],
                )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def key(table: pa.Table) -> np.ndarray:
            p, lead, t = (table.column(c).to_numpy().astype(np.int64) for c in ("p", "lead", "tile"))
            new = np.r_[False, (p[1:] != p[:-1]) | (lead[1:] != lead[:-1]) | (t[1:] != t[:-1])]
            return np.cumsum(new)

        for table in whole_runs(batches, key):
            group = key(table)
            many = np.repeat(np.bincount(group) > 1, np.bincount(group))
            if not many.any():
                continue
            code = gray_code(table.column("rank").to_numpy().view(np.uint64)[many])
            rep = table.column("rep").to_numpy()[many]
            label = forest(code, group[many], radius)
            linked = label != np.arange(label.size)
            yield pa.RecordBatch.from_arrays([pa.array(rep[linked]), pa.array(rep[label[linked]])], names=["a", "b"])

    spelled = codes.select("rep", "fp").mapInArrow(tidied(spell), "p int, lead long, rank long, rep long")
    tiled = tiles(spelled, ["p", "lead"], "rank", tile)
    return (
        tiled.repartition("p", "lead", "tile").sortWithinPartitions("p", "lead", "tile", "rank")
        .mapInArrow(tidied(search), "a long, b long")
    )


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = RADIUS,
           tile: int = TILE) -> DataFrame:
    """(key, fp, component_id): fingerprint and smallest key reachable over links of at most ``radius`` bits.

    Null and empty texts have fingerprint zero and are linked with one another. Rows with equal keys
    share a component row each. A row with a null key takes the component of rows with its fingerprint, which is
    null if none has a key. Other columns of ``docs`` are not looked at. An empty table gives no rows.
    """
    fps = cut(fingerprints(docs, text, key, words), "fps")
    codes = cut(fps.groupBy("fp").agg(F.min(key).alias("rep")), "codes")
    linked = components(_links(codes.where("rep is not null"), radius, tile))
    named = codes.join(linked, codes.rep == linked.node, "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return fps.join(named, "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group of rows whose fingerprints hang together over links of ``radius`` bits.

    The row with the smallest key stays, null keys last; of rows with equal keys any one. Rows are told apart by a number
    of their own, so repeated and null keys are no hindrance. Texts without words have fingerprint zero and
    are one group. All columns are kept, whatever their names; an empty table stays empty.
    """
    numbered = cut(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*docs.columns).alias("row")), "numbered")
    found = groups(numbered.select("uid", F.col("row")[text].alias("text")), "uid", "text", words, radius)
    keys = numbered.select("uid", F.col("row")[key].alias("key"))
    order = F.struct(F.col("key").isNull().alias("missing"), "key", "uid")
    first = found.join(keys, "uid").groupBy("component_id").agg(F.min(order)["uid"].alias("first"))
    others = found.join(first, "component_id").where("uid <> first").select("uid")
    return numbered.join(others, "uid", "left_anti").select("row.*")
