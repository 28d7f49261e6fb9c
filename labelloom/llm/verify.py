"""Exact Jaccard similarity inside groups of candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from labelloom.llm.common import tiles, whole_runs

TILE = 512


def link_sets(sets: list[frozenset], similarity: float) -> list[int]:
    """For each set the least index of those that hang together with it by pairs of sufficient similarity.

    Sets are compared in order of size, so only sizes that can reach the similarity meet, and pairs that already
    hang together are not compared again.
    """
    label = list(range(len(sets)))

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), i))
    for x, i in enumerate(order):
        for j in order[x + 1 :]:
            if len(sets[i]) < similarity * len(sets[j]) - 1e-9:
                break
            a, b = root(i), root(j)
            if a == b:
                continue
            common = len(sets[i] & sets[j])
            if common >= similarity * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def jaccard_forest(candidates: DataFrame, similarity: float, tile: int = TILE) -> DataFrame:
    """(a, b): a forest over the members of each group whose exact Jaccard similarity suffices.

    ``candidates`` has columns value (the group), cls (the member) and shingles (distinct longs).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def key(table: pa.Table) -> np.ndarray:
            value, t = table.column("value").to_numpy(), table.column("tile").to_numpy()
            return np.cumsum(np.r_[False, (value[1:] != value[:-1]) | (t[1:] != t[:-1])])

        for table in whole_runs(batches, key, 2_000):
            group = key(table)
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            cls = table.column("cls").to_pylist()
            lists = table.column("shingles")
            a, b = [], []
            for at, end in zip(starts.tolist(), np.r_[starts[1:], group.size].tolist(), strict=True):
                if end - at < 2:
                    continue
                label = link_sets([frozenset(x.values.to_numpy().tolist()) for x in lists.slice(at, end - at)], similarity)
                for i, r in enumerate(label):
                    if i != r:
                        a.append(cls[at + i])
                        b.append(cls[at + r])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    tiled = tiles(candidates, ["value"], "cls", tile)
    return tiled.repartition("value", "tile").sortWithinPartitions("value", "tile", "cls").mapInArrow(run, "a long, b long")
