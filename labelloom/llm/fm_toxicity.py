"""Toxicity of documents from a second-order factorization machine over hashed terms.

A text is cut into overlapping windows of ``WINDOW`` words. The terms of a window are its words and their beginnings of
four, five and six bytes, hashed into ``BUCKETS`` places. Each place has a weight and a vector; a window's score is the sum of
the weights and of the products of all pairs of vectors, so that an insult next to a mention of a group can weigh
more than both apart. A document scores as its worst window, whatever its length.

The model is fitted on at most ``TRAIN_DOCS`` labelled documents of each class of at most ``TRAIN_WORDS`` words, those
with the least hash of their id. Scoring reads every whole text in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import word_table

TRAIN_DOCS, TRAIN_WORDS = 2500, 1500
WINDOW, STEP = 40, 20
BITS, RANK = 18, 4
BUCKETS = 1 << BITS
_STARTS = (4, 5, 6)
TERMS = 1 + len(_STARTS)
#: Bytes of a text whose words are looked up at once.
SLICE = 4 * 1024 * 1024
_BASE = np.uint64(0x100000001B3)
_WORDS = np.frombuffer(word_table(), np.uint8)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), _BASE, np.uint64)], dtype=np.uint64)[:n]


def _place(value: np.ndarray, kind: int) -> np.ndarray:
    mixed = (value + np.uint64(kind + 1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def terms(data: bytes) -> np.ndarray:
    """Places of the terms of each word, as words x TERMS; -1 where a word is no longer than the beginning.

    Words are runs of ASCII letters, digits and non-ASCII characters of the UTF-8 text, A-Z in lower case.
    """
    flat = _WORDS[np.frombuffer(data, np.uint8)]
    inside = np.r_[False, flat != 32, False]
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    if not starts.size:
        return np.zeros((0, TERMS), np.int64)
    sizes = ends - starts
    power = _powers(int(sizes.max()))
    place = np.arange(flat.size)
    place[starts[0] :] -= np.repeat(starts, np.diff(np.r_[starts, flat.size]))
    letters = np.where(flat != 32, flat.astype(np.uint64) * power[np.minimum(place, power.size - 1)], np.uint64(0))
    out = np.full((starts.size, TERMS), -1, np.int64)
    out[:, 0] = _place(np.add.reduceat(letters, starts) + sizes.astype(np.uint64), 0)
    for k, length in enumerate(_STARTS, 1):
        long = np.flatnonzero(sizes > length)
        if long.size:
            out[long, k] = _place(sum(letters[starts[long] + i] for i in range(length)), k)
    return out


def bags(places: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, place) of each ``known`` term, once a window. Window k holds the words from k * STEP on."""
    word, kind = np.nonzero(known[places])
    found = places[word, kind]
    late = word // STEP
    if WINDOW != 2 * STEP:
        raise ValueError("windows overlap by half")
    pair = np.unique(np.concatenate([late * BUCKETS + found, (late * BUCKETS + found - BUCKETS)[late > 0]]))
    return pair // BUCKETS, pair % BUCKETS


@dataclass
class Model:
    shift: float
    #: Weight of each place, and its vector; the row behind the last place is zero, for missing terms.
    weights: np.ndarray
    vectors: np.ndarray
    #: Places that have been learned.
    known: np.ndarray

    def odds(self, bag: np.ndarray, flat: np.ndarray, size: int) -> np.ndarray:
        """Log odds of ``size`` bags of places."""
        vector = self.vectors[flat]
        total = np.stack([np.bincount(bag, vector[:, j], size) for j in range(RANK)], axis=1)
        square = np.bincount(bag, (vector * vector).sum(axis=1), size)
        return self.shift + np.bincount(bag, self.weights[flat], size) + 0.5 * ((total**2).sum(axis=1) - square)

    def score(self, data: bytes) -> float:
        """Probability of the worst window; windows without any learned term, and texts without words, score alike."""
        worst = self.shift
        for places in parts(data):
            window, flat = bags(places, self.known)
            if window.size:
                _, window = np.unique(window, return_inverse=True)
                worst = max(worst, float(self.odds(window, flat, window.max() + 1).max()))
        return float(1 / (1 + np.exp(-np.clip(worst, -30, 30))))


def parts(data: bytes, size: int = SLICE) -> Iterator[np.ndarray]:
    """Terms of the words of a text, for long texts in parts that start where windows do and share every window across them."""
    at, held, start = 0, np.zeros((0, TERMS), np.int64), 0
    while at < len(data):
        end = at + size
        while end < len(data) and _WORDS[data[end]] != 32:
            end += 1
        held = np.concatenate([held, terms(data[at:end])])
        yield held
        behind = max(((start + len(held)) // STEP - 1) * STEP, start)
        held, start, at = held[behind - start :], behind, end


def telling(docs: list[np.ndarray], toxic: np.ndarray, least_docs: int = 3, least_ratio: float = 12.0) -> np.ndarray:
    """Places that windows of toxic documents hold more often than others, by likelihood ratio; True for those to learn.

    Windows are counted instead of documents, so that long documents do not make common words look toxic, but at most four
    of a document, so that a text that repeats itself says little; a place must occur in ``least_docs`` toxic documents.
    """
    held, size, docs_with = np.zeros((2, BUCKETS)), np.zeros(2), np.zeros(BUCKETS)
    every = np.r_[np.ones(BUCKETS, bool), False]
    for places, y in zip(docs, toxic, strict=True):
        if not len(places):
            continue
        seen, times = np.unique(bags(places, every)[1], return_counts=True)
        held[y, seen] += np.minimum(times, 4)
        size[y] += (len(places) - 1) // STEP + 1
        if y:
            docs_with[seen] += 1
    both = held.sum(axis=0)
    share = np.clip(np.stack([held[0] / size[0], held[1] / size[1], both / size.sum()]), 1e-12, 1 - 1e-12)

    def likelihood(k: np.ndarray, n: float, p: np.ndarray) -> np.ndarray:
        return k * np.log(p) + (n - k) * np.log1p(-p)

    ratio = 2 * sum(likelihood(held[y], size[y], share[y]) - likelihood(held[y], size[y], share[2]) for y in (0, 1))
    return (ratio >= least_ratio) & (share[1] > share[0]) & (docs_with >= least_docs)


def fit(docs: list[np.ndarray], toxic: np.ndarray, epochs: int = 25, rate: float = 0.15, decay: float = 1e-3, seed: int = 11) -> Model:
    """Fit by AdaGrad on the logistic loss; each document counts through its worst window of the moment.

    Only places that ``telling`` finds are learned; all others weigh nothing. Both classes count alike.
    """
    rng = np.random.default_rng(seed)
    known = np.r_[telling(docs, toxic), False]
    model = Model(-1.0, np.zeros(BUCKETS + 1), np.zeros((BUCKETS + 1, RANK)), known)
    learned = np.flatnonzero(known)
    model.weights[learned] = 0.5
    model.vectors[learned] = rng.normal(0, 0.05, (learned.size, RANK))
    # What is left of each document: its windows that hold learned places, and one empty window.
    left = []
    for places in docs:
        window, flat = bags(places, known)
        left.append(np.split(flat, np.flatnonzero(np.diff(window)) + 1) + [np.zeros(0, np.int64)])
    sums_w, sums_v, sum_b = np.full(BUCKETS + 1, 1.0), np.full((BUCKETS + 1, RANK), 1.0), 1.0
    share = np.clip(toxic.mean() if toxic.size else 0.5, 0.02, 0.98)
    for _ in range(epochs if learned.size else 0):
        order = rng.permutation(len(docs))
        for k in range(0, order.size, 128):
            part = order[k : k + 128]
            rows = [w for d in part for w in left[d]]
            owner = np.repeat(np.arange(part.size), [len(left[d]) for d in part])
            flat = np.concatenate(rows)
            of = np.repeat(np.arange(len(rows)), [r.size for r in rows])
            odds = model.odds(of, flat, len(rows))
            vector = model.vectors[flat]
            total = np.stack([np.bincount(of, vector[:, j], len(rows)) for j in range(RANK)], axis=1)
            worst = np.full(part.size, -np.inf)
            np.maximum.at(worst, owner, odds)
            first = np.full(part.size, len(rows))
            np.minimum.at(first, owner, np.where(odds == worst[owner], np.arange(len(rows)), len(rows)))
            y = toxic[part]
            gap = np.zeros(len(rows))
            gap[first] = np.where(y, 0.5 / share, 0.5 / (1 - share)) * (1 / (1 + np.exp(-np.clip(worst, -30, 30))) - y)
            places, back = np.unique(flat, return_inverse=True)
            step_w = np.bincount(back, gap[of], places.size) + decay * model.weights[places]
            pull = gap[of, None] * (total[of] - vector)
            step_v = np.stack([np.bincount(back, pull[:, j], places.size) for j in range(RANK)], axis=1) + decay * model.vectors[places]
            sums_w[places] += step_w**2
            sums_v[places] += step_v**2
            model.weights[places] -= rate * step_w / np.sqrt(sums_w[places])
            model.vectors[places] -= rate * step_v / np.sqrt(sums_v[places])
            step_b = gap.sum()
            sum_b += step_b**2
            model.shift -= rate * step_b / np.sqrt(sum_b)
    return model


def held_out(key: str) -> Column:
    """True for the third of the ids that no model may learn from; false for null."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          per_class: int = TRAIN_DOCS, most_words: int = TRAIN_WORDS) -> Model:
    """Fit on labelled rows that are not held out. Rows without a label of 0 or 1, and null texts, are passed over.

    At most ``per_class`` documents of each class come to the driver, as hashed terms of at most ``most_words`` words. An id
    with several labels takes the smallest; repeated rows of one id and text count once. Without any usable label
    every document scores near 0.5.
    """
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out(key)).groupBy(key).agg(F.min(label).cast("int").alias("toxic"))
    chosen = None
    for value in (0, 1):
        part = usable.where(F.col("toxic") == value).orderBy(F.xxhash64(key), key).limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(data.as_py()) for data in batch.column(2)]
            at = pa.array([i for i, places in enumerate(found) if len(places) <= most_words], pa.int64())
            packed = pa.array([found[i].astype("<i4").tobytes() for i in at.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), packed], names=["key", "toxic", "terms"])

    sample = (
        docs.where(F.col(text).isNotNull()).select(key, F.col(text).cast("string").cast("binary").alias("data")).join(F.broadcast(chosen), key)
        .select(F.col(key).cast("long").alias("key"), "toxic", "data")
        .mapInArrow(run, "key long, toxic int, terms binary").collect()
    )
    rows = sorted({(r["key"], r["toxic"], bytes(r["terms"])) for r in sample})
    return fit([np.frombuffer(t, "<i4").reshape(-1, TERMS).astype(np.int64) for _, _, t in rows], np.array([y for _, y, _ in rows], np.int64))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row of ``docs``; null, empty and wordless texts score as an empty window."""
    shared = docs.sparkSession.sparkContext.broadcast((model.shift, model.weights, model.vectors, model.known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            found = [model.score(data.as_py() or b"") for data in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["key", "score"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").cast("binary").alias("data"))
    return rows.mapInArrow(run, "key long, score double").withColumnRenamed("key", key)
